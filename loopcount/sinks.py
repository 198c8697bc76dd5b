"""Writers for the two target tables (K1-K5).

Both are Parquet. Observations are partitioned by ``day_of_week`` and ``obs_month``, so weekday
and date filters prune files, ordered by place, so boxes skip row groups, and have Bloom filters
for flow id and site (K4). They hold each feature id once (K5): an import is merged into
the partitions it touches, and of rows with one id the last imported, last in file order stays;
all other partitions are left as they are. The profile is partitioned by ``day_of_week``; a new
profile replaces the weekdays it holds. The target schema is checked before anything is
written, against the existing table too (K3).
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loopcount.operators.broadcast import measured, measured_table
from loopcount.schemas import DOW_PROFILE_SCHEMA, OBSERVATIONS_SCHEMA, PROFILE_STATE_SCHEMA, check_schema
from loopcount.session import delete_folder, scratch, shared_path, stored, table_exists

log = logging.getLogger(__name__)

PARTITION_COLUMN = "day_of_week"
OBSERVATION_PARTITIONS = ["day_of_week", "obs_month"]
#: Columns with a Bloom filter (K4), and the values expected in a row group.
BLOOM_FILTERS = {"hf_id": 20_000, "site": 10_000}


class TableExists(ValueError):
    """A table was to be created where one lies already."""


def _existing(df: DataFrame, path: str, target: T.StructType, table: str) -> DataFrame | None:
    """The table at ``path``, its schema checked; None if there is none."""
    spark = df.sparkSession
    if not table_exists(spark, path):
        return None
    return check_schema(spark.read.parquet(path), target, f"{table} at {path}")


def _overwrite(df: DataFrame, path: str, partitions: list[str], options: dict[str, str] | None = None) -> None:
    """Replace exactly the partitions that ``df`` has rows of."""
    (df.write.mode("overwrite").options(**(options or {})).option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))


def bloom_options(columns: dict[str, int]) -> dict[str, str]:
    """Parquet options that write a Bloom filter for each column, made for so many values a row
    group. Dictionaries are left out for them: a dictionary answers the same question, but a
    chunk that has one gets no Bloom filter, and one too large for a dictionary would have neither."""
    out = {}
    for name, values in columns.items():
        out |= {f"parquet.bloom.filter.enabled#{name}": "true", f"parquet.bloom.filter.expected.ndv#{name}": str(values),
                f"parquet.enable.dictionary#{name}": "false"}
    return out


def in_partitions(touched: list[tuple[str, int]]) -> Column:
    """A filter on weekday and month that prunes to exactly these partitions."""
    months: dict[str, list[int]] = {}
    for day, month in touched:
        months.setdefault(day, []).append(month)
    hit = F.lit(False)
    for day, of_day in sorted(months.items()):
        hit = hit | ((F.col("day_of_week") == day) & F.col("obs_month").isin(sorted(of_day)))
    return hit


def _site_places(rows: DataFrame) -> DataFrame:
    """One place a site, its latest: what the files are ordered by. A site that has moved keeps
    older rows with the older place, but all its rows must meet in one task."""
    latest = rows.groupBy("site").agg(F.max(F.struct("_import", "place")).alias("_latest"))
    return measured(latest.select("site", F.col("_latest.place").alias("_site_place")), "site places").df


def write_observations(df: DataFrame, path: str, *, mode: str = "merge", order: list[str] | None = None) -> list[tuple[str, int]]:
    """K1, K4, K5: one row per feature id; returns the weekdays and months that were written.

    ``order`` names columns of ``df`` that tell which of several rows with one id came last;
    they are not written. ``mode``: "merge" into the table at ``path``, or "create" it.

    ``df`` is run once: its rows are staged in the shared folder as Parquet, and everything else
    (the partitions it touches, the ranges, the merge) reads the few columns it needs from
    there. The write has one shuffle: a range partitioning by weekday, month, place of the site
    and site. Every task writes whole sites into about one file, near sites beside each other,
    rows of one id meet in it, and no key is hotter than the few days of one site. A merge copies
    the old rows of the touched partitions to the shared folder and reads them from there; the
    copy is removed after the write, so a job that fails at any point leaves the old rows in the
    table or in the copy it names.
    """
    order = list(order or [])
    if mode not in ("merge", "create"):
        raise ValueError(f"unknown mode {mode}")
    rows = check_schema(df.drop(*order), OBSERVATIONS_SCHEMA, "observations")
    old = _existing(df, path, OBSERVATIONS_SCHEMA, "observations")
    if old is not None and mode == "create":
        raise TableExists(path)
    spark, columns = df.sparkSession, rows.columns
    with scratch(spark):
        staged = stored(df.select(*columns, *order), "import")
        # 7 weekdays times the months of the new rows: a few hundred pairs at most.
        touched = sorted((r[0], r[1]) for r in staged.select(*OBSERVATION_PARTITIONS).distinct().collect())
        new, copy = staged.withColumn("_import", F.lit(1)), None
        if old is not None:
            copy = shared_path(spark, "merge", uuid.uuid4().hex)
            old.where(in_partitions(touched)).write.parquet(copy)
            new = new.unionByName(spark.read.schema(rows.schema).parquet(copy).withColumn("_import", F.lit(0)), allowMissingColumns=True)
        new = new.join(_site_places(new), "site")
        key = [*OBSERVATION_PARTITIONS, "_site_place", "site"]
        last = Window.partitionBy(*key, "detector", "obs_date").orderBy(
            F.desc("_import"), *[F.col(c).desc_nulls_last() for c in order], F.desc("volumes"))
        kept = new.repartitionByRange(*key).withColumn("_last", F.row_number().over(last)).where("_last = 1").select(*columns)
        try:
            _overwrite(kept, path, OBSERVATION_PARTITIONS, bloom_options(BLOOM_FILTERS))
        except Exception:
            if copy is not None:
                log.error("merge into %s failed; the old rows of the touched partitions are in %s", path, copy)
            raise
        if copy is not None:
            delete_folder(spark, copy)
    return touched


def roads_path(path: str) -> str:
    """Where the road texts of the observations at ``path`` are: beside them."""
    return path.rstrip("/") + ".roads"


def write_roads(roads: DataFrame, path: str) -> None:
    """Add (road_key, road_wkt) to the road texts beside the observations at ``path``. The table is as
    small as the road network; a text never changes, as its key is made from it."""
    spark, place = roads.sparkSession, roads_path(path)
    with scratch(spark):
        now = roads.select("road_key", "road_wkt")
        if table_exists(spark, place):
            now = now.unionByName(spark.read.schema(now.schema).parquet(place))
        now = stored(now.groupBy("road_key").agg(F.min("road_wkt").alias("road_wkt")), "roads")
        now.write.mode("overwrite").parquet(place)


def read_roads(spark: SparkSession, path: str) -> DataFrame | None:
    """The road texts beside the observations at ``path``, hinted as measured; None if there are none."""
    if not table_exists(spark, roads_path(path)):
        return None
    return measured_table(spark.read.parquet(roads_path(path)), "roads").df


def write_profile_state(state: DataFrame, path: str, touched: list[tuple[str, int]] | None = None) -> None:
    """Replace the months of the weekdays that ``touched`` names (all of them, if None) by ``state``.

    A touched month that has no rows any more cannot occur: observations are never removed."""
    state = check_schema(state, PROFILE_STATE_SCHEMA, "profile state")
    _existing(state, path, PROFILE_STATE_SCHEMA, "profile state")
    state = state if touched is None else state.where(in_partitions(touched))
    _overwrite(state.hint("rebalance", *OBSERVATION_PARTITIONS).sortWithinPartitions(*OBSERVATION_PARTITIONS, "site"), path, OBSERVATION_PARTITIONS)


def write_profile(df: DataFrame, path: str) -> None:
    """K2, K4: one row per profile group and slot. Feature ids repeat when a site has two roads.

    The profile is 96 rows per aggregated group, made after the shuffle; adaptive execution
    sizes that shuffle by the aggregated rows and may leave one task for all of it. A
    rebalance on the weekday spreads the writing over tasks of the advisory size (cheap: the
    profile is small next to the observations)."""
    df = check_schema(df, DOW_PROFILE_SCHEMA, "dow_profile")
    _existing(df, path, DOW_PROFILE_SCHEMA, "dow_profile")
    _overwrite(df.hint("rebalance", PARTITION_COLUMN).sortWithinPartitions(PARTITION_COLUMN, "site", "slot"), path, [PARTITION_COLUMN])
