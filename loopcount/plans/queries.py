"""The queries registered with the driver: each takes (spark, sf_dir) and returns a flat DataFrame.

All of them start from the driver's tables reshaped into the import inputs
(``loopcount.sources.fixtures``) and run over all rows of these tables. The reshaped inputs are
written once as CSV files in the shared folder, under a name that changes with the source
files; the stored tables are written once per session.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopcount import feature_types
from loopcount.functions import clean, dates
from loopcount.operators import cleaning, enrich, lookups, profile
from loopcount.plans import jobs
from loopcount.schemas import LAYOUT_HEADER
from loopcount.session import files, path_complete, shared_path
from loopcount.sources import csv as csv_source
from loopcount.sources import fixtures
from loopcount.sources.tables import read_table

# Lookup order: position in the CSV files, which were written in the fixture's order.
POINT_ORDER = LINE_ORDER = LAYOUT_ORDER = csv_source.ORDER_COLUMNS

# Bump when the reshaping of the driver tables changes, so old exported files are not reused.
INPUTS_VERSION = "v5"

SOURCE_TABLES = ["events", "supplier", "nation", "lineitem"]


def _tag(spark: SparkSession, sf_dir: str) -> str:
    """A name for the source files as they are: their paths, lengths and modification times."""
    state = [files(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in SOURCE_TABLES]
    return hashlib.sha1(repr(state).encode()).hexdigest()[:16]


def _direct_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The reshaped driver tables as DataFrames, without files in between."""
    return fixtures.inputs(spark, sf_dir)


class _CsvInputs(dict):
    """The reshaped driver tables, written once as the reference's CSV files and read back
    with the CSV readers (S1-S6) on first use. Lookup order is file order."""

    _READERS = {"volumes": csv_source.read_raw_volumes, "points": csv_source.read_points, "lines": csv_source.read_lines,
                "layouts": csv_source.read_site_layouts, "layouts_dated": csv_source.read_site_layouts}

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._sf_dir = spark, sf_dir

    def __missing__(self, key: str) -> DataFrame:
        self[key] = self._READERS[key](self._spark, export_csv_inputs(self._spark, self._sf_dir, [key])[key])
        return self[key]


def _inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _CsvInputs(spark, sf_dir)


def _keyed(volumes: DataFrame) -> DataFrame:
    return volumes.withColumn("day", dates.interval_date(F.col("qt_interval")))


def clean_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept rows with their total and number of non-zero slots."""
    kept = cleaning.clean_volumes(_inputs(spark, sf_dir)["volumes"])
    return _keyed(kept).select("site", "detector", "day", clean.total(F.col("volumes")).alias("total"),
                               clean.nonzero_slots(F.col("volumes")).alias("nonzero_slots"))


def clean_volumes_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept rows with the 96 cleaned counts as V00..V95."""
    kept = _keyed(cleaning.clean_volumes(_inputs(spark, sf_dir)["volumes"]))
    return cleaning.wide(kept, ["site", "detector", "day"])


def dropped_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 inverted: rows without any usable count."""
    return _keyed(cleaning.dropped_volumes(_inputs(spark, sf_dir)["volumes"])).select("site", "detector", "day")


def site_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5, A4, F6."""
    return lookups.site_points(_inputs(spark, sf_dir)["points"], POINT_ORDER).select("site", "point_wkt", "lon", "lat")


def road_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6, A5, F7."""
    return lookups.road_lookup(_inputs(spark, sf_dir)["lines"], LINE_ORDER).select("hf_id", "wkt", "road_wkt")


def layout_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4, A1."""
    return lookups.first_layout(_inputs(spark, sf_dir)["layouts"], LAYOUT_ORDER)


def layout_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + J2: reduced layout with the road of its flow id."""
    i = _inputs(spark, sf_dir)
    roads = lookups.road_lookup(i["lines"], LINE_ORDER)
    return (lookups.layout_roads(lookups.first_layout(i["layouts"], LAYOUT_ORDER), roads)
            .select("site", "detector", "hf_id", "road_wkt"))


def _imported(spark: SparkSession, sf_dir: str) -> jobs.Imported:
    """E1 on the fixture inputs: the full observations (arrays included) and their road texts."""
    i = _inputs(spark, sf_dir)
    return jobs.imported(i["volumes"], i["points"], i["layouts"], i["lines"],
                         point_order=POINT_ORDER, line_order=LINE_ORDER, layout_order=LAYOUT_ORDER)


def observation_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imported(spark, sf_dir).observations


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1-J4, F1, F2, F4, P7-P9."""
    return enrich.with_total(observation_frame(spark, sf_dir))


def observations_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join written as SQL text over temp views."""
    i = _inputs(spark, sf_dir)
    obs = jobs.import_sql(spark, i["volumes"], i["points"], i["layouts"], i["lines"],
                          point_order=POINT_ORDER, line_order=LINE_ORDER, layout_order=LAYOUT_ORDER)
    return enrich.with_total(obs)


def observations_sql_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole import as one SQL text over raw views."""
    i = _inputs(spark, sf_dir)
    jobs.import_raw_sql(spark, i["volumes"], i["points"], i["layouts"], i["lines"], order=POINT_ORDER, layout_order=LAYOUT_ORDER)
    columns = ", ".join(enrich.FLAT_OBSERVATION_COLUMNS)
    return spark.sql(f"SELECT {columns}, counts_total(volumes) AS total FROM placedVolumes")


def observations_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 with its date condition: the layout valid on the day of the count."""
    i = _inputs(spark, sf_dir)
    obs = jobs.import_observations(i["volumes"], i["points"], i["layouts_dated"], i["lines"], point_order=POINT_ORDER,
                                   line_order=LINE_ORDER, layout_order=LAYOUT_ORDER, by_date=True)
    return enrich.with_total(obs)


EXPORTED = ["volumes", "points", "lines", "layouts", "points_respelled", "lines_respelled", "layouts_dated"]


def export_csv_inputs(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, str]:
    """Write the fixture inputs ``names`` (all, if None) once as the reference's CSV files, in the
    shared folder; what a query does not read is not written for it.

    Lookup files are written in their lookup order, so that file order carries it.
    """
    base = shared_path(spark, "inputs", INPUTS_VERSION, _tag(spark, sf_dir))
    paths = {k: f"{base}/{k}" for k in names or EXPORTED}
    i = _direct_inputs(spark, sf_dir)
    for name, path in paths.items():
        if path_complete(spark, path):
            continue
        if name == "volumes":
            csv_source.write_raw_volumes_csv(i["volumes"], path)
        elif name.startswith("layouts"):
            # Line items are sorted as they are and become layout texts behind the shuffle.
            lay = fixtures.layouts(fixtures.table(spark, sf_dir, "lineitem").select(*fixtures.LAYOUT_SOURCE).orderBy(*fixtures.LAYOUT_ORDER))
            lay = fixtures.dated_layouts(lay) if name == "layouts_dated" else lay
            positional = [F.col("site"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("ds_location"),
                          F.col("detector"), F.col("dt_general"), F.col("nb_lane"), F.col("lane_mvt"), F.col("loc_mvt"),
                          F.col("hf_id")]
            csv_source.write_csv(lay.select(*[c.alias(n) for c, n in zip(positional, LAYOUT_HEADER)]), path)
        else:
            kind, _, spelling = name.partition("_")
            wkt = (fixtures.respelled if spelling else F.col)("wkt").alias("WKT")
            keys = [F.col("site").alias("SITE_NO")] if kind == "points" else ["hfidl", "hfidr"]
            csv_source.write_csv(i[kind].orderBy("_row").select(wkt, *keys), path)
    return paths


def observations_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 with DataFrame inputs straight from the driver tables (no files); the lookups use
    the fixture's own order columns."""
    i = _direct_inputs(spark, sf_dir)
    obs = jobs.import_observations(i["volumes"], i["points"], i["layouts"], i["lines"],
                                   point_order=["_row"], line_order=["_row"],
                                   layout_order=fixtures.LAYOUT_ORDER)
    return enrich.with_total(obs)


def volumes_by_day(spark: SparkSession, sf_dir: str, parts: tuple[str, ...] = ("even", "odd", "lowered")) -> dict[str, str]:
    """The volume files in two parts, by even and odd day of the month, and the rows of every
    seventh day of the month with each count lowered by one; each made from its events alone."""
    base = shared_path(spark, "inputs", INPUTS_VERSION, _tag(spark, sf_dir))
    paths = {k: f"{base}/volumes_{k}" for k in parts}
    events, day = fixtures.table(spark, sf_dir, "events"), F.dayofmonth(F.to_date("ts"))
    wanted = {"even": day % 2 == 0, "odd": day % 2 == 1, "lowered": day % fixtures.LOWERED_DAY == 0}
    for k, path in paths.items():
        if not path_complete(spark, path):
            raw = fixtures.raw_volumes(events.where(wanted[k]))
            csv_source.write_raw_volumes_csv(fixtures.lowered(raw) if k == "lowered" else raw, path)
    return paths


def _import(spark: SparkSession, sf_dir: str, table: str, volumes, spelling: str = "", state: str | None = None) -> None:
    i = export_csv_inputs(spark, sf_dir, ["layouts", f"points{spelling}", f"lines{spelling}"])
    jobs.import_job(spark, table, volumes, i["layouts"], i[f"points{spelling}"], i[f"lines{spelling}"], layout_order=LAYOUT_ORDER, state_path=state)


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """The path of a table that ``write`` fills, once per session and state of the sources."""
    key = (spark.sparkContext.applicationId, name, _tag(spark, sf_dir))
    if key not in _STORED:
        path = shared_path(spark, "tables", key[0], key[2], name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def stored_observations(spark: SparkSession, sf_dir: str) -> str:
    """The observations table, imported at once; returns its path."""
    return _stored(spark, sf_dir, "observations", lambda path: _import(spark, sf_dir, path, export_csv_inputs(spark, sf_dir, ["volumes"])["volumes"]))


def stored_profile(spark: SparkSession, sf_dir: str) -> str:
    """The profile of the stored observations; returns its path."""
    return _stored(spark, sf_dir, "profile", lambda path: jobs.profile_job(spark, stored_observations(spark, sf_dir), path) and None)


def observations_tue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan the stored table with a weekday filter (a partition filter)."""
    obs = read_table(spark, stored_observations(spark, sf_dir), day_of_week="Tue")
    return enrich.with_total(obs)


def observations_two_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after two imports of different days, which share weekdays and months; the
    second one's geometry files spell their numbers in another way."""
    return enrich.with_total(read_table(spark, stored_two_imports(spark, sf_dir)))


def stored_two_imports(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        parts = volumes_by_day(spark, sf_dir, ("even", "odd"))
        for part, spelling in (("even", ""), ("odd", "_respelled")):
            _import(spark, sf_dir, path, parts[part], spelling)
    return _stored(spark, sf_dir, "observations_two_imports", write)


def profile_two_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and roads that two imports spell in two ways are one group each."""
    return jobs.stored_profile(spark, stored_two_imports(spark, sf_dir))


def profile_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of a state that followed two imports, and one that lowers counts of
    days stored already; each import summed up only the weekdays and months that it touched."""
    def write(path: str) -> None:
        parts = volumes_by_day(spark, sf_dir)
        for part, spelling in (("even", ""), ("odd", "_respelled"), ("lowered", "")):
            _import(spark, sf_dir, f"{path}/observations", parts[part], spelling, f"{path}/state")
    return jobs.state_profile(spark, _stored(spark, sf_dir, "profile_incremental", write) + "/state")


def observations_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the stored observations of a box, by ranges of the curve that the files are ordered by."""
    return enrich.with_total(read_table(spark, stored_observations(spark, sf_dir), box=fixtures.BOX))


def observations_cql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored observations that a filter text describes."""
    return enrich.with_total(read_table(spark, stored_observations(spark, sf_dir), cql=fixtures.CQL))


def observations_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan by the name of the catalog's table, which was declared before the import."""
    return enrich.with_total(spark.table(declared_observations(spark, sf_dir)))


def declared_observations(spark: SparkSession, sf_dir: str) -> str:
    """The name of a table that is made from its declaration, then filled; as one session's catalog
    may outlive or miss the other's, the table is made anew over what is stored."""
    kind = feature_types.declared(feature_types.VOLUME_TYPE)
    name = f"observations_{_tag(spark, sf_dir)}"

    def write(path: str) -> None:
        feature_types.create_table(spark, name, path, kind)
        _import(spark, sf_dir, path, export_csv_inputs(spark, sf_dir, ["volumes"])["volumes"])
        feature_types.refresh_table(spark, name)
    path = _stored(spark, sf_dir, "observations_by_name", write)
    feature_types.create_table(spark, name, path, kind)
    return name


def observations_by_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the stored observations of some flow ids, by their Bloom filters."""
    return enrich.with_total(read_table(spark, stored_observations(spark, sf_dir), flows=fixtures.FLOWS))


def observations_reimport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the table after an import of everything and one of a part, with every line twice."""
    def write(path: str) -> None:
        part = volumes_by_day(spark, sf_dir, ("even",))["even"]
        _import(spark, sf_dir, path, export_csv_inputs(spark, sf_dir, ["volumes"])["volumes"])
        _import(spark, sf_dir, path, [part, part])
    return enrich.with_total(read_table(spark, _stored(spark, sf_dir, "observations_reimport", write)))


def road_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the coordinates of every road, flat."""
    return lookups.road_points(lookups.road_lookup(_inputs(spark, sf_dir)["lines"], LINE_ORDER))


def profile_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the profile job wrote."""
    return read_table(spark, stored_profile(spark, sf_dir)).select(*profile.PROFILE_COLUMNS)


def unplaced_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept rows whose site has no point."""
    i = _inputs(spark, sf_dir)
    pts = jobs.measured(lookups.site_points(i["points"], POINT_ORDER), "site points", needs_rows=True).df
    return enrich.unplaced(cleaning.clean_volumes(i["volumes"]), pts).withColumnRenamed("obs_date", "day")


def dow_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10-P13, A2, A3, T1, T2, F3, F5."""
    new = _imported(spark, sf_dir)
    return profile.dow_profile(new.observations, new.roads)


def profile_tue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 with the weekday filter on the stored observations."""
    return jobs.stored_profile(spark, stored_observations(spark, sf_dir), day_of_week="Tue")


QUERIES = {
    "clean_volumes": clean_volumes,
    "clean_volumes_wide": clean_volumes_wide,
    "dropped_volumes": dropped_volumes,
    "site_points": site_points,
    "road_lookup": road_lookup,
    "layout_first": layout_first,
    "layout_roads": layout_roads,
    "observations": observations,
    "observations_sql": observations_sql,
    "observations_fixture": observations_fixture,
    "observations_sql_raw": observations_sql_raw,
    "observations_asof": observations_asof,
    "observations_tue": observations_tue,
    "observations_two_imports": observations_two_imports,
    "observations_reimport": observations_reimport,
    "unplaced_volumes": unplaced_volumes,
    "dow_profile": dow_profile,
    "profile_tue": profile_tue,
    "profile_stored": profile_stored,
    "profile_two_imports": profile_two_imports,
    "profile_incremental": profile_incremental,
    "observations_in_box": observations_in_box,
    "observations_by_flow": observations_by_flow,
    "observations_cql": observations_cql,
    "observations_by_name": observations_by_name,
    "road_points": road_points,
}

