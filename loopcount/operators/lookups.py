"""Lookup tables: site points (A4), road lines (A5, F7), first layout row per detector (A1),
and roads attached to layouts (J2).

"Last wins" and "first wins" are row_number() = 1 over an explicit order; Spark plans this
with a partial WindowGroupLimit before the exchange, so a key with many rows sends at most
one row per map task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loopcount.functions import curve, geo

# Default layout order when the caller gives none: the layout date, then all other fields.
DEFAULT_LAYOUT_ORDER = ["dt_general", "ds_location", "nb_lane", "lane_mvt", "loc_mvt", "hf_id"]

ROAD_COLUMNS = ["road_wkt", "road_key", "road"]
LAYOUT_COLUMNS = ["site", "detector", "ds_location", "nb_lane", "lane_mvt", "loc_mvt", "hf_id"]


def _top_one(df: DataFrame, keys: list[str], order: list, descending: bool) -> DataFrame:
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    cols = [c.desc_nulls_last() if descending else c.asc_nulls_first() for c in cols]
    w = Window.partitionBy(*keys).orderBy(*cols)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def last_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The row that comes last in ``order`` for each key."""
    return _top_one(df, keys, order, descending=True)


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The row that comes first in ``order`` for each key."""
    return _top_one(df, keys, order, descending=False)


def site_points(points: DataFrame, order: list) -> DataFrame:
    """One point per site, the last in file order -> site, point_wkt (canonical), lon,
    lat, place (Z-order).

    A site whose last record is 'null' has no point (NULL point_wkt); text that is not a
    POINT raises, naming the site (D22).
    """
    last = last_per_key(points.where(F.col("site").isNotNull()), ["site"], order)
    last = last.select("site", geo.missing_to_null(F.col("wkt")).alias("point_wkt"))
    lon, lat = geo.point_coords(F.col("point_wkt"))
    checked = last.where(geo.is_point_or_null(F.col("point_wkt"), F.col("site")))
    return (checked.select("site", geo.canonical_point(F.col("point_wkt")).alias("point_wkt"), lon.alias("lon"), lat.alias("lat"))
            .withColumn("place", curve.place(F.col("lon"), F.col("lat"))))


def road_lookup(lines: DataFrame, order: list) -> DataFrame:
    """Each line is indexed under its left and its right flow id; the later record wins,
    and within a record the right id is written after the left one.

    -> hf_id, wkt (as read), road_wkt (MULTILINESTRING text or NULL), road (nested coordinates),
    road_key (a 64-bit hash of road_wkt that stands for the text in group keys).
    """
    ids = (lines.select(F.posexplode(F.array("hfidl", "hfidr")).alias("_side", "hf_id"), "wkt", *order)
           .where(F.col("hf_id").isNotNull() & (F.col("hf_id") != "")))
    last = last_per_key(ids, ["hf_id"], list(order) + ["_side"])
    last = last.select("hf_id", geo.missing_to_null(F.col("wkt")).alias("wkt")).where(geo.is_line_other_or_null(F.col("wkt")))
    return (last.withColumn("road_wkt", geo.road_multilinestring(F.col("wkt")))
            .withColumn("road_key", geo.road_key(F.col("road_wkt")))
            .withColumn("road", geo.road_parts(F.col("road_wkt"))))


def road_texts(roads: DataFrame) -> DataFrame:
    """The text of each road by its key: road_key, road_wkt."""
    return roads.where(F.col("road_key").isNotNull()).groupBy("road_key").agg(F.min("road_wkt").alias("road_wkt"))


def road_points(roads: DataFrame) -> DataFrame:
    """F7 flattened: hf_id, part and position (from 0), lon, lat of every coordinate of a road."""
    parts = roads.select("hf_id", F.posexplode("road").alias("part", "coords"))
    return (parts.select("hf_id", "part", F.posexplode("coords").alias("position", "coord"))
            .select("hf_id", "part", "position", F.col("coord.lon").alias("lon"), F.col("coord.lat").alias("lat")))


def first_layout(layouts: DataFrame, order: list | None = None) -> DataFrame:
    """A1: one whole layout row per (site, detector), the first in ``order``."""
    order = list(order) if order else DEFAULT_LAYOUT_ORDER
    keyed = layouts.where(F.col("site").isNotNull() & F.col("detector").isNotNull())
    return first_per_key(keyed, ["site", "detector"], order).select(*LAYOUT_COLUMNS)


def with_roads(rows: DataFrame, roads: DataFrame | None) -> DataFrame:
    """Road text and coordinates by flow id (left join); null columns without a line file."""
    if roads is None:
        none = F.lit(None).cast("string")
        return (rows.withColumn("road_wkt", none).withColumn("road_key", geo.road_key(none))
                .withColumn("road", geo.road_parts(none)))
    return rows.join(roads.select("hf_id", *ROAD_COLUMNS), "hf_id", "left")


def layout_roads(layout: DataFrame, roads: DataFrame | None) -> DataFrame:
    """J2 on each reduced layout row."""
    return with_roads(layout, roads).select(*LAYOUT_COLUMNS, *ROAD_COLUMNS)
