"""Place cleaned detector-days (J1, J3, J4, J5, P7-P9, F1, F2, F4) -> observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopcount.functions import dates, geo
from loopcount.operators import asof, lookups

OBSERVATION_COLUMNS = [
    "feature_id", "site", "detector", "obs_date", "day_of_week", "obs_month", "volumes", "point_wkt", "lon",
    "lat", "place", "ds_location", "nb_lane", "lane_mvt", "loc_mvt", "hf_id", "road_wkt", "road_key", "road",
]
GEOMETRY_COLUMNS = {"point_wkt", "lon", "lat", "road_wkt", "road"}
FLAT_OBSERVATION_COLUMNS = [c for c in OBSERVATION_COLUMNS if c not in ("obs_month", "volumes", "place", "road_key", "road")]


def dated(volumes: DataFrame) -> DataFrame:
    """site, detector, obs_date, volumes from cleaned rows, and their order columns."""
    others = [c for c in volumes.columns if c not in ("site", "detector", "qt_interval", "volumes")]
    return volumes.select("site", "detector", dates.interval_date(F.col("qt_interval")).alias("obs_date"),
                          "volumes", *others)


def placed_points(points: DataFrame) -> DataFrame:
    """Points that can place a row: sites with a point geometry."""
    return points.where(F.col("point_wkt").isNotNull())


def placed(volumes: DataFrame, points: DataFrame) -> DataFrame:
    """J1 + P7 as an inner join on site."""
    return dated(volumes).join(placed_points(points), "site", "inner")


def observations(volumes: DataFrame, points: DataFrame, layout: DataFrame) -> DataFrame:
    """J1, J4, P7, then J3: left join on (site, detector)."""
    rows = placed(volumes, points)
    joined = rows.join(layout, ["site", "detector"], "left")
    return finish(joined, [c for c in rows.columns if c.startswith("_")])


def observations_as_of(volumes: DataFrame, points: DataFrame, layouts: DataFrame, roads: DataFrame | None, layout_order: list) -> DataFrame:
    """J1, J4, P7, then J3 with its date condition: the layout valid on the day, and its road."""
    rows = placed(volumes, points)
    joined = asof.layout_as_of(rows, layouts, layout_order)
    return finish(lookups.with_roads(joined, roads), [c for c in rows.columns if c.startswith("_")])


def finish(joined: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Weekday and feature id, geometry tagged with its SRID, target column order,
    then the order columns ``keep``."""
    out = (joined
           .withColumn("day_of_week", dates.day_of_week(F.col("obs_date")))
           .withColumn("obs_month", dates.month(F.col("obs_date")))
           .withColumn("feature_id", dates.observation_id(F.col("site"), F.col("detector"), F.col("obs_date"))))
    return out.select(*[geo.with_srid(F.col(c), c) if c in GEOMETRY_COLUMNS else F.col(c)
                        for c in OBSERVATION_COLUMNS], *(keep or []))


def unplaced(volumes: DataFrame, points: DataFrame) -> DataFrame:
    """Cleaned rows whose site has no point; the import drops them."""
    return dated(volumes).join(placed_points(points), "site", "left_anti").select("site", "detector", "obs_date")


def with_total(observations: DataFrame) -> DataFrame:
    """Flat view of observations with the day's total count."""
    total = F.aggregate("volumes", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return observations.select(*FLAT_OBSERVATION_COLUMNS, total.alias("total"))
