"""The two jobs of the application, as DataFrames plus thin write wrappers.

Import (E1): clean raw rows, attach the site point (inner), the first layout row of the
detector and its road (left). Building an import runs small jobs at once: every lookup is
written to the shared folder, measured, and broadcast when small, so the joins read the large
volume table once without shuffling it. Profile (E2): one partial+final aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopcount import sinks
from loopcount.functions import geo
from loopcount.functions import sql as sql_functions
from loopcount.operators import cleaning, enrich, lookups, profile
from loopcount.operators.broadcast import measured
from loopcount.sources import csv as csv_source
from loopcount.session import scratch, table_exists
from loopcount.sources.tables import read_table


@dataclass(frozen=True)
class Lookups:
    """Site points, reduced layouts with roads (None where layouts are taken by date), roads by flow id
    (None without a line file) and the roads' texts (road_key, road_wkt; no rows without a line
    file), written and hinted as measured."""
    points: DataFrame
    layout: DataFrame | None
    roads: DataFrame | None
    texts: DataFrame


@dataclass(frozen=True)
class Imported:
    """Observations that are not written yet, and the texts of their roads."""
    observations: DataFrame
    roads: DataFrame


def _points(points: DataFrame, order: list, max_broadcast_bytes: int | None) -> DataFrame:
    return measured(lookups.site_points(points, order), "site points", max_broadcast_bytes, needs_rows=True).df


def build_lookups(points: DataFrame, layouts: DataFrame, lines: DataFrame | None = None, *,
                  point_order: list, line_order: list | None = None, layout_order: list | None = None,
                  max_broadcast_bytes: int | None = None, by_date: bool = False) -> Lookups:
    """A4 + F6 points (at least one), A5 + F7 roads, A1 + J2 reduced layout (not by date); each
    measured for broadcast."""
    roads = None
    texts = points.sparkSession.createDataFrame([], "road_key long, road_wkt string")
    if lines is not None:
        roads = measured(lookups.road_lookup(lines, line_order or point_order), "roads", max_broadcast_bytes).df
        texts = measured(lookups.road_texts(roads), "road texts", max_broadcast_bytes).df
    layout = None
    if not by_date:
        layout = measured(lookups.layout_roads(lookups.first_layout(layouts, layout_order), roads), "detector layouts", max_broadcast_bytes).df
    return Lookups(_points(points, point_order, max_broadcast_bytes), layout, roads, texts)


def import_observations(volumes: DataFrame, points: DataFrame, layouts: DataFrame, lines: DataFrame | None = None, **options) -> DataFrame:
    """E1 as a DataFrame: raw rows in, observations out (not written); options as of ``imported``."""
    return imported(volumes, points, layouts, lines, **options).observations


def imported(volumes: DataFrame, points: DataFrame, layouts: DataFrame,
             lines: DataFrame | None = None, *, point_order: list, line_order: list | None = None,
             layout_order: list | None = None, max_broadcast_bytes: int | None = None,
             keep: list[str] | None = None, by_date: bool = False) -> Imported:
    """Raw rows in, observations out (not written) with the order columns ``keep``, and road texts.

    ``by_date``: a count gets the layout valid on its day instead of the first one (D9)."""
    lk = build_lookups(points, layouts, lines, point_order=point_order, line_order=line_order,
                       layout_order=layout_order, max_broadcast_bytes=max_broadcast_bytes, by_date=by_date)
    clean = cleaning.clean_volumes(volumes, keep)
    if by_date:
        return Imported(enrich.observations_as_of(clean, lk.points, layouts, lk.roads, layout_order or lookups.DEFAULT_LAYOUT_ORDER), lk.texts)
    return Imported(enrich.observations(clean, lk.points, lk.layout), lk.texts)


def import_csv(spark: SparkSession, volumes_path, layouts_path, points_path, lines_path=None, **options) -> DataFrame:
    """E1 on the reference's CSV inputs; the line file is optional (roads are then NULL)."""
    return imported_csv(spark, volumes_path, layouts_path, points_path, lines_path, **options).observations


def imported_csv(spark: SparkSession, volumes_path, layouts_path, points_path, lines_path=None, *,
                 layout_order: list | None = None, max_broadcast_bytes: int | None = None,
                 keep: list[str] | None = None, by_date: bool = False) -> Imported:
    """``imported`` on CSV files."""
    order = csv_source.ORDER_COLUMNS
    return imported(
        csv_source.read_raw_volumes(spark, volumes_path, with_order=bool(keep)), csv_source.read_points(spark, points_path),
        csv_source.read_site_layouts(spark, layouts_path), csv_source.read_lines(spark, lines_path) if lines_path else None,
        point_order=order, line_order=order, layout_order=layout_order or lookups.DEFAULT_LAYOUT_ORDER + order,
        max_broadcast_bytes=max_broadcast_bytes, keep=keep, by_date=by_date)


def import_job(spark: SparkSession, output_path: str, volumes_path, layouts_path, points_path,
               lines_path=None, *, mode: str = "merge", layout_order: list | None = None,
               max_broadcast_bytes: int | None = None, state_path: str | None = None, by_date: bool = False) -> str:
    """E1 end to end: CSV files in, merged into the observations table; their road texts beside it.

    With ``state_path``, the profile's state there follows: the months of the weekdays that the
    import touched are summed up anew, all others stay."""
    order = csv_source.ORDER_COLUMNS
    with scratch(spark):
        new = imported_csv(spark, volumes_path, layouts_path, points_path, lines_path, layout_order=layout_order,
                           max_broadcast_bytes=max_broadcast_bytes, keep=order, by_date=by_date)
        # Texts first: a table whose rows have keys without text would lose roads.
        sinks.write_roads(new.roads, output_path)
        touched = sinks.write_observations(new.observations, output_path, mode=mode, order=order)
        if state_path is not None:
            update_state(spark, output_path, state_path, touched if table_exists(spark, state_path) else None)
    return output_path


def touched_observations(spark: SparkSession, observations_path: str, touched: list[tuple[str, int]] | None) -> DataFrame:
    """The stored observations of these weekdays and months (all, if None)."""
    obs = read_table(spark, observations_path)
    return obs if touched is None else obs.where(sinks.in_partitions(touched))


def update_state(spark: SparkSession, observations_path: str, state_path: str, touched: list[tuple[str, int]] | None = None) -> None:
    """Sum up the touched partitions of the observations (all, if None) and replace them in the state."""
    with scratch(spark):
        obs = touched_observations(spark, observations_path, touched)
        sinks.write_profile_state(profile.monthly_state(obs, sinks.read_roads(spark, observations_path)), state_path, touched)


def dow_profile(observations: DataFrame, roads: DataFrame | None = None) -> DataFrame:
    """E2 as a DataFrame; roads: the texts by key, if the observations come without them."""
    return profile.dow_profile(observations, roads)


def stored_profile(spark: SparkSession, observations_path: str, *, day_of_week: str | list[str] | None = None) -> DataFrame:
    """E2 of a stored table: one scan of the observations, and the small table of roads."""
    return profile.dow_profile(read_table(spark, observations_path, day_of_week=day_of_week), sinks.read_roads(spark, observations_path))


def state_profile(spark: SparkSession, state_path: str, *, day_of_week: str | list[str] | None = None) -> DataFrame:
    """E2 from the stored state, without the observations."""
    return profile.from_state(read_table(spark, state_path, day_of_week=day_of_week))


def profile_job(spark: SparkSession, observations_path: str, output_path: str, *,
                day_of_week: str | list[str] | None = None) -> str:
    """E2 end to end: scan observations (optionally one weekday, S8), write the profile."""
    with scratch(spark):
        sinks.write_profile(stored_profile(spark, observations_path, day_of_week=day_of_week), output_path)
    return output_path


def state_profile_job(spark: SparkSession, state_path: str, output_path: str, *, day_of_week: str | list[str] | None = None) -> str:
    """E2 end to end from the stored state."""
    sinks.write_profile(state_profile(spark, state_path, day_of_week=day_of_week), output_path)
    return output_path


# The import join as SQL text over temp views (E3): the first layout row per detector and its
# road, then a left join of the placed volume rows on (site, detector).
LAYOUT_SQL = """
SELECT {hint} f.site, f.detector, f.ds_location, f.nb_lane, f.lane_mvt, f.loc_mvt, f.hf_id,
       r.road_wkt, r.road_key, r.road
FROM (
  SELECT * FROM (
    SELECT l.*, row_number() OVER (PARTITION BY site, detector ORDER BY {order}) AS layout_rank
    FROM siteLayouts l
    WHERE site IS NOT NULL AND detector IS NOT NULL
  ) ranked
  WHERE layout_rank = 1
) f
LEFT JOIN roadLines r ON f.hf_id = r.hf_id
"""

IMPORT_SQL = """
SELECT {hint} b.site, b.detector, b.obs_date, b.volumes, b.point_wkt, b.lon, b.lat, b.place,
       c.ds_location, c.nb_lane, c.lane_mvt, c.loc_mvt, c.hf_id, c.road_wkt, c.road_key, c.road
FROM volumeData b
LEFT JOIN detectorLayouts c
ON b.site = c.site AND b.detector = c.detector
"""


def import_sql(spark: SparkSession, volumes: DataFrame, points: DataFrame, layouts: DataFrame,
               lines: DataFrame | None = None, *, point_order: list, line_order: list | None = None,
               layout_order: list, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Register ``volumeData`` (cleaned rows with their point), ``siteLayouts`` (layout
    rows) and ``roadLines`` (road per flow id), run the joins as SQL text, and register the
    result as ``placedVolumes`` (S10). The reduced layout with its roads is measured once, as
    ``detectorLayouts``; a side is broadcast only as measured."""
    placed_points = enrich.placed_points(_points(points, point_order, max_broadcast_bytes))
    placed = enrich.dated(cleaning.clean_volumes(volumes)).join(placed_points, "site", "inner")
    placed.createOrReplaceTempView("volumeData")
    layouts.createOrReplaceTempView("siteLayouts")
    road_hint = ""
    if lines is not None:
        roads = measured(lookups.road_lookup(lines, line_order or point_order), "roads", max_broadcast_bytes)
        road_view, road_hint = roads.df, "/*+ BROADCAST(r) */" if roads.broadcast else ""
    else:
        none = F.lit(None).cast("string")
        road_view = (spark.createDataFrame([], "hf_id string, road_wkt string").withColumn("road_key", geo.road_key(none))
                     .withColumn("road", geo.road_parts(none)))
    road_view.createOrReplaceTempView("roadLines")
    order = ", ".join(f"`{c}`" if isinstance(c, str) else c for c in layout_order)
    layout = measured(spark.sql(LAYOUT_SQL.format(hint=road_hint, order=order)), "detector layouts", max_broadcast_bytes)
    layout.df.createOrReplaceTempView("detectorLayouts")
    joined = enrich.finish(spark.sql(IMPORT_SQL.format(hint="/*+ BROADCAST(c) */" if layout.broadcast else "")))
    joined.createOrReplaceTempView("placedVolumes")
    return joined


# The whole import as one SQL text (E3) over the raw views ``rawVolumes``, ``rawPoints``, ``rawLines`` and
# ``siteLayouts``, with the functions of ``functions.sql``; what to broadcast is the planner's choice.
RAW_IMPORT_SQL = """
WITH volumes AS (
  SELECT site, detector, interval_date(qt_interval) AS obs_date, clean_counts(raw) AS volumes
  FROM rawVolumes
  WHERE row_kept(site, qt_interval, detector, raw)),
points AS (
  SELECT site, point_text(point_lon(wkt), point_lat(wkt)) AS point_wkt, point_lon(wkt) AS lon, point_lat(wkt) AS lat
  FROM (
    SELECT site, geometry_text(wkt) AS wkt, row_number() OVER (PARTITION BY site ORDER BY {last}) AS rank
    FROM rawPoints WHERE site IS NOT NULL)
  WHERE rank = 1 AND point_kept(wkt, site) AND wkt IS NOT NULL),
roads AS (
  SELECT hf_id, road_text(wkt) AS road_wkt
  FROM (
    SELECT hf_id, geometry_text(wkt) AS wkt, row_number() OVER (PARTITION BY hf_id ORDER BY {last}, side DESC) AS rank
    FROM rawLines LATERAL VIEW posexplode(array(hfidl, hfidr)) ids AS side, hf_id
    WHERE hf_id <> '')
  WHERE rank = 1 AND road_kept(wkt)),
layouts AS (
  SELECT * FROM (
    SELECT l.*, row_number() OVER (PARTITION BY site, detector ORDER BY {first}) AS rank
    FROM siteLayouts l WHERE site IS NOT NULL AND detector IS NOT NULL)
  WHERE rank = 1)
SELECT observation_id(v.site, v.detector, v.obs_date) AS feature_id, v.site, v.detector, v.obs_date,
       short_weekday(v.obs_date) AS day_of_week, month_number(v.obs_date) AS obs_month, v.volumes,
       p.point_wkt, p.lon, p.lat, place_of(p.lon, p.lat) AS place,
       l.ds_location, l.nb_lane, l.lane_mvt, l.loc_mvt, l.hf_id,
       r.road_wkt, road_key_of(r.road_wkt) AS road_key, road_parts(r.road_wkt) AS road
FROM volumes v
JOIN points p ON p.site = v.site
LEFT JOIN layouts l ON l.site = v.site AND l.detector = v.detector
LEFT JOIN roads r ON r.hf_id = l.hf_id
"""


def import_raw_sql(spark: SparkSession, volumes: DataFrame, points: DataFrame, layouts: DataFrame, lines: DataFrame | None = None, *,
                   order: list[str], layout_order: list[str]) -> DataFrame:
    """Register the raw inputs as views and the functions, and run ``RAW_IMPORT_SQL``; the result
    is registered as ``placedVolumes``. order: columns that tell the lookups' file order."""
    sql_functions.register(spark)
    if lines is None:
        lines = spark.createDataFrame([], ", ".join(["hfidl string, hfidr string, wkt string", *[f"`{c}` string" for c in order]]))
    for name, df in (("rawVolumes", volumes), ("rawPoints", points), ("rawLines", lines), ("siteLayouts", layouts)):
        df.createOrReplaceTempView(name)
    last = ", ".join(f"`{c}` DESC NULLS LAST" for c in order)
    first = ", ".join(f"`{c}` ASC NULLS FIRST" for c in layout_order)
    out = spark.sql(RAW_IMPORT_SQL.format(last=last, first=first))
    out.createOrReplaceTempView("placedVolumes")
    return out
