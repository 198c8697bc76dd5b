"""

Every query on counts reads the driver's tables reshaped into the import job's inputs (events →
raw detector-day counts, supplier → site points, nation → road lines, lineitem → lane layouts)
and runs over all rows of these tables. The oracle SQL builds the same reshaping in DuckDB in long
form (one row per slot) and computes each result independently of the Spark code.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loopcount.plans import queries as _q

# The operators on texts, pages and vectors are an optional part: without their folder, the
# pipeline built on it or a package that they need, the other queries stand alone.
try:
    import corpus_pipeline as _pipeline
    from loopcount.llm import queries as _llm
except ImportError as missing:
    logging.getLogger(__name__).warning("without the operators of loopcount.llm: %s", missing)
    _pipeline = _llm = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the day-of-week profile at sf 0.001."""
    return _q.dow_profile(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(_q.QUERIES)
    if _llm is not None:
        found |= _llm.QUERIES | {"pipeline": _pipeline.run}
    return found


# --- oracle -----------------------------------------------------------------------------

_SLOTS = 96

_RAW = """
ev AS (
  SELECT user_id, CAST(user_id AS VARCHAR) AS site,
         CASE event_type WHEN 'click' THEN '1' WHEN 'error' THEN '2'
              WHEN 'purchase' THEN '3' WHEN 'signup' THEN '4' ELSE '5' END AS detector,
         CAST(ts AS DATE) AS day, hour(ts) * 4 + minute(ts) // 15 AS slot
  FROM events),
slot_n AS (SELECT user_id, site, detector, day, slot, count(*) AS n FROM ev GROUP BY ALL),
vol_days AS (SELECT DISTINCT user_id, site, detector, day FROM ev),
raw AS (
  SELECT d.user_id, d.site, d.detector, d.day, d.slot,
    CASE WHEN d.detector = '2' AND d.user_id % 7 = 0 THEN
           CASE WHEN s.n IS NOT NULL THEN CAST(-s.n AS VARCHAR) WHEN d.slot % 2 = 0 THEN '' ELSE '-1' END
         ELSE
           CASE WHEN s.n IS NOT NULL THEN CAST(s.n AS VARCHAR) WHEN (d.user_id + d.slot) % 3 = 0 THEN ''
                WHEN (d.user_id + d.slot) % 3 = 1 THEN '-1' ELSE '0' END
    END AS raw_count
  FROM (SELECT *, unnest(range(96)) AS slot FROM vol_days) d
  LEFT JOIN slot_n s
    ON s.user_id = d.user_id AND s.detector = d.detector AND s.day = d.day AND s.slot = d.slot),
parsed AS (
  SELECT site, detector, day, slot, TRY_CAST(NULLIF(raw_count, '') AS INTEGER) AS p FROM raw),
usable AS (
  SELECT site, detector, day, coalesce(max(p) >= 0, false) AS keep FROM parsed GROUP BY ALL),
cleaned AS (
  SELECT c.site, c.detector, c.day, c.slot, greatest(coalesce(c.p, 0), 0) AS v
  FROM parsed c JOIN usable u ON u.site = c.site AND u.detector = c.detector AND u.day = c.day
  WHERE u.keep),
vol AS (
  SELECT site, detector, day, CAST(sum(v) AS BIGINT) AS total,
         CAST(count(*) FILTER (WHERE v > 0) AS BIGINT) AS nonzero_slots
  FROM cleaned GROUP BY ALL)
"""

_POINTS = """
pts AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS site, s_suppkey * 3 + 1 AS ord,
         'POINT (144.' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || ' -37.'
           || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') || ')' AS text
  FROM supplier
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_suppkey * 3, 'POINT (1 2)' FROM supplier WHERE s_suppkey % 5 = 0
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_suppkey * 3 + 2, 'null' FROM supplier WHERE s_suppkey % 11 = 0),
last_pts AS (
  SELECT site, CASE WHEN text <> 'null' THEN text END AS wkt FROM pts QUALIFY row_number() OVER (PARTITION BY site ORDER BY ord DESC) = 1),
coords AS (
  SELECT site, CAST(regexp_extract(wkt, '^POINT \\(([^ ]+) ([^ )]+)\\)$', 1) AS DOUBLE) AS lon,
         CAST(regexp_extract(wkt, '^POINT \\(([^ ]+) ([^ )]+)\\)$', 2) AS DOUBLE) AS lat
  FROM last_pts),
all_points AS (
  SELECT site, 'POINT (' || regexp_replace(CAST(lon AS VARCHAR), '\\.0$', '') || ' ' || regexp_replace(CAST(lat AS VARCHAR), '\\.0$', '') || ')' AS point_wkt,
         lon, lat
  FROM coords),
site_points AS (SELECT * FROM all_points WHERE point_wkt IS NOT NULL)
"""

_ROADS = """
ln AS (
  SELECT n_nationkey AS ord, n_regionkey, CAST(2 * n_nationkey AS VARCHAR) AS hfidl,
         CAST(2 * n_nationkey + 2 AS VARCHAR) AS hfidr,
         '(0 ' || n_nationkey || ', 1 ' || n_nationkey || ')' AS seg,
         CASE WHEN n_regionkey = 1 THEN '(0 ' || n_nationkey || ',' || chr(10) || '1 ' || n_nationkey || ')' ELSE seg END AS seg_text
  FROM nation),
ln_ids AS (
  SELECT hfidl AS hf_id, * EXCLUDE (hfidl, hfidr), 0 AS side FROM ln
  UNION ALL SELECT hfidr AS hf_id, * EXCLUDE (hfidl, hfidr), 1 AS side FROM ln),
roads AS (
  SELECT hf_id, seg, ord, n_regionkey,
         CASE WHEN n_regionkey = 4 THEN 'POLYGON ((0 0, 1 0, 1 1, 0 0))'
              WHEN n_regionkey % 2 = 0 THEN 'MULTILINESTRING (' || seg_text || ')'
              ELSE 'LINESTRING ' || seg_text END AS wkt,
         CASE WHEN n_regionkey <> 4 THEN 'MULTILINESTRING (' || seg || ')' END AS road_wkt
  FROM ln_ids QUALIFY row_number() OVER (PARTITION BY hf_id ORDER BY ord DESC, side DESC) = 1)
"""

_LAYOUT = """
lay AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS site,
         CAST(CASE WHEN l_linenumber >= 5 THEN l_linenumber + 1 ELSE l_linenumber END AS VARCHAR) AS detector,
         'INT ' || CAST(l_partkey AS VARCHAR) || CASE WHEN l_partkey % 4 = 0 THEN ', "HIGH" ST ' || chr(92) ELSE '' END AS ds_location,
         l_returnflag AS nb_lane, l_linestatus AS lane_mvt, CAST(l_partkey % 5 AS VARCHAR) AS loc_mvt,
         CAST(l_partkey % 60 AS VARCHAR) AS hf_id,
         l_orderkey, l_partkey, l_returnflag, l_linestatus
  FROM lineitem),
layout_first AS (
  SELECT site, detector, ds_location, nb_lane, lane_mvt, loc_mvt, hf_id FROM lay
  QUALIFY row_number() OVER (PARTITION BY site, detector
                             ORDER BY l_orderkey, l_partkey, l_returnflag, l_linestatus) = 1),
layout_roads AS (
  SELECT f.*, r.road_wkt FROM layout_first f LEFT JOIN roads r ON r.hf_id = f.hf_id)
"""

_OBS = """
obs AS (
  SELECT v.site || '-' || v.detector || '-' || CAST(epoch_ms(CAST(v.day AS TIMESTAMP)) AS VARCHAR) AS feature_id,
         v.site, v.detector, v.day AS obs_date, strftime(v.day, '%a') AS day_of_week,
         p.point_wkt, p.lon, p.lat, l.ds_location, l.nb_lane, l.lane_mvt, l.loc_mvt, l.hf_id, l.road_wkt,
         v.total
  FROM vol v
  JOIN site_points p ON p.site = v.site
  LEFT JOIN layout_roads l ON l.site = v.site AND l.detector = v.detector)
"""

# The layout valid on the day: of the detector's rows dated up to it the latest, of one date the first.
_ASOF = """
dated AS (
  SELECT *, CASE WHEN l_partkey % 37 = 0 AND CAST(site AS BIGINT) % 4 <> 0 THEN DATE '0001-01-01'
                 ELSE DATE '2023-12-25' + CAST((l_partkey * 7 + CAST(detector AS BIGINT) * 5) % 40
                                               + CASE WHEN CAST(site AS BIGINT) % 4 = 0 THEN 25 ELSE 0 END AS INTEGER) END AS valid_from
  FROM lay),
valid AS (
  SELECT v.site AS v_site, v.detector AS v_detector, v.day AS v_day, l.*
  FROM vol v JOIN dated l ON l.site = v.site AND l.detector = v.detector AND l.valid_from <= v.day
  QUALIFY row_number() OVER (PARTITION BY v.site, v.detector, v.day
                             ORDER BY l.valid_from DESC, l_orderkey, l_partkey, l_returnflag, l_linestatus) = 1),
obs AS (
  SELECT v.site || '-' || v.detector || '-' || CAST(epoch_ms(CAST(v.day AS TIMESTAMP)) AS VARCHAR) AS feature_id,
         v.site, v.detector, v.day AS obs_date, strftime(v.day, '%a') AS day_of_week,
         p.point_wkt, p.lon, p.lat, l.ds_location, l.nb_lane, l.lane_mvt, l.loc_mvt, l.hf_id, r.road_wkt, v.total
  FROM vol v
  JOIN site_points p ON p.site = v.site
  LEFT JOIN valid l ON l.v_site = v.site AND l.v_detector = v.detector AND l.v_day = v.day
  LEFT JOIN roads r ON r.hf_id = l.hf_id)
"""

_OBS_COLS = ("feature_id, site, detector, obs_date, day_of_week, point_wkt, lon, lat, ds_location, nb_lane, "
             "lane_mvt, loc_mvt, hf_id, road_wkt, total")


# Counts of every seventh day of the month one lower, as a later import corrects them.
_LOWERED = _RAW.replace("greatest(coalesce(c.p, 0), 0) AS v", "greatest(coalesce(c.p, 0) - CASE WHEN day(c.day) % 7 = 0 THEN 1 ELSE 0 END, 0) AS v")


def _profile(where: str, raw: str = _RAW) -> str:
    return f"""
WITH {raw}, {_POINTS}, {_ROADS}, {_LAYOUT}, {_OBS},
slots AS (
  SELECT o.site, o.day_of_week, o.point_wkt, o.road_wkt, max(o.lon) AS lon, max(o.lat) AS lat, c.slot,
         sum(c.v) AS slot_sum, count(*) AS num_features
  FROM obs o JOIN cleaned c ON c.site = o.site AND c.detector = o.detector AND c.day = o.obs_date
  WHERE {where}
  GROUP BY o.site, o.day_of_week, o.point_wkt, o.road_wkt, c.slot),
timed AS (
  SELECT *, make_timestamp(1970, 1, 1, (slot * 15) // 60, (slot * 15) % 60, 0) AS time_of_day FROM slots)
SELECT site || '-all-' || day_of_week || '-' || strftime(time_of_day, '%H:%M') AS feature_id,
       site, 'all' AS detector, day_of_week, CAST(slot AS INTEGER) AS slot, time_of_day,
       CAST(slot_sum AS DOUBLE) / num_features AS avg_vehicle_count,
       CAST(num_features AS BIGINT) AS num_features, point_wkt, lon, lat, road_wkt
FROM timed
"""


def oracle_sql() -> dict[str, str]:
    found = _counts_oracle()
    if _llm is not None:
        found |= _llm.ORACLE_SQL
        if _pipeline.ORACLE_SQL is not None:
            found["pipeline"] = _pipeline.ORACLE_SQL
    return found


def _counts_oracle() -> dict[str, str]:
    wide = ", ".join(f"max(v) FILTER (WHERE slot = {i}) AS V{i:02d}" for i in range(_SLOTS))
    observations = f"WITH {_RAW}, {_POINTS}, {_ROADS}, {_LAYOUT}, {_OBS} SELECT {_OBS_COLS} FROM obs"
    return {
        "clean_volumes": f"WITH {_RAW} SELECT site, detector, day, total, nonzero_slots FROM vol",
        "clean_volumes_wide": f"WITH {_RAW} SELECT site, detector, day, {wide} FROM cleaned GROUP BY site, detector, day",
        "dropped_volumes": f"WITH {_RAW} SELECT site, detector, day FROM usable WHERE NOT keep",
        "site_points": f"WITH {_POINTS} SELECT site, point_wkt, lon, lat FROM all_points",
        "road_lookup": f"WITH {_ROADS} SELECT hf_id, wkt, road_wkt FROM roads",
        "layout_first": f"WITH {_ROADS}, {_LAYOUT} SELECT * FROM layout_first",
        "layout_roads": f"WITH {_ROADS}, {_LAYOUT} SELECT site, detector, hf_id, road_wkt FROM layout_roads",
        **{name: observations for name in ("observations", "observations_sql", "observations_fixture",
                                           "observations_two_imports", "observations_reimport", "observations_by_name", "observations_sql_raw")},
        "observations_tue": (f"WITH {_RAW}, {_POINTS}, {_ROADS}, {_LAYOUT}, {_OBS} "
                             f"SELECT {_OBS_COLS} FROM obs WHERE day_of_week = 'Tue'"),
        "observations_cql": observations + (
            " WHERE (day_of_week IN ('Tue', 'Thu') OR hf_id = '31') AND obs_date > DATE '2024-01-03' AND obs_date < DATE '2024-01-25'"
            " AND NOT (ds_location LIKE 'INT 1%' OR nb_lane IS NULL)"
            " AND ((lon BETWEEN 144.02 AND 144.2 AND lat BETWEEN -37.8 AND -37.1) OR site BETWEEN '3' AND '5')"),
        "observations_asof": f"WITH {_RAW}, {_POINTS}, {_ROADS}, {_LAYOUT}, {_ASOF} SELECT {_OBS_COLS} FROM obs",
        "observations_in_box": observations + " WHERE lon BETWEEN 144.035 AND 144.115 AND lat BETWEEN -37.62 AND -37.175",
        "observations_by_flow": observations + " WHERE hf_id IN ('7', '31', '58', '1000')",
        "profile_two_imports": _profile("true"),
        "profile_incremental": _profile("true", _LOWERED),
        "unplaced_volumes": (f"WITH {_RAW}, {_POINTS} SELECT v.site, v.detector, v.day FROM vol v "
                             "WHERE NOT EXISTS (SELECT 1 FROM site_points p WHERE p.site = v.site)"),
        "dow_profile": _profile("true"),
        "profile_stored": _profile("true"),
        "road_points": (f"WITH {_ROADS} SELECT hf_id, 0 AS part, p.position, CAST(p.position AS DOUBLE) AS lon, CAST(ord AS DOUBLE) AS lat "
                        "FROM roads CROSS JOIN (VALUES (0), (1)) p(position) WHERE road_wkt IS NOT NULL"),
        "profile_tue": _profile("o.day_of_week = 'Tue'"),
    }
