"""The rules for counts, dates and geometry as SQL functions (E3), so that SQL text alone turns raw
rows into observations. ``register`` creates them as temporary functions of the session; each is
an expression that Spark inlines, like those of the other modules here, and reads the same
patterns. (A function may not be called inside a lambda, so two bodies hold a part of another.)
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from loopcount.functions import curve, geo


def _number(value: str) -> str:
    """SQL of ``geo.number``."""
    plain = rf"regexp_replace(CAST(try_cast(CAST({value} AS STRING) AS DECIMAL(38, 22)) AS STRING), r'\.?0+$', '')"
    return f"CASE WHEN {value} = 0 THEN '0' WHEN abs({value}) >= 1e-5D AND abs({value}) < 1e15D THEN {plain} ELSE CAST({value} AS STRING) END"


def _count(text: str) -> str:
    return f"try_cast(nullif({text}, '') AS INT)"


def _cell(value: str, bounds: tuple[float, float]) -> str:
    share = f"floor(({value} - CAST({bounds[0]} AS DOUBLE)) / CAST({bounds[1] - bounds[0]} AS DOUBLE) * CAST({curve.CELLS} AS DOUBLE))"
    return f"least(greatest({share}, 0L), {curve.CELLS - 1}L)"


_TOKEN = f"try_cast(regexp_extract(t, r'{geo._TOKEN_RE}', 2) AS DOUBLE)"
_SPACED = [(r"\s+", " "), (r"\s*,\s*", ", "), (r"\(\s*", "("), (r"\s*\)", ")")]


def _spaced(text: str) -> str:
    out = f"trim({text})"
    for pattern, by in _SPACED:
        out = f"regexp_replace({out}, r'{pattern}', '{by}')"
    return out


def _spread(x: str) -> str:
    return f"spread_1(spread_2(spread_4(spread_8(spread_16({x})))))"


#: (name and parameters, result, expression), in an order in which each uses only earlier ones.
FUNCTIONS = [
    ("counts_usable(raw ARRAY<STRING>)", "BOOLEAN", f"coalesce(exists(raw, x -> {_count('x')} >= 0), false)"),
    ("counts_malformed(raw ARRAY<STRING>)", "BOOLEAN", f"coalesce(exists(raw, x -> x <> '' AND {_count('x')} IS NULL), false)"),
    ("clean_counts(raw ARRAY<STRING>)", "ARRAY<INT>", f"transform(raw, x -> greatest({_count('x')}, 0))"),
    ("counts_total(volumes ARRAY<INT>)", "BIGINT", "aggregate(volumes, 0L, (a, x) -> a + x)"),
    ("row_kept(site STRING, qt_interval STRING, detector STRING, raw ARRAY<STRING>)", "BOOLEAN",
     "CASE WHEN coalesce(trim(site), '') = '' OR coalesce(trim(qt_interval), '') = '' OR coalesce(trim(detector), '') = '' "
     "THEN raise_error(concat('volume row without site, interval or detector: ', concat_ws(',', site, qt_interval, detector, raw))) "
     "WHEN counts_malformed(raw) THEN raise_error(concat('malformed count in row: ', concat_ws(',', site, qt_interval, detector, raw))) "
     "ELSE counts_usable(raw) END"),
    ("interval_date(text STRING)", "DATE",
     "CASE WHEN text IS NOT NULL AND try_to_date(substring_index(trim(text), ' ', 1), 'yyyy-MM-dd') IS NULL "
     "THEN raise_error(concat('invalid interval date: ', text)) ELSE try_to_date(substring_index(trim(text), ' ', 1), 'yyyy-MM-dd') END"),
    ("short_weekday(day DATE)", "STRING", "date_format(day, 'EEE')"),
    ("month_number(day DATE)", "INT", "year(day) * 100 + month(day)"),
    ("observation_id(site STRING, detector STRING, day DATE)", "STRING", "site || '-' || detector || '-' || CAST(CAST(unix_date(day) AS BIGINT) * 86400000L AS STRING)"),
    ("geometry_text(wkt STRING)", "STRING", "CASE WHEN trim(wkt) IN ('', 'null') THEN NULL ELSE trim(wkt) END"),
    ("coordinate_text(value DOUBLE)", "STRING", _number("value")),
    ("point_kept(wkt STRING, site STRING)", "BOOLEAN",
     f"CASE WHEN wkt IS NOT NULL AND NOT wkt RLIKE r'{geo.POINT_RE}' THEN raise_error(concat('site ', site, ' has no POINT geometry: ', wkt)) ELSE true END"),
    ("point_lon(wkt STRING)", "DOUBLE", f"CAST(regexp_extract(wkt, r'{geo.POINT_RE}', 1) AS DOUBLE)"),
    ("point_lat(wkt STRING)", "DOUBLE", f"CAST(regexp_extract(wkt, r'{geo.POINT_RE}', 2) AS DOUBLE)"),
    ("point_text(lon DOUBLE, lat DOUBLE)", "STRING", "'POINT (' || coordinate_text(lon) || ' ' || coordinate_text(lat) || ')'"),
    *[(f"spread_{shift}(x BIGINT)", "BIGINT", f"(x | shiftleft(x, {shift})) & {mask}L") for shift, mask in curve._SPREAD],
    ("place_of(lon DOUBLE, lat DOUBLE)", "BIGINT",
     f"CASE WHEN lon IS NOT NULL AND lat IS NOT NULL THEN {_spread(_cell('lon', curve.LON))} | shiftleft({_spread(_cell('lat', curve.LAT))}, 1) END"),
    ("road_kind(wkt STRING)", "STRING", f"upper(regexp_extract(wkt, r'{geo.LINE_RE}', 1))"),
    ("road_dimensions(wkt STRING)", "STRING", f"upper(regexp_extract(wkt, r'{geo.LINE_RE}', 2))"),
    ("road_body(wkt STRING)", "STRING",
     f"CASE WHEN upper(regexp_extract(wkt, r'{geo.LINE_RE}', 3)) = 'EMPTY' THEN 'EMPTY' ELSE {_spaced(f'''regexp_extract(wkt, r'{geo.LINE_RE}', 3)''')} END"),
    ("road_kept(wkt STRING)", "BOOLEAN",
     r"CASE WHEN upper(trim(wkt)) RLIKE r'^(MULTI)?LINESTRING\b' AND (road_kind(wkt) = '' OR NOT CASE WHEN road_kind(wkt) = 'LINESTRING' "
     f"THEN road_body(wkt) RLIKE r'{geo.LINE_BODY_RE}' ELSE road_body(wkt) RLIKE r'{geo.MULTI_BODY_RE}' END) "
     "THEN raise_error(concat('malformed line geometry: ', wkt)) ELSE true END"),
    ("coordinates_text(body STRING)", "STRING",
     f"CASE WHEN body = 'EMPTY' THEN body ELSE array_join(transform(split(body, ' '), t -> concat(regexp_extract(t, r'{geo._TOKEN_RE}', 1), "
     f"{_number(_TOKEN)}, regexp_extract(t, r'{geo._TOKEN_RE}', 3))), ' ') END"),
    ("road_text(wkt STRING)", "STRING",
     "CASE WHEN road_kind(wkt) <> '' THEN 'MULTILINESTRING ' || CASE WHEN road_dimensions(wkt) = '' THEN '' ELSE road_dimensions(wkt) || ' ' END || "
     "coordinates_text(CASE WHEN road_kind(wkt) = 'LINESTRING' AND road_body(wkt) <> 'EMPTY' THEN '(' || road_body(wkt) || ')' ELSE road_body(wkt) END) END"),
    ("road_key_of(road_wkt STRING)", "BIGINT", "CASE WHEN road_wkt IS NOT NULL THEN xxhash64(road_wkt) END"),
    ("road_parts(road_wkt STRING)", "ARRAY<ARRAY<STRUCT<lon: DOUBLE, lat: DOUBLE>>>",
     r"transform(regexp_extract_all(road_wkt, r'\(([^()]*)\)', 1), p -> transform(split(p, ','), c -> "
     "named_struct('lon', CAST(split(trim(c), ' ')[0] AS DOUBLE), 'lat', CAST(split(trim(c), ' ')[1] AS DOUBLE))))"),
]


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session; returns their names."""
    for name, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} RETURNS {result} RETURN {body}")
    return [name.partition("(")[0] for name, *_ in FUNCTIONS]
