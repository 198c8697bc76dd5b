"""Schemas of inputs and target tables, slot naming (P14) and the target-schema check (K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# 96 quarter-hour counts per detector-day, named V00..V95.
SLOTS = 96
SLOT_MINUTES = 15
SLOT_NAMES = [f"V{i:02d}" for i in range(SLOTS)]

# Key columns of the raw volume file, in file order, before the 96 counts. The first
# and the third name must stand in a file's header; the other names are not known and free.
VOLUME_KEY_HEADER = ["NB_SCATS_SITE", "QT_INTERVAL_COUNT", "NB_DETECTOR"]
REQUIRED_VOLUME_HEADER = {0: "NB_SCATS_SITE", 2: "NB_DETECTOR"}

# The site-layout file by position; positions 1 and 2 are not used.
LAYOUT_HEADER = [
    "NB_SCATS_SITE", "UNUSED_1", "UNUSED_2", "DS_LOCATION", "NB_DETECTOR",
    "DT_GENERAL", "NB_LANE", "LANE_MVT", "LOC_MVT", "ID_HOMOGENEOUS_FLOW",
]

# Header names of the two geometry files.
POINT_HEADER = {"site": "SITE_NO", "wkt": "WKT"}
LINE_HEADER = {"left": "hfidl", "right": "hfidr", "wkt": "WKT"}


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


LAYOUT_CSV_SCHEMA = _strings(LAYOUT_HEADER)

COORD = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
ROAD_TYPE = T.ArrayType(T.ArrayType(COORD))

OBSERVATIONS_SCHEMA = T.StructType([
    T.StructField("feature_id", T.StringType()),
    T.StructField("site", T.StringType()),
    T.StructField("detector", T.StringType()),
    T.StructField("obs_date", T.DateType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("obs_month", T.IntegerType()),
    T.StructField("volumes", T.ArrayType(T.IntegerType())),
    T.StructField("point_wkt", T.StringType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("place", T.LongType()),
    T.StructField("ds_location", T.StringType()),
    T.StructField("nb_lane", T.StringType()),
    T.StructField("lane_mvt", T.StringType()),
    T.StructField("loc_mvt", T.StringType()),
    T.StructField("hf_id", T.StringType()),
    T.StructField("road_wkt", T.StringType()),
    T.StructField("road_key", T.LongType()),
    T.StructField("road", ROAD_TYPE),
])

#: The mergeable state of the profile: the sums of a group's records in one month.
PROFILE_STATE_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("obs_month", T.IntegerType()),
    T.StructField("point_wkt", T.StringType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("road_wkt", T.StringType()),
    T.StructField("sums", T.ArrayType(T.LongType())),
    T.StructField("num_features", T.LongType()),
])

DOW_PROFILE_SCHEMA = T.StructType([
    T.StructField("feature_id", T.StringType()),
    T.StructField("site", T.StringType()),
    T.StructField("detector", T.StringType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("slot", T.IntegerType()),
    T.StructField("time_of_day", T.TimestampNTZType()),
    T.StructField("avg_vehicle_count", T.DoubleType()),
    T.StructField("num_features", T.LongType()),
    T.StructField("point_wkt", T.StringType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("road_wkt", T.StringType()),
])


class SchemaMismatch(ValueError):
    """A DataFrame does not have the columns and types of its target table."""


def check_schema(df: DataFrame, target: T.StructType, table: str) -> DataFrame:
    """Fail before writing when ``df`` lacks a target column or has another type (K3).

    Extra columns are an error too; nullability is not compared. Returns ``df`` reordered
    to the target's column order.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in target.fields}
    problems = [f"missing {n}" for n in want if n not in have]
    problems += [f"unexpected {n}" for n in have if n not in want]
    problems += [
        f"{n}: {have[n].simpleString()} instead of {t.simpleString()}"
        for n, t in want.items() if n in have and _strip_nullability(have[n]) != _strip_nullability(t)
    ]
    if problems:
        raise SchemaMismatch(f"{table}: " + "; ".join(problems))
    return df.select(*[f.name for f in target.fields])


def _strip_nullability(t: T.DataType) -> T.DataType:
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_strip_nullability(t.elementType), True)
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _strip_nullability(f.dataType), True) for f in t.fields])
    return t
