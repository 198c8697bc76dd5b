"""Feature types declared as text, and catalog tables made from them (K3).

A type is a comma-separated list of ``name:Type:options``; a ``*`` marks its geometry, ``index=...``
an attribute that is searched by, ``srid=...`` a geometry's reference system; the date that is
searched by is named beside it. ``parse`` reads such a text; ``schema`` turns it into the schema
that the table has here, ``access_paths`` into partitions, order and Bloom filters (K4). So both
target tables follow from their declarations, and ``create_table`` makes the catalog's table
before anything is written.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from loopcount.functions.geo import SRID_METADATA
from loopcount.schemas import ROAD_TYPE, SLOT_NAMES
from loopcount.session import table_exists

# The declarations of the two types, and the dates they are searched by.
VOLUME_TYPE = "ScatsVolumeData"
PROFILE_TYPE = "ScatsDayOfWeekBySite"
DECLARED = {
    VOLUME_TYPE: ",".join(["*geometry:Point:srid=4326", "NB_SCATS_SITE:String:index=join", "QT_INTERVAL_COUNT:Date", "NB_DETECTOR:String",
                           "DAY_OF_WEEK:String:index=join", *[f"{n}:String" for n in SLOT_NAMES], "DS_LOCATION:String", "NB_LANE:String", "LANE_MVT:String",
                           "LOC_MVT:String", "HF:String:index=join", "unique_road:MultiLineString:srid=4326"]),
    PROFILE_TYPE: ",".join(["*geometry:Point:srid=4326", "NB_SCATS_SITE:String:index=full", "NB_DETECTOR:String", "DAY_OF_WEEK:String:index=full",
                            "TIME_OF_DAY:Date", "AVERAGE_VEHICLE_COUNT:Double", "NUM_OF_FEATURES:Integer", "unique_road:MultiLineString:srid=4326"]),
}
DATE_KEYS = {VOLUME_TYPE: "QT_INTERVAL_COUNT", PROFILE_TYPE: "TIME_OF_DAY"}

# The column of each attribute (the 96 counts are one array).
COLUMNS = {"NB_SCATS_SITE": "site", "QT_INTERVAL_COUNT": "obs_date", "NB_DETECTOR": "detector", "DAY_OF_WEEK": "day_of_week", "DS_LOCATION": "ds_location",
           "NB_LANE": "nb_lane", "LANE_MVT": "lane_mvt", "LOC_MVT": "loc_mvt", "HF": "hf_id", "TIME_OF_DAY": "time_of_day",
           "AVERAGE_VEHICLE_COUNT": "avg_vehicle_count", "NUM_OF_FEATURES": "num_features", "unique_road": "road_wkt", "geometry": "point_wkt"}
TYPES = {"String": T.StringType(), "Integer": T.LongType(), "Double": T.DoubleType(), "Date": T.DateType(), "Point": T.StringType(), "MultiLineString": T.StringType()}


class BadDeclaration(ValueError):
    """A feature type's text that cannot be read."""


@dataclass(frozen=True)
class Attribute:
    name: str
    type: str
    options: dict[str, str] = field(default_factory=dict)
    default: bool = False


@dataclass(frozen=True)
class FeatureType:
    name: str
    attributes: tuple[Attribute, ...]
    date_key: str | None = None

    @property
    def geometry(self) -> Attribute | None:
        return next((a for a in self.attributes if a.default), None)

    @property
    def indexed(self) -> list[Attribute]:
        return [a for a in self.attributes if a.options.get("index", "false") != "false"]


def parse(name: str, text: str, date_key: str | None = None) -> FeatureType:
    """The type that a declaration tells; unknown types, repeated names and a second default geometry raise."""
    found: dict[str, Attribute] = {}
    for item in text.split(","):
        m = re.fullmatch(r"\s*(\*?)(\w+):(\w+)((?::\w+=[^:]*)*)\s*", item)
        if m is None:
            raise BadDeclaration(f"{name}: cannot read {item!r}")
        star, attribute, kind, options = m.groups()
        if kind not in TYPES:
            raise BadDeclaration(f"{name}: {attribute} has the unknown type {kind}")
        if attribute in found or (star and any(a.default for a in found.values())):
            raise BadDeclaration(f"{name}: {attribute} is declared twice, or is a second geometry")
        found[attribute] = Attribute(attribute, kind, dict(o.strip().split("=", 1) for o in options.split(":") if o), bool(star))
    if date_key is not None and (date_key not in found or found[date_key].type != "Date"):
        raise BadDeclaration(f"{name}: {date_key} is no date")
    return FeatureType(name, tuple(found.values()), date_key)


def declared(name: str) -> FeatureType:
    return parse(name, DECLARED[name], DATE_KEYS[name])


def _is_slot(a: Attribute) -> bool:
    return a.name in SLOT_NAMES


def schema(kind: FeatureType) -> T.StructType:
    """The schema of the type's table: a column each attribute, and those that are made from them.

    The text of an id comes first. A date has the month it is partitioned by, or, without a
    day, its slot; a point its coordinates, and its place where the table is ordered by it; a
    road of single records its key and its nested coordinates; the 96 counts are one array."""
    out = [T.StructField("feature_id", T.StringType())]
    single = any(_is_slot(a) for a in kind.attributes)  # records, not groups of them
    for a in kind.attributes:
        if _is_slot(a):
            if a.name == SLOT_NAMES[0]:
                out.append(T.StructField("volumes", T.ArrayType(T.IntegerType())))
            continue
        column, geo = COLUMNS[a.name], {"metadata": SRID_METADATA if a.options.get("srid") == str(SRID_METADATA["srid"]) else None}
        if a.type == "Point":
            out += [T.StructField(column, T.StringType(), **geo), *[T.StructField(n, T.DoubleType(), **geo) for n in ("lon", "lat")]]
            out += [T.StructField("place", T.LongType())] if single else []
        elif a.type == "MultiLineString":
            out.append(T.StructField(column, T.StringType(), **geo))
            out += [T.StructField("road_key", T.LongType()), T.StructField("road", ROAD_TYPE, **geo)] if single else []
        elif a.name == kind.date_key and not single:
            out += [T.StructField("slot", T.IntegerType()), T.StructField(column, T.TimestampNTZType())]
        else:
            out.append(T.StructField(column, TYPES[a.type]))
            out += [T.StructField("obs_month", T.IntegerType())] if a.name == kind.date_key else []
    return T.StructType(out)


@dataclass(frozen=True)
class AccessPaths:
    """How a table is laid out for the searches that its type declares."""
    partitions: list[str]
    order: list[str]
    bloom: list[str]


def access_paths(kind: FeatureType) -> AccessPaths:
    """K4: the weekday and the date key's month are partitions; near places lie together; the other
    indexed attributes of single records have Bloom filters, those of groups are sorted by."""
    columns = schema(kind).fieldNames()
    partitions = [c for c in ("day_of_week", "obs_month") if c in columns]
    indexed = [COLUMNS[a.name] for a in kind.indexed if COLUMNS[a.name] not in partitions]
    single = "place" in columns
    return AccessPaths(partitions, (["place"] if single else []) + [c for c in ("site", "slot") if c in columns], indexed if single else [])


def create_table(spark: SparkSession, table: str, path: str, kind: FeatureType) -> None:
    """The catalog's table of a type at ``path``, made before the first write; an existing one of that
    name stays. The table is registered with the partitions that lie at the path already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema(kind).fields)
    by = ", ".join(access_paths(kind).partitions)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{path}'")
    if table_exists(spark, path):
        refresh_table(spark, table)


def refresh_table(spark: SparkSession, table: str) -> None:
    """Tell the catalog of the partitions that a write added."""
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)
