"""Day-of-week profile.

Detectors of a site are pooled (detector 'all'); the group key is site, weekday, point and
road text. The 96 slot sums and the record count are one hash aggregate, combined map-side
before the shuffle, so a hot group costs one partial row per map task. The road stands in the
key as its 64-bit key (equal texts have equal keys, no road is NULL, one group); its text is
attached to the aggregated rows from a small table of roads, so observations are read once.
Without that table the text itself is the key. Only aggregated rows are exploded into 96 slots.

Sums and counts can be merged: ``monthly_state`` keeps them by month, an import replaces those of
the weekdays and months that it touched, and ``from_state`` adds up what is stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loopcount.functions import geo
from loopcount.functions.slots import slot_array
from loopcount.schemas import PROFILE_STATE_SCHEMA, SLOT_MINUTES, SLOTS

GROUP_KEYS = ["site", "day_of_week", "point_wkt", "road_wkt"]
ALL_DETECTORS = "all"

PROFILE_COLUMNS = [
    "feature_id", "site", "detector", "day_of_week", "slot", "time_of_day", "avg_vehicle_count",
    "num_features", "point_wkt", "lon", "lat", "road_wkt",
]


def slot_sums(observations: DataFrame, roads: DataFrame | None = None, more_keys: tuple[str, ...] = ()) -> DataFrame:
    """A2: per group, BIGINT sums of the 96 slots and the number of records.

    roads: (road_key, road_wkt) of all roads of the observations, hinted as measured."""
    road = "road_wkt" if roads is None else "road_key"
    sums = observations.groupBy("site", "day_of_week", *more_keys, "point_wkt", road).agg(
        slot_array("sum(volumes[{i}])").alias("sums"),
        F.count(F.lit(1)).alias("num_features"),
        F.max("lon").alias("lon"),
        F.max("lat").alias("lat"))
    return sums if roads is None else sums.join(roads.select("road_key", "road_wkt"), "road_key", "left")


def monthly_state(observations: DataFrame, roads: DataFrame | None = None) -> DataFrame:
    """A2 by month: what ``from_state`` needs of the observations."""
    return slot_sums(observations, roads, ("obs_month",)).select(*PROFILE_STATE_SCHEMA.fieldNames())


def merged_state(state: DataFrame) -> DataFrame:
    """The sums of all months of a state, as ``slot_sums`` of their observations."""
    return state.groupBy("site", "day_of_week", "point_wkt", "road_wkt").agg(
        slot_array("sum(sums[{i}])").alias("sums"),
        F.sum("num_features").alias("num_features"),
        F.max("lon").alias("lon"),
        F.max("lat").alias("lat"))


def _slot_constants() -> Column:
    """Literal ARRAY<STRUCT<slot, time_of_day, hhmm>> for the 96 slots (F3 and the time part
    of F5 computed once, not per output row)."""
    items = []
    for i in range(SLOTS):
        minutes = i * SLOT_MINUTES
        hhmm = f"{minutes // 60:02d}:{minutes % 60:02d}"
        items.append(f"named_struct('slot', {i}, 'time_of_day', TIMESTAMP_NTZ'1970-01-01 {hhmm}:00', "
                     f"'hhmm', '{hhmm}')")
    return F.expr("array(" + ", ".join(items) + ")")


def dow_profile(observations: DataFrame, roads: DataFrame | None = None) -> DataFrame:
    """One row per group and slot; mean = slot sum / records in the group."""
    return profile_rows(slot_sums(observations, roads))


def from_state(state: DataFrame) -> DataFrame:
    """The profile of the observations that a stored state stands for."""
    return profile_rows(merged_state(state))


def profile_rows(sums: DataFrame) -> DataFrame:
    """A3, T2, F3, F5 on the groups' sums."""
    zipped = F.arrays_zip(F.col("sums").alias("slot_sum"), _slot_constants().alias("c"))
    exploded = sums.select(
        *GROUP_KEYS, "num_features", "lon", "lat", F.inline(zipped))
    return exploded.select(
        F.concat_ws("-", "site", F.lit(ALL_DETECTORS), "day_of_week", F.col("c.hhmm")).alias("feature_id"),
        "site", F.lit(ALL_DETECTORS).alias("detector"), "day_of_week",
        F.col("c.slot").alias("slot"), F.col("c.time_of_day").alias("time_of_day"),
        (F.col("slot_sum") / F.col("num_features")).alias("avg_vehicle_count"),
        "num_features", *[geo.with_srid(F.col(c), c) for c in ("point_wkt", "lon", "lat", "road_wkt")])
