"""Row-level cleaning of raw volume rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loopcount.functions import clean
from loopcount.functions.slots import slot_columns
from loopcount.schemas import SLOT_NAMES

KEYS = ["site", "qt_interval", "detector"]


def _where(raw: DataFrame, condition: Column) -> DataFrame:
    return raw.where(clean.checked(condition, F.col("raw"), [F.col(k) for k in KEYS]))


def clean_volumes(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows with a usable count -> site, qt_interval, detector, volumes ARRAY<INT> (96), and the
    columns ``keep`` (the order of rows)."""
    return _where(raw, clean.is_usable(F.col("raw"))).select(*KEYS, clean.cleaned("raw").alias("volumes"), *(keep or []))


def dropped_volumes(raw: DataFrame) -> DataFrame:
    """Rows the cleaner drops: no count present and >= 0."""
    return _where(raw, ~clean.is_usable(F.col("raw"))).select(*KEYS)


def wide(volumes: DataFrame, keys: list[str]) -> DataFrame:
    """The 96-element array as columns V00..V95."""
    return volumes.selectExpr(*[f"`{k}`" for k in keys], *slot_columns("volumes[{i}]", SLOT_NAMES))
