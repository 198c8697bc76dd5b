"""Scans of the stored tables (S7, S8). Filters on ``day_of_week`` and ``obs_month`` prune
partitions; a box skips row groups by the ranges of ``place`` it covers, flow ids and sites skip
them by their Bloom filters (K4)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopcount.functions import curve
from loopcount.functions.cql import cql_filter


def read_table(spark: SparkSession, path: str, *, day_of_week: str | list[str] | None = None,
               first_date: date | None = None, last_date: date | None = None, box: tuple[float, float, float, float] | None = None,
               flows: list[str] | None = None, sites: list[str] | None = None, where: str | None = None, cql: str | None = None) -> DataFrame:
    """S7 scan; S8 attribute filter. ``day_of_week`` and the months of the two dates (both
    included) become partition filters; ``box`` is (lon, lat) of its lower and of its upper corner,
    edges included; ``flows`` and ``sites`` are the wanted flow ids and sites; ``where`` is SQL, ``cql`` a
    filter in the words of the declared type (``functions.cql``)."""
    df = spark.read.parquet(path)
    if day_of_week is not None:
        days = [day_of_week] if isinstance(day_of_week, str) else list(day_of_week)
        df = df.where(F.col("day_of_week").isin(days))
    for bound, op in ((first_date, ">="), (last_date, "<=")):
        if bound is not None:
            df = df.where(f"obs_month {op} {bound.year * 100 + bound.month} AND obs_date {op} DATE'{bound.isoformat()}'")
    if box is not None:
        df = df.where(curve.in_box(*box))
    for name, wanted in (("hf_id", flows), ("site", sites)):
        if wanted is not None:
            df = df.where(F.col(name).isin(wanted))
    if where:
        df = df.where(where)
    return df.where(cql_filter(cql)) if cql else df
