"""Date and id expressions (F1, F2, F4; the slot times F3 and F5 are constants of the profile). All zone-free: nothing depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def interval_date(text: Column) -> Column:
    """date part of 'yyyy-MM-dd HH:mm:ss' (text before the first blank); invalid dates raise."""
    day = F.substring_index(F.trim(text), " ", 1)
    parsed = F.try_to_date(day, "yyyy-MM-dd")
    return F.when(day.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("invalid interval date: "), text))
                  ).otherwise(parsed)


def day_of_week(date: Column) -> Column:
    """short English weekday name, e.g. 'Tue'."""
    return F.date_format(date, "EEE")


def month(date: Column) -> Column:
    """Year and month as one number, e.g. 201201."""
    return F.year(date) * 100 + F.month(date)


def epoch_millis(date: Column) -> Column:
    """Milliseconds from 1970-01-01 to the start of ``date``."""
    return F.unix_date(date).cast("bigint") * F.lit(86_400_000)


def observation_id(site: Column, detector: Column, date: Column) -> Column:
    """'site-detector-epochMillis'; NULL if any part is."""
    return F.concat(site, F.lit("-"), detector, F.lit("-"), epoch_millis(date).cast("string"))
