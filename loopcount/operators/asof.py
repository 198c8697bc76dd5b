"""J3 with its date condition: the layout that is valid on the day of a count.

A detector-day gets the layout row of its detector with the latest date that is not after the
day; of rows with one date the first in ``order``. Counts and layouts become one stream, sorted
by detector and date in one exchange; a running window hands the latest layout on to the counts
behind it. So there is no range join, and a detector's rows, bounded by its days and layouts,
are streamed (a frame that begins at the first row keeps one layout, not the rows).

A layout without a date is valid from the beginning. Counts before a detector's first layout
have none (null columns), as detectors without layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loopcount.functions import dates
from loopcount.operators.lookups import LAYOUT_COLUMNS

LAYOUT_VALUES = LAYOUT_COLUMNS[2:]
_KEY = ["site", "detector"]


def valid_from(layouts: DataFrame):
    """The date of a layout row; malformed dates raise."""
    text = F.trim(F.col("dt_general"))
    return F.coalesce(dates.interval_date(F.when(text != "", text)), F.lit("0001-01-01").cast("date"))


def layout_as_of(volumes: DataFrame, layouts: DataFrame, order: list) -> DataFrame:
    """``volumes`` (site, detector, obs_date, ...) with the columns of the layout valid on ``obs_date``."""
    layouts = layouts.where(F.col("site").isNotNull() & F.col("detector").isNotNull())
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = layouts.select(*_KEY, valid_from(layouts).alias("_day"), F.struct(*LAYOUT_VALUES).alias("_layout"),
                          F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("_order"))
    payload = [c for c in volumes.columns if c not in _KEY]
    counts = volumes.select(*_KEY, F.col("obs_date").alias("_day"), F.struct(*payload).alias("_row"))
    both = counts.unionByName(rows, allowMissingColumns=True)
    # Of one date layouts come before counts, and the first in ``order`` last, next to the counts.
    by = Window.partitionBy(*_KEY).orderBy("_day", F.col("_row").isNotNull(), F.col("_order").desc())
    running = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_valid", F.last("_layout", ignorenulls=True).over(running)).where(F.col("_row").isNotNull())
    return found.select(*_KEY, "_row.*", *[F.col(f"_valid.{c}").alias(c) for c in LAYOUT_VALUES])
