"""Broadcast a lookup only after measuring it.

The lookups (points, roads, reduced layout) are bounded by the road network, not by the
volume of counts, but that is an assumption about the input. ``measured`` writes the lookup to
the shared folder once, measures rows and bytes in one small aggregate, and hints a broadcast
only under the limit; above it the join is left to the planner (shuffle join, adaptive skew
handling). So building a lookup runs two small jobs; nothing stays persisted in the session.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loopcount.session import stored

log = logging.getLogger(__name__)

DEFAULT_MAX_BYTES = 128 * 1024 * 1024
MAX_BYTES_CONF = "loopcount.broadcast.maxBytes"


class EmptyLookup(ValueError):
    """A lookup that must have rows has none."""


@dataclass(frozen=True)
class Measured:
    df: DataFrame
    rows: int
    bytes: int
    broadcast: bool
    limit: int


def _width(c: Column, t: T.DataType) -> Column:
    """Estimated bytes of a value: text by its length, arrays by their elements."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    if isinstance(t, T.ArrayType) and isinstance(t.elementType, T.ArrayType):
        inner = F.aggregate(c, F.lit(0), lambda acc, x: acc + F.coalesce(F.size(x), F.lit(0)) * 16 + 16)
        return F.coalesce(inner, F.lit(0)) + F.lit(16)
    if isinstance(t, T.ArrayType):
        return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c)) * F.lit(16) + F.lit(16)
    return F.lit(8)


def estimated_row_bytes(df: DataFrame) -> Column:
    widths = [_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    total = widths[0]
    for w in widths[1:]:
        total = total + w
    return total.cast("bigint")


def _limit(df: DataFrame, max_bytes: int | None) -> int:
    return max_bytes if max_bytes is not None else int(df.sparkSession.conf.get(MAX_BYTES_CONF, str(DEFAULT_MAX_BYTES)))


def measured(df: DataFrame, label: str, max_bytes: int | None = None, needs_rows: bool = False) -> Measured:
    limit = _limit(df, max_bytes)
    return measured_table(stored(df, label.replace(" ", "-")), label, limit, needs_rows)


def measured_table(df: DataFrame, label: str, max_bytes: int | None = None, needs_rows: bool = False) -> Measured:
    """``measured`` for a DataFrame that is a plain scan already."""
    limit = _limit(df, max_bytes)
    stats = df.agg(F.count(F.lit(1)).alias("rows"),
                   F.coalesce(F.sum(estimated_row_bytes(df)), F.lit(0)).alias("bytes")).first()
    rows, size = int(stats["rows"]), int(stats["bytes"])
    if needs_rows and not rows:
        raise EmptyLookup(f"no {label} found")
    if size <= limit:
        log.info("broadcasting %s: %d rows, ~%d bytes", label, rows, size)
        return Measured(F.broadcast(df), rows, size, True, limit)
    log.warning("%s is ~%d bytes (> %d): using a shuffle join", label, size, limit)
    return Measured(df, rows, size, False, limit)
