"""Expressions over all 96 slots, written as one SQL expression each.

One ``F.expr`` call per array instead of several Python ``Column`` calls per slot: the plan
is the same, but building it costs one round trip to the JVM instead of hundreds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loopcount.schemas import SLOTS


def slot_array(template: str, slots: int = SLOTS) -> Column:
    """``array(template(0), ..., template(95))``; ``{i}`` in the template is the slot index."""
    return F.expr("array(" + ", ".join(template.format(i=i) for i in range(slots)) + ")")


def slot_columns(template: str, names: list[str]) -> list[str]:
    """SQL select items ``template(i) AS name_i`` for ``selectExpr``."""
    return [f"{template.format(i=i)} AS `{n}`" for i, n in enumerate(names)]
