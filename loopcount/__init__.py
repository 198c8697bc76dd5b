"""Traffic detector counts on Spark: clean, place and profile quarter-hour volumes.

Everything is a DataFrame expression, join, aggregate, generator or writer; no Python UDFs.
The public entry points are in :mod:`loopcount.plans.jobs`.
"""

from loopcount.schemas import SLOT_MINUTES, SLOT_NAMES, SLOTS

__all__ = ["SLOTS", "SLOT_MINUTES", "SLOT_NAMES"]
