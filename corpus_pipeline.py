"""From raw documents to packed training sequences: keep good documents, keep those in a known
language, keep one of each group of near copies, pack the rest.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and returns a DataFrame, written
as Parquet and reread as the next stage's ``docs``. ``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loopcount.llm import stages
from loopcount.llm.common import stored, table

STAGES = [
    ("quality", stages.keep_good),
    ("language", stages.keep_known_language),
    ("near_copies", stages.keep_one_of_near_copies),
    ("packing", stages.pack),
]

#: No stage but the third can be expressed in SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
