"""The stages of ``corpus_pipeline.py``: (spark, docs, sf_dir) -> DataFrame.

Every stage works on all rows that the one before it kept. Rows without id pass the filters
like any other; empty and null texts go at the language stage, as no language accepts them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loopcount.llm import jaccard, language, packing, quality
from loopcount.llm.common import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that no language's model accepts."""
    return language.keep_known(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group linked by five-word shingles at 0.8 or more."""
    return jaccard.keep_one_of_each(docs, words=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
