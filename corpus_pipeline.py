"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir); ``docs`` has the columns of ``documents``.
All but the last stage return those columns; what they remove is gone for good.
Null texts and ids, repeated rows and empty tables go through every stage, and further
columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logloom.llm import decontam, near_dup, packing, registry, substring, toxicity
from logloom.llm.common import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of the labelled ones doesn't reject.

    Null and empty texts have no toxic words and stay; without labels all stay.
    """
    return toxicity.keep_clean(docs, toxicity.fit(docs, registry.table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id.

    Null ids and texts without words are linked with nothing and stay; rows that
    repeat a kept doc_id stay.
    """
    return near_dup.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one, or place, holds.

    A document of which nothing is left goes; null ids and texts stay as they are.
    """
    return substring.without_repeats(docs)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark items.

    A document of which nothing is left goes; null texts stay; an empty benchmark
    changes nothing.
    """
    return decontam.without_contamination(docs, registry.table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents, placed in sequences.

    A null text counts as empty and gives one piece, the end id; long ones give
    several; an empty table gives no rows.
    """
    return packing.pack_documents(docs, registry.TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", cut_benchmark_passages),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the similarity joins.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again."""
    docs, scratch = registry.table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
