"""From raw documents to encoded training text, stage by stage.

All stages but the last return the columns of ``documents``:

1. ``quality`` leaves out what the weak-label classifier rejects;
2. ``exact_dedup`` keeps, of equal texts, the row with the largest id;
3. ``near_dedup`` keeps one document of each group of near copies: five-word shingles,
   similarity of 0.8 or more;
4. ``decontaminate`` leaves out documents with a benchmark passage;
5. ``bpe`` encodes what is left and decodes it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, decontaminate, exact, near, quality
from millrace.llm.common import materialize, small_batches, table
from millrace.llm.queries import vocabulary

ORACLE_SQL = None  # SQL expresses none of the trained, hashed and approximate stages


def accepted(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return quality.good_rows(small_batches(docs))


def different(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return exact.without_copies(small_batches(docs))


def unlike(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return near.one_of_each(small_batches(docs))


def untainted(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.without_matches(small_batches(docs), table(spark, folder, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Ids, number of tokens and decoded text of every document that is left."""
    return bpe.round_trip(small_batches(docs).select("doc_id", "text"), vocabulary())


STAGES = [
    ("quality", accepted),
    ("exact_dedup", different),
    ("near_dedup", unlike),
    ("decontaminate", untainted),
    ("bpe", encoded),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply the stages to the documents; each result is written and read again."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
