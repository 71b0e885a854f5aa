"""From documents to packed training batches, stage by stage.

Every stage gets ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``. A stage given no rows returns none, and columns beyond those of ``documents``
pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomwork.llm import exact_dedup, language_id, mixing, near_dedup, packing
from loomwork.shared import cut_lineage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected.

    A text that is null or has no letter goes. A null ``lang`` only means that nothing is
    learnt from the row. Repeated rows are judged each.
    """
    return language_id.drop_rejected(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id.

    A null text equals an empty one. A null doc_id stays only where its text has no other;
    of repeated rows one stays.
    """
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by four fifths of its five-word shingles.

    Of a group the smallest doc_id stays. A null or blank text is linked with nothing and
    stays. A row with a null doc_id always stays, as nothing tells it apart. Rows that
    repeat a doc_id stay or go together.
    """
    return near_dedup.drop_near_copies(docs, near_dedup.Sketching(words=5, percent=80))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document that is taken twice is two rows.

    A null source is a source of its own, the last one. A null or blank text has no words
    and is never taken. Rows that repeat a doc_id are each drawn as often as the least
    drawn of them.
    """
    return mixing.draw(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in length buckets and batches.

    A null or empty text is one piece without words. Repeated rows are packed each.
    """
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mix", mixed),
    ("pack", packed),
]

# sketches, gradient descent and knapsacks are beyond SQL; the tests hold the stages
# against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
