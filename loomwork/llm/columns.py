"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: a word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def spread(docs: DataFrame, by: str = "doc_id") -> DataFrame:
    """``docs`` over all cores, where the table has fewer splits than that."""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() < cores:
        return docs.repartition(cores, by)
    return docs


def unused(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
