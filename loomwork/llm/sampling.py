"""Bounded, seeded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id as text, modulo 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def held_out(doc_id: str = "doc_id") -> Column:
    """Remainder 2 is held out; a null doc_id is not."""
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_label: int, chars: int, seed: int
) -> pd.DataFrame:
    """At most ``per_label`` documents of each label, with their text: doc_id, label, text.

    ``labels`` has doc_id and a column ``label`` without nulls. Each label's documents are
    dealt over ``per_label`` cells by a seeded hash, and the smallest hash of a cell is
    taken; so no label's documents meet in one task. Of texts longer than ``chars``, a
    seeded window of that length is taken, which bounds what reaches the driver.
    """
    order = F.xxhash64(F.lit(seed), "doc_id")
    cell = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(per_label))
    chosen = (
        labels.where(F.col("doc_id").isNotNull())
        .select("doc_id", F.col(label).alias("label"), order.alias("order"), cell.alias("cell"))
        .groupBy("label", "cell")
        .agg(F.min_by("doc_id", "order").alias("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    length = F.char_length("text")
    start = F.pmod(order, F.greatest(length - chars + 1, F.lit(1))).cast("int") + 1
    window = F.when(length <= chars, F.col("text")).otherwise(F.substring(F.col("text"), start, F.lit(chars)))
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", window.alias("text"))
    # the list of sampled ids has per_label rows for each label
    found = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    sample = pd.DataFrame([tuple(r) for r in found.collect()], columns=["doc_id", "label", "text"])
    return sample.drop_duplicates("doc_id").sort_values("doc_id", ignore_index=True)
