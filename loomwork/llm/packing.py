"""Packing into optimal length buckets.

A text is cut into pieces of at most ``max_length`` tokens. The lengths of all pieces
make a global histogram of at most ``max_length`` numbers. Dynamic programming over it
finds the bucket boundaries with the least padding. Inside each bucket, pieces form
batches of as many rows as fit into the token budget.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm.columns import word_count


@dataclass(frozen=True)
class Packing:
    max_length: int = 2048
    buckets: int = 16
    #: Tokens of a batch with its padding.
    budget: int = 65_536
    #: Rows of a block of the seeded order; blocks are numbered side by side.
    block_rows: int = 16_384
    seed: int = 42


#: Fixed values of the seeded order: a prime and two multipliers below it.
PRIME, BY_DOC, BY_PIECE = 2_147_483_647, 1_103_515_245, 747_796_405


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The padded lengths of at most ``buckets`` buckets with the least total padding.

    ``lengths`` ascend. Each boundary is a length that occurs. Of equal solutions, that
    with fewer buckets, then with the smaller boundary before the last, and so on down.
    """
    m = len(lengths)
    if m == 0:
        return []
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    rows = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    # best[j]: least padding of the first j lengths; came[k][j]: where the last of k buckets begins
    best = lengths[np.arange(m)] * rows[1:] - tokens[1:]
    best = np.concatenate([[0], best])
    ends, came = [best[m]], [np.zeros(m + 1, dtype=np.int64)]
    for _ in range(1, min(buckets, m)):
        new, at = np.full(m + 1, np.iinfo(np.int64).max // 2), np.zeros(m + 1, dtype=np.int64)
        for j in range(1, m + 1):
            cost = best[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            at[j] = int(np.argmin(cost))
            new[j] = cost[at[j]]
        best = new
        best[0] = 0
        ends.append(best[m])
        came.append(at)
    k = int(np.argmin(ends))
    cuts, j = [], m
    while j > 0:
        cuts.append(int(lengths[j - 1]))
        j = int(came[k][j])
        k -= 1
    return cuts[::-1]


def pieces(docs: DataFrame, max_length: int) -> DataFrame:
    """Pieces of whole texts: doc_id, piece, start, length (in words)."""
    sized = docs.select("doc_id", word_count("text").alias("n"))
    last = F.greatest(F.ceil(F.col("n") / max_length), F.lit(1)).cast("int") - 1
    cut = sized.select("doc_id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("bigint") * max_length
    return cut.select(
        "doc_id",
        "piece",
        start.alias("start"),
        F.least(F.lit(max_length).cast("bigint"), F.col("n") - start).alias("length"),
    )


def pack(docs: DataFrame, how: Packing = Packing()) -> DataFrame:
    """Every piece with its bucket and batch.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Lengths are words.
    Result: doc_id, piece, start, length, bucket (padded length), batch (its number in
    the bucket), slot (row in the batch). A null or blank text has one piece of length 0
    without bucket, batch and slot. Repeated rows are packed as often as they occur; a
    null doc_id orders before the others. An empty table gives an empty result.

    The histogram on the driver has at most ``how.max_length`` rows. Pieces shuffle once,
    as small rows, by bucket and block of the seeded order, so a bucket of any size is
    numbered by many tasks.
    """
    cut = pieces(docs, how.max_length)
    histogram = cut.where("length > 0").groupBy("length").agg(F.count("*").alias("rows")).collect()
    histogram.sort()
    lengths, counts = np.array([r[0] for r in histogram]), np.array([r[1] for r in histogram])
    cuts = boundaries(lengths, counts, how.buckets)
    blocks = max(1, -(-int(counts.sum()) // how.block_rows)) if cuts else 1

    bucket = F.lit(None).cast("int")
    for edge in reversed(cuts):
        bucket = F.when(F.col("length") <= edge, F.lit(edge)).otherwise(bucket)
    bucket = F.when(F.col("length") > 0, bucket)
    doc = F.pmod(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)), F.lit(PRIME))
    mixed = F.pmod(doc * BY_DOC + (F.col("piece") * F.lit(BY_PIECE).cast("bigint") + how.seed), F.lit(PRIME))
    rows = cut.withColumn("bucket", bucket).withColumn("mixed", mixed)
    rows = rows.withColumn("block", (F.col("mixed") % blocks).cast("int"))

    placed = rows.where("bucket IS NOT NULL")
    sizes = placed.groupBy("bucket", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket", "block").orderBy("mixed", "doc_id", "piece")
    rank = F.col("before") + F.row_number().over(inside) - 1
    capacity = F.greatest(F.floor(F.lit(how.budget) / F.col("bucket")), F.lit(1))
    packed = placed.join(offsets, ["bucket", "block"]).withColumn("rank", rank)
    columns = ["doc_id", "piece", "start", "length", "bucket"]
    return packed.select(
        *columns,
        F.floor(F.col("rank") / capacity).cast("bigint").alias("batch"),
        (F.col("rank") % capacity).cast("int").alias("slot"),
    ).unionByName(
        rows.where("bucket IS NULL").select(*columns), allowMissingColumns=True
    )
