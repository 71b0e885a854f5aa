"""Mixing sources to target weights by fitting subset sums.

Documents are counted by source and exact length in tokens. A source's target is met by
whole repeats of all its documents, then by a proportional share of every length that fits,
repeated while more than the knapsack's window is left, then by a bounded knapsack over the
lengths for what is left of the budget. Which documents of a length are taken follows a
seeded order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm.columns import unused, word_count
from loomwork.shared import cut_lineage


@dataclass(frozen=True)
class Mixture:
    #: Weights of the sources in code point order, null last; repeated from the start.
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    #: All targets together, as a share of all sizes.
    share: float = 1.0
    #: A source's target is at most so many times its size.
    repeats: int = 3
    #: Words of the remaining budget that the knapsack fits.
    window: int = 65_536
    #: Documents of a block of the seeded order.
    block_rows: int = 16_384
    seed: int = 42


#: Longest documents that the knapsack's budget has room for.
RESERVED = 4


def fitted(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int) -> np.ndarray:
    """How many documents of each length to take, so that their sum comes to ``budget``.

    The result is at most ``budget`` and at most ``counts``. Most is taken in proportion to
    the counts of the lengths that fit, again without those that no longer do, until at
    most ``window`` tokens are left or no spare document fits; what is left, a few times the
    longest document that fits, is a bounded knapsack by dynamic programming. Above the
    window documents are not given back to make room for others, so the sum can then miss
    ``budget`` by less than the shortest spare document.
    """
    taken = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return taken
    if budget >= total:
        return np.where(lengths > 0, counts, 0).astype(np.int64)
    left = budget
    while True:
        fits = (lengths > 0) & (lengths <= left) & (taken < counts)
        if not fits.any():
            break
        spare = np.where(fits, counts - taken, 0)
        reserve = min(window, RESERVED * int(lengths[fits].max()), left)
        exact = spare * min(1.0, (left - reserve) / int((lengths * spare).sum()))
        more = np.minimum(np.floor(exact), spare).astype(np.int64)
        left -= int((lengths * more).sum())
        for i in np.lexsort((-lengths, more - exact)):  # the largest remainder first
            if left <= window:
                break
            if lengths[i] <= left and more[i] < spare[i]:
                more[i] += 1
                left -= int(lengths[i])
        taken += more
        # above the window, a length was passed over as it no longer fits: once more without it
        if left <= window:
            break
    top = int(min(left, window))
    if top <= 0:
        return taken
    # first[s]: the item with which the sum s was first reached; items are 1, 2, 4 … documents
    # of a length, the last one what remains of its count
    items, first = [], np.full(top + 1, -1, dtype=np.int64)
    reached = np.zeros(top + 1, dtype=bool)
    reached[0] = True
    # a fixed order without regard to length, so that the knapsack favours none
    for i in np.random.default_rng(0).permutation(len(lengths)):
        size, spare = int(lengths[i]), int(counts[i] - taken[i])
        spare = min(spare, top // size) if size > 0 else 0
        part = 1
        while spare > 0 and not reached[top]:
            part = min(part, spare)
            spare -= part
            weight = part * size
            new = np.zeros(top + 1, dtype=bool)
            new[weight:] = reached[: top + 1 - weight]
            new &= ~reached
            first[new] = len(items)
            items.append((i, part, weight))
            reached |= new
            part *= 2
    at = int(np.flatnonzero(reached)[-1])
    while at > 0:
        i, part, weight = items[first[at]]
        taken[i] += part
        at -= weight
    return taken


def targets(sources: DataFrame, how: Mixture = Mixture()) -> DataFrame:
    """``sources`` (source, source_size) with the column target.

    A target is ``min(scale * weight, repeats * size)`` with the one scale at which the
    targets come to ``share`` of all sizes: what a full source cannot take is shared by
    weight among the others. The windows see one row per source.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in how.weights])
    place = (F.row_number().over(named) - 1) % len(how.weights) + 1
    rows = sources.withColumn("weight", F.element_at(weights, place.cast("int")))
    rows = rows.withColumn("most", F.col("source_size") * F.lit(float(how.repeats)))
    # in order of the scale at which a source is full, full ones come first
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    goal = F.sum("source_size").over(everything) * F.lit(float(how.share))
    rows = rows.withColumn(
        "scale",
        (goal - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward),
    )
    open_scale = F.when(F.col("scale") * F.col("weight") <= F.col("most"), F.col("scale"))
    # counting further sources as full only lowers the scale, so the first that fits is the largest
    scale = F.coalesce(F.max(open_scale).over(everything), F.lit(float("inf")))
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(
        F.least(scale * F.col("weight"), F.col("most"))
    )
    return rows.select("source", "source_size", target.alias("target"))


def _matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` of which the first may be null on both sides."""
    other = {k: f"_{k}" for k in keys}
    right = right.withColumnsRenamed(other)
    on = F.col(keys[0]).eqNullSafe(F.col(other[keys[0]]))
    for k in keys[1:]:
        on = on & (F.col(k) == F.col(other[k]))
    return left.join(right, on).drop(*other.values())


def mix(docs: DataFrame, how: Mixture = Mixture()) -> DataFrame:
    """Every document with the words that the mix takes of it.

    ``docs`` has ``doc_id``, ``text`` and ``source``; other columns are not read. Result:
    doc_id, size (words), source_size, target (of its source), copies, taken (words,
    repeats counted). A null source is a source of its own, the last one. A null or blank
    text has size 0 and is never taken. Rows that repeat a doc_id count on their own; of
    rows with equal doc_id and size it is open which is taken. An empty table gives an
    empty result. The same table always gives the same mix.

    A length that a third of all documents share is split over the blocks of the seeded
    order: blocks before the last taken document are taken whole, and only within its
    block documents are ranked.
    """
    order = F.xxhash64(F.lit(how.seed), "doc_id")
    sized = cut_lineage(docs.select("doc_id", "source", word_count("text").alias("size")))
    n = sized.count()
    blocks = max(1, -(-n // how.block_rows))
    sized = sized.withColumn("order", order)
    sized = sized.withColumn("block", F.pmod(F.shiftrightunsigned("order", 8), F.lit(blocks)).cast("int"))

    in_block = sized.groupBy("source", "size", "block").agg(F.count("*").alias("n"))
    cells = in_block.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = targets(totals, how)
    window = how.window

    def fit(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("size", ignore_index=True)
        lengths, counts = cells["size"].to_numpy(np.int64), cells["n"].to_numpy(np.int64)
        size = int(cells["source_size"].iloc[0])
        goal = round(float(cells["target"].iloc[0]))
        whole = goal // size if size else 0
        more = fitted(lengths, counts, goal - whole * size, window)
        return cells.assign(whole=whole, more=more)[
            ["source", "size", "source_size", "target", "whole", "more"]
        ]

    fits = (
        _matched(cells, goals, ["source"])
        .groupBy("source")
        .applyInPandas(
            fit, "source string, size bigint, source_size bigint, target double, whole int, more bigint"
        )
    )
    ahead = (
        Window.partitionBy("source", "size")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shares = (
        _matched(in_block, fits, ["source", "size"])
        .withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        .withColumn("extra", F.greatest(F.lit(0), F.least("n", F.col("more") - F.col("ahead"))))
        .drop("n", "more", "ahead")
    )
    chosen = _matched(sized, shares, ["source", "size", "block"])
    ranked = Window.partitionBy("source", "size", "block").orderBy("order", "doc_id")
    one_more = (F.row_number().over(ranked) <= F.col("extra")).cast("int")
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + one_more)
    return chosen.withColumn("copies", copies.cast("int")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def draw(docs: DataFrame, how: Mixture = Mixture()) -> DataFrame:
    """The mix: rows of ``docs``, with all their columns, as often as they are taken.

    Rows that repeat a doc_id are each drawn as often as the least drawn of them.
    """
    doc_id, copies, copy = (unused(docs, c) for c in ("_doc_id", "_copies", "_copy"))
    taken = mix(docs, how).groupBy("doc_id").agg(F.min("copies").alias("n")).where("n > 0")
    taken = taken.select(F.col("doc_id").alias(doc_id), F.sequence(F.lit(1), "n").alias(copies))
    drawn = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(doc_id)))
    return drawn.withColumn(copy, F.explode(copies)).select(*[F.col(f"`{c}`") for c in docs.columns])
