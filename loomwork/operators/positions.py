"""Rows at their places in an order, spread over many partitions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.shared import packed

BLOCK, POSITION = "_block", "_position"
_LOW_BITS = 33


def sorted_positions(df: DataFrame, order_by: list[str]) -> DataFrame:
    """``df`` sorted as a whole, with block and position inside the block.

    The sort splits the rows over partitions by range; a partition is a block.
    The result is written, as ids given by partition must not change later.
    """
    row = F.monotonically_increasing_id()
    return packed(df.orderBy(*order_by).withColumn("_row", row)).select(
        *df.columns,
        F.shiftright("_row", _LOW_BITS).cast("int").alias(BLOCK),
        (F.col("_row").bitwiseAND(F.lit((1 << _LOW_BITS) - 1)) + 1).alias(POSITION),
    )


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; ``right`` gives its other columns only."""
    names = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys])
    return left.join(right, on, how).drop(*names.values())
