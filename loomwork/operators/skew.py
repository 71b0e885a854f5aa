"""Joins that stay balanced when one key holds a large part of the rows.

Spark's adaptive skew join splits a hot partition when both inputs of the join
come straight from a shuffle. It cannot do so when one input is aggregated on the
join key, or already laid out by it. ``attach`` covers those joins: the rows of a
hot key are spread over several salts, and the key's table rows are repeated once
per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.shared import packed

# A key with more than this share of all rows is hot, and there can be no more such
# keys than its inverse, which bounds what is broadcast.
HOT_SHARE = 1e-5
# Salts of null keys, which match nothing but still travel in an outer join.
NULL_SALTS = 1000
# Rows of a hot key that go to one salt.
SALT_ROWS = 1_000_000

# Memory that a table may take to be sent to every executor, by its rows and their types.
SENT_BYTES = 64 << 20

SALT = "_salt"


def hot_keys(counts: DataFrame, keys: list[str], rows: str, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Every key with more than ``salt_rows`` rows and more than ``HOT_SHARE`` of all rows.

    With its number of salts. A key that is not listed holds too few rows to matter to
    the task that gets it.
    """
    total = counts.agg(F.sum(rows)).scalar()
    return counts.where(
        (F.col(rows) > salt_rows) & (F.col(rows) > total * HOT_SHARE)
    ).select(*keys, F.ceil(F.col(rows) / salt_rows).cast("int").alias("_salts"))


def salted(df: DataFrame, keys: list[str], hot: DataFrame, spread: list[str]) -> DataFrame:
    """``df`` with a salt: the hash of the ``spread`` columns for hot keys, else 0.

    Null keys match nothing but still travel in an outer join, so they are spread too.
    """
    spread_hash = F.xxhash64(*spread)
    any_null = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    salt = (
        F.when(any_null, F.pmod(spread_hash, F.lit(NULL_SALTS)))
        .when(F.col("_salts").isNotNull(), F.pmod(spread_hash, F.col("_salts")))
        .otherwise(0)
    )
    return df.join(F.broadcast(hot), keys, "left").withColumn(SALT, salt.cast("int")).drop("_salts")


def repeated(table: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """``table`` with each hot key's rows once per salt."""
    salts = F.coalesce("_salts", F.lit(1))
    return each_salt(table.join(F.broadcast(hot), keys, "left").withColumn("_salts", salts))


def each_salt(table: DataFrame) -> DataFrame:
    """One row per salt, from a table with the column ``_salts``."""
    numbers = F.sequence(F.lit(0), F.col("_salts") - 1)
    return table.withColumn(SALT, F.explode(numbers)).drop("_salts")


def attach(
    df: DataFrame,
    table: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "inner",
    rows: str | None = None,
    counts: DataFrame | None = None,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """Join ``table`` to ``df`` on ``keys``, hot keys split over salts.

    ``spread`` names columns of ``df`` that differ between rows of one key. The rows
    of ``df`` per key are counted, unless ``counts`` has them in ``_rows``, or the
    table itself in the column ``rows``. In the last case a key repeats by its own
    count, without looking it up among the hot keys; copies that no salt asks for
    match nothing.
    """
    if rows is not None:
        hot = hot_keys(table, keys, rows, salt_rows)
        salts = F.greatest(F.ceil(F.col(rows) / salt_rows).cast("int"), F.lit(1))
        copies = each_salt(table.withColumn("_salts", salts))
    else:
        if counts is None:
            counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        hot = hot_keys(counts, keys, "_rows", salt_rows)
        copies = repeated(table, keys, hot)
    return salted(df, keys, hot, spread).join(copies, [*keys, SALT], how).drop(SALT)


def look_up(
    df: DataFrame, table: DataFrame, keys: list[str], spread: list[str], rows: str, salt_rows: int = SALT_ROWS
) -> DataFrame:
    """``df`` with the columns of ``table``, which is made once, has ``df``'s rows per key in ``rows`` and loses it.

    A small table is sent to every executor, and ``df`` stays where it is; else as ``attach``.
    """
    made, small = sent_if_small(packed(table))
    if small:
        return df.join(made.drop(rows), keys, "left")
    return attach(df, made, keys, spread, "left", rows=rows, salt_rows=salt_rows).drop(rows)


def sent_if_small(table: DataFrame, limit: int = SENT_BYTES) -> tuple[DataFrame, bool]:
    """``table`` to be broadcast if it is small, else as it is, and whether it is small.

    Its rows are counted, so it should be a written one. Adaptive execution measures a
    side of a join as well, but only after the other side was shuffled for it.
    """
    small = table.count() * table._jdf.schema().defaultSize() <= limit
    return (F.broadcast(table) if small else table), small


def pairs_within(
    rows: DataFrame,
    keys: list[str],
    unit: str,
    size: str,
    block_rows: int,
    carried: list[str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """The keys, ``<unit>_1`` < ``<unit>_2`` and the carried columns of both, for every pair.

    ``rows`` has the number of rows of each key in ``size``. A key of more than
    ``block_rows`` rows is cut into blocks by a hash of the unit, and every pair of
    blocks is a task's work of its own. They are dealt to ``tasks`` partitions where that
    is given, as adaptive execution goes by the rows that meet, not by their pairs.
    """
    blocks = F.greatest(F.ceil(F.col(size) / block_rows).cast("int"), F.lit(1))
    dealt = rows.select(
        *keys, unit, *(carried or []), blocks.alias("_blocks"),
        F.pmod(F.xxhash64(unit), blocks).cast("int").alias("_own"),
    )
    others = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))

    def side(number: int) -> DataFrame:
        own, other = ("_i", "_j") if number == 1 else ("_j", "_i")
        rows = dealt.select(
            *keys,
            *[F.col(c).alias(f"{c}_{number}") for c in [unit, *(carried or [])]],
            F.col("_own").alias(own),
            others.alias(other),
        )
        return rows.repartition(tasks, *keys, "_i", "_j") if tasks else rows

    met = side(1).join(side(2), [*keys, "_i", "_j"])
    return met.where(F.col(f"{unit}_1") < F.col(f"{unit}_2")).drop("_i", "_j")


def typed(df: DataFrame, column: str, value) -> Column:
    """``value`` as a literal of the column's type; null when it is no such value."""
    return F.lit(value).try_cast(df.schema[column].dataType)
