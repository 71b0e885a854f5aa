"""Shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size,
``(offset + j * skip) mod size``. The shards take turns; at its turn a shard claims the
first free slot of its order. A row goes to the shard of the slot that its key hashes to.
The table has ``size`` short names whatever the data's size, and goes to the tasks as a
literal, so placing a row is one array access. When a shard is added or lost, nearly all
other slots keep their shard.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.shared import working_path

SHARDS = [f"shard-{i:02d}" for i in range(32)]
#: A prime of over 100 times the number of shards: shares differ by about 1 %.
TABLE_SIZE = 4099
MAX_TABLE_SIZE = 1_000_003


def digest_number(text: str) -> int:
    """The first 15 hex digits of the md5, below 2^60."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[str]:
    """The shard of every slot.

    No shards, repeated names, names with a comma, a size that is no prime, over
    ``MAX_TABLE_SIZE`` or under the number of shards are errors.
    """
    if not shards or len(set(shards)) != len(shards) or any("," in s for s in shards):
        raise ValueError("shards need distinct names without commas")
    if size > MAX_TABLE_SIZE or size < len(shards):
        raise ValueError("the table's size is out of range")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table's size must be a prime")
    place = [digest_number(f"{s}#offset") % size for s in shards]
    skip = [digest_number(f"{s}#skip") % (size - 1) + 1 for s in shards]
    table: list[str | None] = [None] * size
    claimed = 0
    while True:
        for i, shard in enumerate(shards):
            while table[place[i]] is not None:
                place[i] = (place[i] + skip[i]) % size
            table[place[i]] = shard
            claimed += 1
            if claimed == size:
                return table


def slot_of(key: str | Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key, by the md5 of its text; null counts as the empty text."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(size)).cast("int")


def place(
    docs: DataFrame,
    key: str = "doc_id",
    shards: list[str] | None = None,
    size: int = TABLE_SIZE,
    slot: str = "slot",
    shard: str = "shard",
) -> DataFrame:
    """``docs`` with the columns ``slot`` and ``shard``; columns of these names are replaced.

    Rows with equal keys go to one shard, null keys to that of the empty text. A table
    without rows stays empty. No shuffle.
    """
    names = F.split(F.lit(",".join(lookup_table(shards or SHARDS, size))), ",")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (slot, shard)]
    at = slot_of(F.col(f"`{key}`"), size)
    return docs.select(*kept, at.alias(slot)).withColumn(
        shard, F.element_at(names, F.col(f"`{slot}`") + 1)
    )


#: Rows of a file, about.
FILE_ROWS = 100_000


def write_shards(placed: DataFrame, path: str, file_rows: int = FILE_ROWS, shard: str = "shard") -> None:
    """The whole rows of ``placed``, in one folder per shard below the new folder ``path``.

    The rows of every shard are counted first, and dealt over as many files as they need by
    a hash of the whole row; so a shard or key that holds a large part of all rows is many
    tasks and files. As many counts as there are shards reach the driver. Rows shuffle once.
    Repeated rows stay; a null shard has a folder of its own; an empty table gives none.
    """
    name = F.col(f"`{shard}`")
    files = F.ceil(F.count(F.lit(1)) / file_rows).cast("int")
    counted = {r[0]: r[1] for r in placed.groupBy(name).agg(files).collect()}
    known = F.create_map(*[F.lit(x) for pair in counted.items() if pair[0] is not None for x in pair])
    most = F.coalesce(F.try_element_at(known, name) if len(counted) > (None in counted) else F.lit(None), F.lit(counted.get(None, 1)))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns]), most.cast("int"))
    dealt = placed.repartition(max(1, sum(counted.values())), name, salt)
    dealt.write.partitionBy(shard).parquet(path)


def read_shards(placed: DataFrame, path: str) -> DataFrame:
    """What ``write_shards`` wrote of ``placed``, with its columns."""
    return placed.sparkSession.read.schema(placed.schema).parquet(path).select(placed.columns)


def shard_documents(docs: DataFrame, file_rows: int = FILE_ROWS) -> DataFrame:
    """Place ``docs``, write whole rows to the shards of a new working folder, and read them back."""
    placed, path = place(docs), working_path(docs.sparkSession, "shards")
    write_shards(placed, path, file_rows)
    return read_shards(placed, path)
