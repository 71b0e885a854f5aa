"""A NumPy kernel over all texts of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from loomwork.llm.kernels import row_slices

#: Bytes of text that a kernel gets at once, or one text.
SLICE = 1 << 21


def map_texts(
    docs: DataFrame,
    kernel: Callable[[pa.Array], list],
    fields: list[tuple[str, pa.DataType]],
    slice_bytes: int = SLICE,
) -> DataFrame:
    """doc_id and, for each text, what the kernel makes of it; a null text reaches it as null.

    Runs in the tasks that read ``docs``, batch by batch, without a shuffle.
    """
    schema = pa.schema([("doc_id", pa.int64()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in row_slices(batch.column(1), slice_bytes):
                made = kernel(batch.column(1).slice(start, end - start))
                arrays = [pa.array(x, type=t) for x, (_, t) in zip(made, fields)]
                ids = batch.column(0).slice(start, end - start)
                yield pa.RecordBatch.from_arrays([ids, *arrays], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(run, from_arrow_schema(schema))


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key as a table, from batches that are sorted by whole-number keys."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        marks = [batch.column(c).to_numpy() for c in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for m in marks:
            change[1:] |= m[1:] != m[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            now = tuple(int(m[start]) for m in marks)
            if now != key:
                if held:
                    yield pa.Table.from_batches(held)
                held, key = [], now
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def filter_texts(docs: DataFrame, keep: Callable[[pa.Array], list], slice_bytes: int = SLICE) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text the function keeps."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            parts = [
                pa.array(keep(texts.slice(start, end - start)), pa.bool_())
                for start, end in row_slices(texts, slice_bytes)
            ]
            if parts:
                yield batch.filter(pa.concat_arrays(parts))

    return docs.mapInArrow(run, docs.schema)
