"""Result files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from loomwork.shared import hadoop_path

#: The file that parts are joined into, where the file system can.
JOINED = "part-all.csv"
_CONCAT = "fs.capability.paths.concat"
#: Up to this many files, rows travel to them packed; with more, a file's task reads little.
PACKED_FILES = 16


def write_csv(
    df: DataFrame, path: str, header: bool = True, files: int | None = None, sep: str = ","
) -> None:
    """Write ``df`` as CSV, replacing what is there.

    By default each partition becomes a file. ``files`` asks for a number of files;
    one file keeps the order of a sorted result, and goes through one task. A few files
    are one task each as well, so the rows come to them packed by column.
    """
    if files == 1:
        df = df.coalesce(1)
    elif files is not None:
        df = _dealt(df, files) if files <= PACKED_FILES else df.repartition(files)
    df.write.mode("overwrite").csv(path, header=header, sep=sep)


def _packed(df: DataFrame, files: int) -> DataFrame:
    """``piece``: the rows as compressed Arrow batches, of every batch one for each file.

    Rows are sorted before, as Spark does in its own round robin: a task that runs again
    then makes the same pieces.
    """

    # everything the function uses is inside it, so workers need not have this package
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        how = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            cuts, pieces = [batch.num_rows * i // files for i in range(files + 1)], []
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, batch.schema, options=how) as stream:
                    stream.write_batch(batch.slice(start, end - start))
                pieces.append(out.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], ["piece"])

    # names with dots are not for mapInArrow
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.sortWithinPartitions(*plain.columns).mapInArrow(pack, "piece binary")


def _dealt(df: DataFrame, files: int) -> DataFrame:
    """``df`` dealt evenly over ``files`` partitions, packed on the way."""
    if any(isinstance(f.dataType, T.YearMonthIntervalType) for f in df.schema):
        return df.repartition(files)  # Arrow has no such type

    names = df.columns

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.column(0):
                for rows in pa.ipc.open_stream(piece.as_buffer()):
                    yield rows.rename_columns(names)

    return _packed(df, files).repartition(files).mapInArrow(unpack, df.schema)


def write_sorted_csv(
    df: DataFrame,
    path: str,
    order_by: list[str | Column],
    header: bool = True,
    sep: str = ",",
    join: Callable | None = None,
) -> list[str]:
    """Write ``df`` as CSV in one order over all files, replacing what is there.

    The rows are sorted by range, and every part is written by its own task; no task sees
    more than a part. Where the file system can concatenate files without reading them,
    the parts become one file with one header. Elsewhere they stay, numbered in order,
    each with a header. Gives the paths of the files in order. ``join`` stands in for the
    file system's concatenation: it gets the target and the parts, as Hadoop paths.
    """
    spark = df.sparkSession
    folder, system = hadoop_path(spark, path)
    if join is None and system.hasPathCapability(folder, _CONCAT):
        join = system.concat
    ordered = df.orderBy(*order_by)
    ordered.write.mode("overwrite").csv(path, header=header and join is None, sep=sep)
    # numbered by the sort's partitions
    parts = sorted(
        (s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("part-")),
        key=lambda p: p.getName(),
    )
    if join is None:
        return [p.toString() for p in parts]
    target, _ = hadoop_path(spark, f"{path.rstrip('/')}/{JOINED}")
    out = system.create(target, True)
    if header:
        names = [f'"{c}"' if any(x in c for x in (sep, '"', "\n")) else c for c in df.columns]
        out.write(bytearray((sep.join(names) + "\n").encode()))
    out.close()
    if parts:
        gateway = spark.sparkContext._gateway
        array = gateway.new_array(gateway.jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, p in enumerate(parts):
            array[i] = p
        join(target, array)
    return [target.toString()]
