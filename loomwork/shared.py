"""The shared folder of the session: lineage cuts and written working tables."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLE = "table-"


def hadoop_path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, folder or glob pattern finds anything, on any file system."""
    found, system = hadoop_path(spark, path)
    return bool(system.globStatus(found))


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, the folder given
    to ``setCheckpointDir`` is used, else a new one below ``hadoop.tmp.dir`` on the
    session's default file system. If that is a local disk and the session is no local
    one, it is an error, because the data would land on a disk that dies with its machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        conf = spark._jsc.hadoopConfiguration()
        system = spark._jvm.org.apache.hadoop.fs.FileSystem.get(conf)
        if system.getScheme() == "file" and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"{conf.get('hadoop.tmp.dir')}/loomwork-{uuid.uuid4().hex}"
        sc.setCheckpointDir(system.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(folder)).toString())
    return sc.getCheckpointDir()


def working_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Tables that ``cut_lineage`` wrote: a weak reference to what their readers share, and the path.
_OWNED: list[tuple] = []


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    The table lives as long as any DataFrame that reads it, see ``sweep``. It is written by
    the session's codec unless one is given.
    """
    spark = df.sparkSession
    sweep(spark)
    path = working_path(spark, TABLE.rstrip("-"))
    df.write.parquet(path, compression=compression)
    table = spark.read.schema(df.schema).parquet(path)
    _OWNED.append((_readers(table), spark.sparkContext.applicationId, path))
    return table


def packed(df: DataFrame) -> DataFrame:
    """As ``cut_lineage``, by a codec that takes less disk than the usual one and somewhat more time."""
    return cut_lineage(df, "zstd")


def _readers(table: DataFrame):
    """A weak reference of the JVM to the file index that every plan over ``table`` holds."""
    files = table._jdf.queryExecution().analyzed().relation().location()
    return table.sparkSession._jvm.java.lang.ref.WeakReference(files)


def sweep(spark: SparkSession) -> list[str]:
    """Remove the working tables that no DataFrame reads any more; gives their paths.

    The JVM counts the readers: all plans over a table, also those derived from it, share
    its file index, and once its garbage collector found that unused, no query can ask for
    the table again. Nothing is forced: a table goes with the first sweep after that, and
    every new working table begins with one.
    """
    gone, app = [], spark.sparkContext.applicationId
    for owned in list(_OWNED):
        readers, of, path = owned
        if of == app and not readers.refersTo(None):
            continue
        _OWNED.remove(owned)
        if of == app:
            found, system = hadoop_path(spark, path)
            system.delete(found, True)
            gone.append(path)
    return gone


def release(*tables: DataFrame) -> None:
    """Remove tables that ``cut_lineage`` gave, once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            if folder.rpartition("/")[2].startswith(TABLE):
                found, system = hadoop_path(spark, folder)
                system.delete(found, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the files of shuffles removed that no live DataFrame needs.

    Spark removes them once the driver's garbage collector finds them unused, which
    otherwise happens when the driver's memory runs short. Python lets go of its
    references first; Py4J passes that on in a thread of its own.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.5)
        spark._jvm.System.gc()
