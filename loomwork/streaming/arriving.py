"""Features and scores of order-book rows as they arrive, with keyed state.

A lag needs a stock's rows of earlier batches. A stateful operator keeps the last values of
each stock in Spark's state store, so that a batch never rereads what came before. All
other features come from the batch itself (the index of a time step) or from small tables
(stock weights, stock features), and are computed by the same functions as in a batch job.

Rows have to arrive in order: no row of a stock may lie before one of an earlier batch, and
all rows of a time step come in one batch, as when one group after the other is served. A
batch's rows of one stock are sorted in one task; ``files_per_trigger`` sets how many come
at once.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loomwork.operators import features
from loomwork.operators.model import predict
from loomwork.shared import cut_lineage, release

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def lag_diff_stream(
    stream: DataFrame, columns: list[str], key: str, order_by: list[str], lags: tuple[int, ...] = (1,)
) -> DataFrame:
    """As ``ordered.lag_diff`` over a stream: each column less its value ``lag`` rows before.

    The state of a key is its last values, as many as the deepest lag. Rows with a null
    key are a key of their own.
    """
    names = [f"{c}_diff{lag}" for lag in lags for c in columns]
    schema = T.StructType([*stream.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    deepest = max(lags)
    state = ", ".join(f"v{i} array<double>" for i in range(len(columns)))

    class LastValues(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last", state)

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            import numpy as np
            import pandas as pd

            parts = list(rows)
            own = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
            places = [own[c].to_numpy() for c in order_by]
            if all(p.dtype.kind in "iuf" for p in places):
                own = own.take(np.lexsort(places[::-1]))  # stable, and much faster on few rows
            else:
                own = own.sort_values(order_by, kind="stable")
            own = own.reset_index(drop=True)
            before = self.last.get() if self.last.exists() else None
            kept = []
            for i, c in enumerate(columns):
                earlier = [np.nan if v is None else v for v in (before[i] if before else [])]
                series = np.concatenate([earlier, own[c].to_numpy(dtype="float64", na_value=np.nan)])
                for lag in lags:
                    moved = np.full(len(series), np.nan)
                    moved[lag:] = series[lag:] - series[:-lag]
                    own[f"{c}_diff{lag}"] = moved[len(earlier) :]
                kept.append([None if np.isnan(v) else float(v) for v in series[-deepest:]])
            self.last.update(tuple(kept))
            yield own[[f.name for f in schema.fields]]

        def close(self) -> None:
            pass

    spark = stream.sparkSession
    if spark.conf.get(_PROVIDER) != _ROCKSDB:
        spark.conf.set(_PROVIDER, _ROCKSDB)  # the only one that keeps such state
    # state needs a key that is not null
    never_null = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    return stream.withColumn("_key", never_null).groupBy("_key").transformWithStateInPandas(LastValues(), schema, "append", "None")


def arriving_features(
    spark: SparkSession,
    source: str,
    schema: str | T.StructType,
    weights: DataFrame,
    stocks: DataFrame,
    order_by: list[str],
    spread: list[str],
    sink: str,
    checkpoint: str,
    model: GBTRegressionModel | None = None,
    columns: list[str] | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """All features of the clean rows at ``source`` that no earlier call has seen.

    ``weights`` and ``stocks`` are small tables by ``stock_id``: the weights of the index,
    and what ``stock_features`` gives. With a ``model`` on ``columns`` rows are scored as
    well. A batch is written to a folder of its own below ``sink``, which a repeated batch
    overwrites, so each row is there once. ``checkpoint`` keeps the state and which files
    are done. Gives the table of all rows so far.
    """
    reader = spark.readStream.schema(schema)
    fields = T.StructType.fromDDL(schema).names if isinstance(schema, str) else schema.names
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # what a row has by itself is added after the state
    arrived = reader.parquet(source).withColumns(features.lagged_values())
    moved = lag_diff_stream(arrived, features.LAGGED, "stock_id", order_by)

    def write(batch: DataFrame, number: int) -> None:
        # the index and the rows both read the batch, and the state should be asked once
        kept = cut_lineage(batch)
        basic = features.row_features(kept.select(*fields, *[f"{c}_diff1" for c in features.LAGGED]))
        rows = features.with_index(features.with_momentum(basic), weights, spread)
        rows = features.time_features(rows.join(stocks, "stock_id", "left"))
        rows = features.row_stats(rows)
        if model is not None:
            rows = predict(model, rows, columns)
        rows.write.mode("overwrite").parquet(f"{sink}/batch={number}")
        release(kept)

    query = (
        moved.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(sink).drop("batch")
