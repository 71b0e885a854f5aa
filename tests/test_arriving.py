"""Features of arriving rows against the batch chain."""

import random

import pytest
from pyspark.sql import functions as F

from loomwork.operators import features, ordered
from loomwork.streaming import arriving

ORDER = ["time_id", "k"]


@pytest.fixture(scope="module")
def book(spark):
    draw = random.Random(11)
    rows = []
    for time in range(30):
        for stock in (1, 2, None):
            # a stock that has a row in a few batches only, and one with several rows a step
            for k in range(draw.randrange(3) if stock == 1 else stock == 2 and time % 13 == 0 or stock is None):
                price = 10 + draw.random()
                rows.append(
                    (stock, time // 6, time * 10, time, k, price, price * 1.01, price * 0.99)
                    + (price * 1.02 if draw.random() < 0.8 else None, price * 0.98, price)
                    + tuple(float(draw.randrange(100)) for _ in range(4))
                )
    columns = "stock_id int, date_id int, seconds_in_bucket int, time_id int, k int, " + ", ".join(
        f"{c} double" for c in [*features.PRICE_COLS, *features.SIZE_COLS]
    )
    return spark.createDataFrame(rows, columns)


def same(left, right):
    """Rows by stock, time and place, fractions to nine digits."""
    assert left.columns == right.columns or sorted(left.columns) == sorted(right.columns)
    left = left.select(right.columns)
    both = [sorted(df.collect(), key=lambda r: (str(r.stock_id), r.time_id, r.k)) for df in (left, right)]
    assert len(both[0]) == len(both[1])
    for a, b in zip(*both):
        for column, x, y in zip(right.columns, a, b):
            close = x is not None and y is not None and abs(x - y) <= 1e-9 * max(1, abs(y))
            assert close or x is y is None, (column, x, y, b)


def test_three_batches_with_restarts_equal_the_batch_chain(spark, book, tmp_path):
    weights = spark.createDataFrame([(1, 0.5), (2, 0.25)], "stock_id int, weight double")
    stocks = features.stock_features(book)
    source, sink, done = (str(tmp_path / x) for x in ("in", "out", "done"))

    def arrive(part):
        book.where(F.floor(F.col("time_id") / 10) == part).write.mode("append").parquet(source)
        return arriving.arriving_features(
            spark, source, book.schema, weights, stocks, ORDER, ["k"], sink, done
        )

    for part in range(3):
        found = arrive(part)
        assert found.count() == book.where(F.col("time_id") < 10 * part + 10).count()
    whole = features.book_features(book, weights, ORDER, ["k"])
    whole = features.row_stats(features.time_features(whole.join(stocks, "stock_id", "left")))
    same(found, whole)


def test_lags_of_several_depths(spark, book, tmp_path):
    source, done = str(tmp_path / "in"), str(tmp_path / "done")
    found = []
    for part in range(3):
        book.where(F.floor(F.col("time_id") / 10) == part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(book.schema).parquet(source)
        moved = arriving.lag_diff_stream(stream, ["wap", "ask_price"], "stock_id", ORDER, (1, 3))
        query = moved.writeStream.foreachBatch(lambda df, _: found.extend(map(tuple, df.collect())))
        query.option("checkpointLocation", done).trigger(availableNow=True).start().awaitTermination()
    whole = ordered.lag_diff(book, ["wap", "ask_price"], ["stock_id"], ORDER, (1, 3))
    made = spark.createDataFrame(found, moved.schema)
    assert moved.columns == whole.columns
    same(made, whole)
