import random

import pytest
from pyspark.sql import functions as F

from loomwork.operators import features, ordered
from loomwork.operators.ranks import medians
from loomwork.plans import inputs, queries


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    out = [(k if k < 3 else None, t, draw.choice([None, draw.random()]), draw.randrange(9)) for k in range(4) for t in range(60)]
    out += [(9, t, None, t) for t in range(5)] + [(10, 0, 1.0, 1)]
    return spark.createDataFrame(out, "k int, t int, v double, w int")


@pytest.mark.parametrize("block_rows", [1, 3, 7, 1000])
def test_one_sort_gives_differences_and_filled_gaps(rows, block_rows):
    """However short the blocks are, against a plain loop over each key."""
    found = ordered.in_order(rows, ["k"], ["t"], {"w": F.col("w"), "x": F.col("w") * 2}, (1, 4), "v", block_rows)
    assert found.columns[:4] == ["k", "t", "v", "w"] and dict(found.dtypes)["w_diff1"] == "int"
    got = {(r.k, r.t): (r.v, r.w_diff1, r.w_diff4, r.x_diff1, r.x_diff4) for r in found.collect()}
    series = {}
    for r in rows.orderBy("t").collect():
        series.setdefault(r.k, []).append(r)
    assert len(got) == sum(map(len, series.values()))
    for key, own in series.items():
        known = [i for i, r in enumerate(own) if r.v is not None]
        for i, r in enumerate(own):
            a, b = max((j for j in known if j <= i), default=None), min((j for j in known if j >= i), default=None)
            v = None if a is None else own[a].v if b is None or a == b else own[a].v + (own[b].v - own[a].v) / (b - a) * (i - a)
            d = [r.w - own[i - lag].w if i >= lag else None for lag in (1, 4)]
            x = [None if y is None else 2 * y for y in d]
            assert got[key, r.t] == (v if v is None else pytest.approx(v), d[0], d[1], x[0], x[1])


def test_lags_of_cleaned_rows_are_those_of_a_second_sort(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    try:
        book, weights = inputs.book(spark, sf), inputs.weights(spark, sf)
    except Exception:
        pytest.skip("needs the test tables")
    sorts, placed = [], ordered.placed
    monkeypatch.setattr(ordered, "placed", lambda *given: sorts.append(given) or placed(*given))
    once = features.book_features(
        features.clean(book, inputs.BOOK_ORDER, lagged=True), weights, inputs.BOOK_ORDER, queries.SPREAD
    )
    assert len(sorts) == 1
    twice = features.book_features(features.clean(book, inputs.BOOK_ORDER), weights, inputs.BOOK_ORDER, queries.SPREAD)
    assert once.columns == twice.columns and once.count() == twice.count() > 0
    assert once.exceptAll(twice).isEmpty()


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan")[0]
    return [line for line in plan.splitlines() if "- Exchange" in line]


def test_rows_stay_where_they_are_for_small_tables(spark):
    rows = spark.range(400).selectExpr(
        "id % 7 AS stock_id", "id AS row", "id * 1.0D AS bid_size", "id * 2.0D AS ask_size",
        "id * 3.0D AS bid_price", "id * 4.0D AS ask_price",
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = features.global_features(rows, ["row"])
        assert exchanges(found) == [] and found.count() == 400
        middle = medians(rows, "stock_id", ["bid_size"])
        assert {r.stock_id: r.median_bid_size for r in middle.collect()}[0] == 199.5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_the_state_is_asked_once_for_a_batch(spark, tmp_path, monkeypatch):
    """The index and the rows read what a batch's pass through the state has written."""
    from loomwork.streaming import arriving

    columns = ", ".join(f"{c} double" for c in [*features.PRICE_COLS, *features.SIZE_COLS])
    schema = f"stock_id int, date_id int, seconds_in_bucket int, time_id int, k int, {columns}"
    data = [(i % 3, 0, 10 * i, i // 2, i, *[float(1 + (i * 7 + j) % 5) for j in range(10)]) for i in range(12)]
    source, sink, done = (str(tmp_path / x) for x in ("in", "out", "done"))
    book = spark.createDataFrame(data, schema)
    book.write.parquet(source)
    weights = spark.createDataFrame([(0, 0.5), (1, 0.25), (2, 1.0)], "stock_id int, weight double")
    seen, indexed = [], features.with_index

    def watched(df, *given, **named):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return indexed(df, *given, **named)

    monkeypatch.setattr(features, "with_index", watched)
    stocks = features.stock_features(book)
    found = arriving.arriving_features(spark, source, schema, weights, stocks, ["time_id", "k"], ["k"], sink, done)
    assert found.count() == 12 and len(seen) == 1
    assert "parquet" in seen[0] and "Transform" not in seen[0] and "LogicalRDD" not in seen[0]
