import math
import random

import numpy as np
import pandas as pd
import pytest

from loomwork.operators import features
from loomwork.operators.ordered import lag_diff

COLUMNS = ["stock_id", "date_id", "time_id", "seconds_in_bucket", *features.PRICE_COLS, *features.SIZE_COLS]


def frame(n=240, seed=4):
    draw = random.Random(seed)
    rows = []
    for t in range(n):
        stock = 0 if draw.random() < 0.4 else draw.randrange(1, 5)
        prices = [1 + draw.random() / 100 for _ in features.PRICE_COLS]
        sizes = [float(draw.randrange(1, 50)) for _ in features.SIZE_COLS]
        rows.append([stock, t // 40, t // 4, (t % 40) * 15, *prices, *sizes])
    out = pd.DataFrame(rows, columns=COLUMNS)
    out["row"] = range(n)
    out.loc[out.row % 11 == 0, "far_price"] = np.nan
    out.loc[out.row % 13 == 0, "ask_price"] = np.nan
    out.loc[out.row % 17 == 0, "wap"] = np.nan
    return out


def to_spark(spark, pandas_frame):
    names = list(pandas_frame.columns)
    rows = [
        tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r)
        for r in pandas_frame.astype(object).itertuples(index=False, name=None)
    ]
    kinds = {"stock_id": "int", "date_id": "int", "time_id": "int", "seconds_in_bucket": "int", "row": "int"}
    return spark.createDataFrame(rows, ", ".join(f"{c} {kinds.get(c, 'double')}" for c in names))


def same(found, expected, columns):
    got = pd.DataFrame([r.asDict() for r in found.collect()]).sort_values("row")
    assert len(got) == len(expected)
    for c in columns:
        np.testing.assert_allclose(
            got[c].astype(float), expected.sort_values("row")[c].astype(float), rtol=1e-9, atol=1e-12, err_msg=c
        )


@pytest.mark.parametrize("partition_by", [("stock_id",), None])
def test_clean(spark, partition_by):
    data = frame()
    expected = data.dropna(subset=["ask_price"]).copy()
    early = expected.seconds_in_bucket <= 300
    expected.loc[early, ["near_price", "far_price"]] = 0
    if partition_by:
        expected["far_price"] = expected.groupby("stock_id")["far_price"].transform(lambda s: s.interpolate())
    else:
        expected["far_price"] = expected["far_price"].interpolate()
    found = features.clean(to_spark(spark, data), ["row"], partition_by)
    same(found, expected, ["near_price", "far_price", "ask_price"])


@pytest.mark.parametrize("small", [7, 1_000_000])
def test_book_features(spark, small):
    df = frame()
    weights = pd.DataFrame({"stock_id": range(4), "weight": [0.004, 0.001, 0.002, 0.006]})
    found = features.book_features(
        to_spark(spark, df),
        spark.createDataFrame(list(weights.itertuples(index=False, name=None)), "stock_id int, weight double"),
        ["row"],
        ["row"],
        salt_rows=small,
    )
    # stock 4 has no weight
    df["stock_weight"] = df.stock_id.map(weights.set_index("stock_id").weight)
    df["weighted_wap"] = df.stock_weight * df.wap
    groups = df.groupby("time_id")
    index = groups.weighted_wap.sum() / groups.stock_weight.sum()
    df["indexwap"] = df.time_id.map(index.where(groups.weighted_wap.count() > 0))
    df["indexwapdiff"] = df.wap - df.indexwap
    spread = df.ask_price - df.bid_price
    tilt = (df.bid_size - df.ask_size) / (df.bid_size + df.ask_size)
    df["bid_ask_spread"] = spread
    df["volume"] = df.ask_size + df.bid_size
    df["mid_price"] = (df.ask_price + df.bid_price) / 2
    df["bid_ask_ratio"] = df.bid_price / df.ask_price
    df["liquidity_imbalance"] = tilt
    df["market_urgency"] = spread * tilt
    df["market_urgency_v2"] = df.mid_price - (df.bid_price * df.bid_size + df.ask_price * df.ask_size) / df.volume
    df["price_pressure"] = df.imbalance_size * spread
    df["depth_pressure"] = (df.ask_size - df.bid_size) * (df.far_price - df.near_price)
    df["depth_pressure2"] = df.volume * (df.far_price + df.near_price)
    df["imbalance_momentum"] = df.groupby("stock_id").imbalance_size.diff() / df.matched_size
    df["spread_intensity"] = df.groupby("stock_id").bid_ask_spread.diff()
    same(found, df, [c for c in df.columns if c not in COLUMNS])


def test_zero_sizes_give_null(spark):
    df = frame(4)
    df[["bid_size", "ask_size", "matched_size"]] = 0.0
    weights = spark.createDataFrame([], "stock_id int, weight double")
    row = features.book_features(to_spark(spark, df), weights, ["row"], ["row"]).first()
    assert row.liquidity_imbalance is None and row.indexwap is None


@pytest.mark.parametrize("small", [10, 1_000_000])
def test_global_features(spark, small):
    df = frame()
    df.loc[len(df)] = df.iloc[0].copy()
    df.loc[len(df) - 1, ["stock_id", "row"]] = [9, 999]
    df = df.astype({"stock_id": int, "row": int, "date_id": int, "time_id": int, "seconds_in_bucket": int})
    g = df.groupby("stock_id")
    expected = {
        "median_size": g.bid_size.median() + g.ask_size.median(),
        "std_size": g.bid_size.std() + g.ask_size.std(),
        "ptp_size": g.bid_size.max() - g.bid_size.min(),
        "median_price": g.bid_price.median() + g.ask_price.median(),
        "std_price": g.bid_price.std() + g.ask_price.std(),
        "ptp_price": g.bid_price.max() - g.ask_price.min(),
    }
    found = features.global_features(to_spark(spark, df), ["row"], salt_rows=small)
    for name, values in expected.items():
        df[f"global_{name}"] = df.stock_id.map(values)
    same(found, df, [f"global_{n}" for n in expected])
    assert df.loc[df.stock_id == 9, "global_std_size"].isna().all()


@pytest.mark.parametrize("n", [11, 12, 500])
@pytest.mark.parametrize("kind", ["distinct", "few", "one"])
def test_medians_of_large_keys(spark, n, kind):
    draw = random.Random(n)
    pick = {"distinct": lambda: draw.random(), "few": lambda: float(draw.randrange(3)), "one": lambda: 7.0}[kind]
    values = [pick() for _ in range(n)]
    rows = [(1, v, v * 2) for v in values] + [(1, None, None), (2, 1.0, None), (2, 2.0, None)]
    data = spark.createDataFrame(rows, "k int, a double, b double")
    found = {r.k: (r.median_a, r.median_b) for r in features.medians(data, "k", ["a", "b"]).collect()}
    middle = float(np.median(values))
    assert found == {1: (pytest.approx(middle), pytest.approx(middle * 2)), 2: (1.5, None)}


def test_time_features(spark):
    data = spark.createDataFrame([(0, 0), (7, 130), (481, 540)], "date_id int, seconds_in_bucket int")
    found = [tuple(r)[2:] for r in features.time_features(data).orderBy("date_id").collect()]
    assert found == [(0, 0, 0), (2, 10, 2), (1, 0, 9)]


@pytest.mark.parametrize("row", [
    [5.0, 5.0, 5.0, 5.0], [0.1, 0.1, 0.1, 0.1], [1.0, 2.0, None, None], [1.0, 2.0, 9.0, None],
    [1.0, 2.0, 4.0, 9.0], [None, None, None, 3.0], [None, None, None, None], [-3.0, 1e6, 2.5, -1e-3],
])
def test_row_stats(spark, row):
    data = spark.createDataFrame([tuple(row)], "a double, b double, c double, d double")
    found = features.row_stats(data, {"x": ["a", "b", "c", "d"]}).first()
    values = pd.Series(row, dtype=float)
    for name, expected in {
        "mean": values.mean(), "std": values.std(), "skew": values.skew(), "kurt": values.kurt(), "max": values.max(),
    }.items():
        got = found[f"x_{name}"]
        if math.isnan(expected):
            assert got is None, name
        else:
            assert got == pytest.approx(expected, abs=1e-12), name


def test_null_profile(spark):
    data = spark.createDataFrame([(1, None), (None, None), (2, "x")], "a int, b string")
    found = {r.column_name: r.nulls for r in features.null_profile(data).collect()}
    assert found == {"a": 1, "b": 2, "total": 3}


def test_narrow_types(spark):
    rows = [(-128, 128, 32768, 2**31, 1.5, 1e300, None, "s"), (127, -129, -1, 0, float("nan"), 0.0, None, "t")]
    data = spark.createDataFrame(
        rows, "a bigint, b bigint, c bigint, d bigint, e double, f double, g bigint, h string"
    )
    narrow = features.narrow_types(data)
    assert dict(narrow.dtypes) == {
        "a": "tinyint", "b": "smallint", "c": "int", "d": "bigint",
        "e": "float", "f": "double", "g": "bigint", "h": "string",
    }
    assert {r.a for r in narrow.collect()} == {-128, 127}


def test_features_of_a_row_are_not_sorted(spark, monkeypatch):
    moved = []
    monkeypatch.setattr(features, "lag_diff", lambda df, *a: moved.append(df.columns) or lag_diff(df, *a))
    weights = spark.createDataFrame([(0, 0.004)], "stock_id int, weight double")
    rows = to_spark(spark, frame(40))
    found = features.book_features(rows, weights, ["row"], ["row"])
    assert moved == [[*rows.columns, "bid_ask_spread"]]
    assert found.columns[len(rows.columns)] == "volume" and found.columns[-1] == "indexwapdiff"
