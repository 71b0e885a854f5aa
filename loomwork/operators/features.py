"""Order-book snapshots: cleaning, features per row, per stock and per time step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.functions.rowstats import add_row_statistics
from loomwork.operators.ordered import in_order, interpolate, lag_diff
from loomwork.operators.positions import same_keys
from loomwork.operators.ranks import medians
from loomwork.operators.skew import SALT_ROWS, look_up

# The columns that the row statistics cover, and the time up to
# which near and far price count as 0.
PRICE_COLS = ["reference_price", "far_price", "near_price", "ask_price", "bid_price", "wap"]
SIZE_COLS = ["matched_size", "bid_size", "ask_size", "imbalance_size"]
QUIET_SECONDS = 300
TRADING_DAYS = 5


def clean(
    df: DataFrame,
    order_by: list[str],
    partition_by: list[str] | None = ("stock_id",),
    lagged: bool = False,
) -> DataFrame:
    """Drop rows without ask price, zero near and far price early on, fill the far price.

    With ``partition_by=None`` the gaps are filled along the whole table's order,
    across stocks. With ``lagged`` rows also get the differences of ``LAGGED``, for
    ``book_features``, which else sorts the rows once more in the same order.
    """
    early = F.col("seconds_in_bucket") <= QUIET_SECONDS
    kept = df.dropna(subset=["ask_price"]).withColumns(
        {c: F.when(early, 0.0).otherwise(F.col(c)) for c in ("near_price", "far_price")}
    )
    if lagged:
        return in_order(kept, list(partition_by or []), order_by, lagged_values(), (1,), "far_price")
    return interpolate(kept, "far_price", order_by, partition_by and list(partition_by))


def null_profile(df: DataFrame) -> DataFrame:
    """``column_name, nulls`` for every column, and their total."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns]
    total = sum((F.col(c) for c in df.columns), F.lit(0).cast("bigint"))
    pairs.append(F.struct(F.lit("total").alias("column_name"), total.alias("nulls")))
    return counts.select(F.inline(F.array(*pairs)))


#: The columns whose change since a stock's row before is a feature.
LAGGED = ["imbalance_size", "bid_ask_spread"]


def lagged_values() -> dict[str, Column]:
    """What a row has under the names of ``LAGGED``."""
    return dict(zip(LAGGED, (F.col("imbalance_size"), F.col("ask_price") - F.col("bid_price"))))


def book_features(
    df: DataFrame,
    weights: DataFrame,
    order_by: list[str],
    spread: list[str],
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """Price and size features, the weighted index per time step, and lag differences.

    ``order_by`` orders the rows of a stock; ``spread`` names columns that differ
    between rows of one stock or time step. ``weights`` has ``stock_id, weight``. A
    division by zero gives null. Rows that ``clean`` has given their lags are not sorted again.
    """
    # what a row has by itself is added last, and is neither sorted nor joined
    moves, gap = [f"{c}_diff1" for c in LAGGED], lagged_values()["bid_ask_spread"]
    if set(moves) <= set(df.columns):
        moved, df = df, df.drop(*moves)
    else:
        moved = lag_diff(df.withColumn("bid_ask_spread", gap), LAGGED, ["stock_id"], order_by).drop("bid_ask_spread")
    # from the rows as given, so that the index does not wait for the lags
    indexed = with_index(moved, weights, spread, salt_rows, weighted_index(df, weights))
    found = with_momentum(row_features(indexed))
    own = row_features(df).columns
    added = [c for c in indexed.columns if c not in own and c not in moved.columns]
    return found.select(*own, "imbalance_momentum", "spread_intensity", *added)


def row_features(df: DataFrame) -> DataFrame:
    """The features that a row has by itself."""
    ask, bid = F.col("ask_price"), F.col("bid_price")
    ask_size, bid_size = F.col("ask_size"), F.col("bid_size")
    volume = ask_size + bid_size
    gap = ask - bid
    mid = (ask + bid) / 2
    tilt = F.try_divide(bid_size - ask_size, volume)
    return df.withColumns(
        {
            "volume": volume,
            "mid_price": mid,
            "bid_ask_spread": gap,
            "bid_ask_ratio": F.try_divide(bid, ask),
            "liquidity_imbalance": tilt,
            "market_urgency": gap * tilt,
            "market_urgency_v2": mid - F.try_divide(bid * bid_size + ask * ask_size, volume),
            "price_pressure": F.col("imbalance_size") * gap,
            "depth_pressure": (ask_size - bid_size) * (F.col("far_price") - F.col("near_price")),
            "depth_pressure2": volume * (F.col("far_price") + F.col("near_price")),
        }
    )


def with_momentum(df: DataFrame) -> DataFrame:
    """The features that rest on the differences of ``LAGGED``, in their place."""
    return df.withColumns(
        {
            "imbalance_momentum": F.try_divide("imbalance_size_diff1", "matched_size"),
            "spread_intensity": F.col("bid_ask_spread_diff1"),
        }
    ).drop(*[f"{c}_diff1" for c in LAGGED])


def with_index(
    df: DataFrame,
    weights: DataFrame,
    spread: list[str],
    salt_rows: int = SALT_ROWS,
    index: DataFrame | None = None,
) -> DataFrame:
    """Each row's weight, and the weighted index of its time step."""
    if index is None:
        index = weighted_index(df, weights)
    weighted = df.join(_stock_weights(weights), "stock_id", "left").withColumn(
        "weighted_wap", F.col("stock_weight") * F.col("wap")
    )
    return look_up(weighted, index, ["time_id"], spread, "_rows", salt_rows).withColumn(
        "indexwapdiff", F.col("wap") - F.col("indexwap")
    )


def _stock_weights(weights: DataFrame) -> DataFrame:
    return weights.select("stock_id", F.col("weight").alias("stock_weight"))


def weighted_index(df: DataFrame, weights: DataFrame) -> DataFrame:
    """The weighted mean of ``wap`` per time step: ``time_id, indexwap``, and its rows.

    A row without ``wap`` adds nothing to the sum but keeps its weight.
    """
    weighted = df.select("stock_id", "time_id", "wap").join(
        _stock_weights(weights), "stock_id", "left"
    )
    return weighted.groupBy("time_id").agg(
        F.try_divide(F.sum(F.col("stock_weight") * F.col("wap")), F.sum("stock_weight")).alias(
            "indexwap"
        ),
        F.count(F.lit(1)).alias("_rows"),
    )


def stock_features(df: DataFrame) -> DataFrame:
    """One row per stock: median, spread and range of its sizes and prices."""
    return _stock_features(df).drop("_rows")


def _stock_features(df: DataFrame) -> DataFrame:
    spreads = df.groupBy("stock_id").agg(
        (F.stddev_samp("bid_size") + F.stddev_samp("ask_size")).alias("global_std_size"),
        (F.max("bid_size") - F.min("bid_size")).alias("global_ptp_size"),
        (F.stddev_samp("bid_price") + F.stddev_samp("ask_price")).alias("global_std_price"),
        # the price range runs from the lowest ask to the highest bid
        (F.max("bid_price") - F.min("ask_price")).alias("global_ptp_price"),
        F.count(F.lit(1)).alias("_rows"),
    )
    columns = ["bid_size", "ask_size", "bid_price", "ask_price"]
    return same_keys(spreads, medians(df, "stock_id", columns), ["stock_id"]).select(
        "stock_id",
        (F.col("median_bid_size") + F.col("median_ask_size")).alias("global_median_size"),
        "global_std_size",
        "global_ptp_size",
        (F.col("median_bid_price") + F.col("median_ask_price")).alias("global_median_price"),
        "global_std_price",
        "global_ptp_price",
        "_rows",
    )


def global_features(df: DataFrame, spread: list[str], salt_rows: int = SALT_ROWS) -> DataFrame:
    """``df`` with the features of its stock on each row."""
    return look_up(df, _stock_features(df), ["stock_id"], spread, "_rows", salt_rows)


def time_features(df: DataFrame) -> DataFrame:
    """Day of the week, second and minute from the day and the seconds in the auction."""
    return df.withColumns(
        {
            "day_of_week": F.pmod("date_id", F.lit(TRADING_DAYS)),
            "seconds": F.pmod("seconds_in_bucket", F.lit(60)),
            "minute": F.floor(F.col("seconds_in_bucket") / 60),
        }
    )


def row_stats(df: DataFrame, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """Mean, std, skew, kurtosis and max across the columns of each group."""
    groups = groups or {"all_prices": PRICE_COLS, "all_sizes": SIZE_COLS}
    for name, columns in groups.items():
        df = add_row_statistics(df, name, columns)
    return df


_INTEGERS = [(T.ByteType(), 7), (T.ShortType(), 15), (T.IntegerType(), 31)]
_LARGEST_FLOAT = (2 - 2**-23) * 2.0**127


def narrow_types(df: DataFrame) -> DataFrame:
    """Each numeric column in the smallest type that holds the values it has.

    One pass finds the ranges; only one row of them reaches the driver.
    """
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    fields = [f for f in df.schema if isinstance(f.dataType, (*whole, T.FloatType, T.DoubleType))]
    if not fields:
        return df
    bounds = []
    for f in fields:
        value = F.col(f.name)
        if not isinstance(f.dataType, whole):
            value = F.nanvl(value, F.lit(None).cast(f.dataType))
        bounds += [F.min(value).alias(f"{f.name}__min"), F.max(value).alias(f"{f.name}__max")]
    ranges = df.agg(*bounds).first()

    def narrowed(f: T.StructField) -> T.DataType:
        low, high = ranges[f"{f.name}__min"], ranges[f"{f.name}__max"]
        if low is None:
            return f.dataType
        if isinstance(f.dataType, whole):
            for kind, bits in _INTEGERS:
                if low >= -(2**bits) and high <= 2**bits - 1:
                    return kind
            return T.LongType()
        small = low >= -_LARGEST_FLOAT and high <= _LARGEST_FLOAT
        return T.FloatType() if small else T.DoubleType()

    return df.withColumns({f.name: F.col(f.name).cast(narrowed(f)) for f in fields})
