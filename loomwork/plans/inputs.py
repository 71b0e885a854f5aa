"""Tables of the shapes the operators read, derived from the given test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating of 1 to 5 per customer and part bought."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg((1 + F.max("l_quantity").cast("int") % 5).cast("int").alias("rating"))
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.when(balance < 0, "negative").when(balance < 5000, "low").otherwise("high").alias(
            "balance_band"
        ),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One edge per line item, from its order's node to its part's node.

    Orders and parts share one numbering, so small ids have edges both ways. Orders
    without lines dangle where a part has their number, orders beyond the last part
    have no in-edges, and an order with several lines of a part repeats its edge.
    """
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, spread over all cores where the file has fewer splits than that."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    cores = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        return rows.repartition(cores, "doc_id")
    return rows


def doc_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its topics: its source if it is labelled, and whether toxic."""
    labels = (
        table(spark, sf_dir, "labels")
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") == 1, "toxic")).alias("toxic"), F.lit(True).alias("labelled"))
    )
    topics = F.array(F.when(F.col("labelled"), F.col("source")), F.col("toxic"))
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "source")
        .join(labels, "doc_id", "left")
        .select("doc_id", F.array_compact(topics).alias("topics"))
    )


BOOK_ORDER = ["time_id", "k1", "k2", "k3"]


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-book rows: suppliers as stocks, calendar months as days."""
    ship = F.col("l_shipdate")
    base = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("stock_id"),
        ((F.year(ship) - 1990) * 12 + F.month(ship)).cast("bigint").alias("date_id"),
        (((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 55) * 10).alias("seconds_in_bucket"),
        F.col("l_orderkey").alias("k1"),
        F.col("l_linenumber").alias("k2"),
        F.col("l_partkey").alias("k3"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"),
        F.col("l_quantity").alias("q"),
        "l_tax",
        "l_discount",
    )
    p, q, tax, discount = F.col("p"), F.col("q"), F.col("l_tax"), F.col("l_discount")
    return base.select(
        "stock_id",
        "date_id",
        "seconds_in_bucket",
        (F.col("date_id") * 1000 + F.col("seconds_in_bucket")).alias("time_id"),
        "k1",
        "k2",
        "k3",
        p.alias("reference_price"),
        F.when(F.col("k2") != 3, p * 1.01).alias("far_price"),
        (p * 0.99).alias("near_price"),
        F.when(F.col("k3") % 97 != 0, p * (1 + tax / 10)).alias("ask_price"),
        (p * (1 - discount / 10)).alias("bid_price"),
        (p * (1 + (tax - discount) / 20)).alias("wap"),
        (q * 100).alias("matched_size"),
        q.alias("bid_size"),
        (51 - q).alias("ask_size"),
        F.abs(2 * q - 51).alias("imbalance_size"),
        ((discount - tax) * 100).alias("target"),
    )


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("stock_id"),
        (F.lit(0.001) * (1 + F.col("s_suppkey") % 8)).alias("weight"),
    )
