"""Exact dedup by skew-safe combining.

Equal texts are combined three times, and every time the full texts are compared, not
only their digests: within each map task; then among the tasks that share a salt; then
among the salts' winners. A group with a third of all rows reaches the second step as
one row per task and the last as one row per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.columns import unused
from loomwork.shared import cut_lineage

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def combined(docs: DataFrame, digest=sha256, salts: int = SALTS) -> DataFrame:
    """One row per distinct text: digest, text, keep_id, group_size."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # all rows of a task have one salt, so the task's own combining is complete
    salted = docs.select("doc_id", text.alias("text"), F.spark_partition_id().alias("task")).select(
        "doc_id", "text", digest(F.col("text")).alias("digest"), (F.col("task") % salts).alias("salt")
    )
    by_salt = salted.groupBy("digest", "salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return by_salt.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def exact_dedup(docs: DataFrame, digest=sha256, salts: int = SALTS) -> DataFrame:
    """Every document with the one that stays of its equals.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Result: doc_id,
    keep_id, group_size, kept, text_sha256. A null text equals the empty text. The
    largest doc_id of a group stays; a null doc_id only in a group without any other. A
    doc_id that occurs several times counts as often, and its rows are all kept or all
    dropped. An empty table gives an empty result.

    Documents find their group by digest. Where texts of one digest differ, which the
    combining has found out, the text decides; so any ``digest`` gives the same groups.
    """
    groups = combined(docs, digest, salts)
    # of a digest with one text only, the digest is enough to find the group
    by_digest = cut_lineage(
        groups.groupBy("digest").agg(
            F.count("*").alias("texts"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
        )
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", digest(text).alias("digest"), sha256(text).alias("text_sha256"))
    if digest is sha256:
        rows = rows.select("doc_id", "digest").withColumn("text_sha256", F.col("digest"))
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    every = rows.join(by_digest.where("texts = 1"), "digest").select(*columns)
    several = by_digest.where("texts > 1").select("digest")
    if not several.isEmpty():
        full = docs.select("doc_id", text.alias("text"), digest(text).alias("digest"))
        told = full.join(several, "digest", "left_semi").join(groups, ["digest", "text"])
        every = every.unionByName(told.withColumn("text_sha256", sha256(F.col("text"))).select(*columns))
    return every.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns.

    Rows that share a doc_id and their text leave one row.
    """
    name, key = unused(docs, "_digest"), unused(docs, "_key")

    def as_key(doc_id: str) -> Column:
        # never null, so that the join and what follows share one partitioning
        return F.coalesce(F.col(doc_id).cast("string"), F.lit("none"))

    keep = combined(docs).select(as_key("keep_id").alias(key), F.col("digest").alias(name))
    keyed = docs.withColumn(key, as_key("doc_id")).withColumn(
        name, sha256(F.coalesce(F.col("text"), F.lit("")))
    )
    return keyed.join(keep, [key, name], "left_semi").dropDuplicates([key, name]).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
