"""Documents from files of tagged records (SGML), one record per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.text import strip
from loomwork.shared import exists

# The layout of a news record.
NEWS_TAG = "REUTERS"
NEWS_SCHEMA = (
    "_NEWID string, _LEWISSPLIT string, TEXT struct<BODY: string>, "
    "TOPICS struct<D: array<string>>, _malformed string"
)
TEST_SPLIT = "TEST"


def file_records(spark: SparkSession, paths, tag: str) -> DataFrame:
    """``record``: the text of each ``<tag ...>...</tag>`` in the files.

    The closing tag serves as the line separator of the text source. A file of any
    size is then split over tasks, and no row holds more than one record. A last
    record that breaks off before its closing tag is closed here, and drops out
    later unless it is otherwise complete. Absent and broken files are passed over.
    """
    closing = f"</{tag}>"
    named = [paths] if isinstance(paths, str) else list(paths)
    there = [path for path in named if exists(spark, path)]
    if there:
        pieces = (
            spark.read.option("lineSep", closing)
            .option("ignoreMissingFiles", True)
            .option("ignoreCorruptFiles", True)
            .text(there)
        )
    else:
        pieces = spark.range(0).select(F.lit("").alias("value"))
    opened = F.regexp_extract("value", f"(?s)<{tag}[^>]*>.*", 0)
    return pieces.select(F.concat(opened, F.lit(closing)).alias("record"), opened.alias("_o")).where(
        F.col("_o") != ""
    ).drop("_o")


def column_records(df: DataFrame, text: str, tag: str, *keep: str) -> DataFrame:
    """``record`` for each ``<tag ...>...</tag>`` in a text column, ``keep`` alongside."""
    pattern = F.lit(f"(?s)<{tag}[^>]*>.*?</{tag}>")
    return df.select(
        *keep, F.explode_outer(F.regexp_extract_all(text, pattern, F.lit(0))).alias("record")
    ).where(F.col("record").isNotNull())


def parsed(records: DataFrame, schema: str) -> DataFrame:
    """Records with ``fields``, null where the record is malformed.

    Numeric character references are blanked first, as they may stand for
    characters that XML does not allow. ``schema`` ends in ``_malformed string``.
    """
    scrubbed = F.regexp_replace("record", r"&#\d+;", " ")
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_malformed",
        "ignoreSurroundingSpaces": "false",
    }
    fields = F.from_xml(scrubbed, schema, options)
    return records.withColumn("_fields", fields).select(
        *records.columns,
        F.when(F.col("_fields._malformed").isNull(), F.col("_fields")).alias("fields"),
    )


def rejected(records: DataFrame, schema: str = NEWS_SCHEMA) -> DataFrame:
    """One row: how many records are malformed."""
    return parsed(records, schema).agg(F.count_if(F.col("fields").isNull()).alias("rejected"))


def documents(records: DataFrame, test_only: bool = False) -> DataFrame:
    """``doc_id, body, topics`` of the well-formed news records.

    ``test_only`` keeps the records of the test split.
    """
    fields = parsed(records, NEWS_SCHEMA).where(F.col("fields").isNotNull()).select("fields.*")
    if test_only:
        fields = fields.where(F.col("_LEWISSPLIT") == TEST_SPLIT)
    no_topics = F.array().cast("array<string>")
    return fields.select(
        F.coalesce("_NEWID", F.lit("")).alias("doc_id"),
        F.coalesce(strip(F.col("TEXT.BODY")), F.lit("")).alias("body"),
        F.filter(
            F.coalesce("TOPICS.D", no_topics), lambda d: d.isNotNull() & (d != "")
        ).alias("topics"),
    )
