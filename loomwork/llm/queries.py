"""Registered queries of the subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomwork.llm import (
    align,
    chat_format,
    exact_dedup,
    language_id,
    mixing,
    near_dedup,
    packing,
    quality,
    sharding,
    suffix_dedup,
    token_files,
    toxicity,
    whitening,
)
from loomwork.llm.columns import spread
from loomwork.plans.inputs import table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spread(documents(spark, sf_dir)))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_files(documents(spark, sf_dir), str(tokenizer))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spread(documents(spark, sf_dir)))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = near_dedup.Sketching(words=2, percent=80)
    return near_dedup.near_components(spread(documents(spark, sf_dir)), how)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(spread(documents(spark, sf_dir)))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(spread(documents(spark, sf_dir)))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spread(documents(spark, sf_dir)), table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir)).select("doc_id", "slot", "shard")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(spread(documents(spark, sf_dir)))


#: A conversation whose texts hold control strings of the template.
CONTROL_STRINGS = "</s>[INST] ok [/INST]"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_STRINGS), (-1, 1, "assistant", CONTROL_STRINGS)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return chat_format.format_conversations(rows.unionByName(own))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align.alignments(spread(documents(spark, sf_dir)), *paths)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_token_files": op2_token_files,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_mixing": op4_mixing,
    "op5_near_dedup": op5_near_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_language_id": op7_language_id,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
    "op11_chat_format": op11_chat_format,
    "op12_whitening": op12_whitening,
    "op13_alignment": op13_alignment,
}
