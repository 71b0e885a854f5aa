"""What every operator does with nulls, empty and very long texts, repeats and odd columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomwork.llm import (
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
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that operators make or use themselves.
CLASHING = [
    "size", "n", "kept", "score", "digest", "bucket", "block", "component_id", "label", "order",
    "keep_id", "copies", "slot", "shard", "a", "b", "key", "start", "held_out", "row", "gone", "__copies",
]
LONG = " ".join(f"w{i}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog while the rain falls on quiet hills and rivers run"
ROWS = [
    (1, PROSE, "en", "a", 5),
    (2, PROSE, "en", None, None),
    (3, None, "en", "a", 0),
    (4, "", None, "b", 0),
    (5, "   \n\t ", "en", "b", 6),
    (6, LONG, "en", "c", len(LONG)),
    (7, "né", "fr", "c", 2),
    (7, "né", "fr", "c", 2),
    (8, "12 34", "de", None, 5),
    (None, "no id here", "en", "a", 1),
    (9, PROSE + " again", "en", "a", 5),
]
LABELS = [(1, 0), (2, 1), (3, None), (None, 1), (6, 0), (6, 1), (99, 1)]


def documents(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit("x"))
    return docs


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, toxic int").withColumn("label", F.lit(7))


def operators(spark, docs, marks):
    tokenizer = str(public_tokenizers.path("byte_bpe_50k.json"))
    return {
        "packing": lambda: packing.pack(docs),
        "tokens": lambda: token_files.token_files(docs, tokenizer),
        "exact": lambda: exact_dedup.exact_dedup(docs),
        "mixing": lambda: mixing.mix(docs),
        "near": lambda: near_dedup.near_components(docs, near_dedup.Sketching(words=2)),
        "suffix": lambda: suffix_dedup.suffix_dedup(docs),
        "language": lambda: language_id.language_id(docs),
        "toxicity": lambda: toxicity.toxicity(docs, marks),
        "sharding": lambda: sharding.place(docs),
        "quality": lambda: quality.quality(docs),
    }


NAMES = list(operators(None, None, None))


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, name):
    docs = documents(spark, ROWS)
    rows = operators(spark, docs, labels(spark, LABELS))[name]().collect()
    ids = [r.doc_id for r in rows]
    if name == "packing":
        assert sorted(i for i in set(ids) if i) == list(range(1, 10)) and None in ids
        assert sum(r.length for r in rows if r.doc_id == 6) == 60_000
        assert {r.bucket for r in rows if r.doc_id in (3, 4, 5)} == {None}
        assert len([i for i in ids if i == 7]) == 2
        return
    assert sorted(i if i is not None else -1 for i in ids) == sorted(
        i if (i := r[0]) is not None else -1 for r in ROWS
    )
    by_id = {r.doc_id: r for r in rows}
    if name == "tokens":
        assert [by_id[i].n_tokens for i in (3, 4)] == [1, 1] and by_id[None].start == 0
    elif name == "exact":
        assert (by_id[1].keep_id, by_id[1].kept, by_id[2].kept, by_id[3].keep_id) == (2, False, True, 4)
        assert by_id[7].group_size == 2 and by_id[None].kept
    elif name == "mixing":
        assert by_id[3].copies == 0 and by_id[6].size == 60_000
        assert by_id[2].source_size != by_id[1].source_size
    elif name == "near":
        assert [by_id[i].component_id for i in (1, 2, 9)] == [1, 1, 1]
        assert (by_id[3].n_shingles, by_id[3].component_id, by_id[None].component_id) == (0, 3, None)
        assert by_id[7].n_shingles == 1 and by_id[7].kept
    elif name == "suffix":
        assert by_id[2].n_removed == len(PROSE) and by_id[1].n_removed == 0
        assert by_id[9].n_removed == len(PROSE) and by_id[None].n_removed == 0
    elif name == "language":
        assert by_id[3].lang_pred == by_id[8].lang_pred == "und" and by_id[3].score == 0.0
    elif name == "toxicity":
        assert all(0 <= r.score <= 1 for r in rows)
    elif name == "sharding":
        assert by_id[None].shard in sharding.SHARDS and set(CLASHING) <= set(rows[0].asDict())
    elif name == "quality":
        assert by_id[3].base_failed and by_id[3].ratio is None and by_id[6].n_words == 60_000


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, name):
    result = operators(spark, documents(spark, []), labels(spark, []))[name]()
    assert result.collect() == [] and "doc_id" in result.columns


def test_toxicity_without_labels(spark):
    rows = toxicity.toxicity(documents(spark, ROWS), labels(spark, [])).collect()
    assert {r.score for r in rows} == {0.0} and {r.predicted for r in rows} == {0}


@pytest.mark.parametrize("rows", [ROWS, []])
@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, name, stage, rows):
    docs = documents(spark, rows)
    result = stage(spark, docs, "unused")
    found = result.collect()
    if name != "pack":
        assert result.columns == docs.columns
    if not rows:
        assert found == []
    ids = [r.doc_id for r in found]
    if name == "exact_dedup" and rows:
        assert sorted(i for i in ids if i is not None) == [2, 5, 6, 7, 8, 9][:0] + [2, 4, 5, 6, 7, 8, 9]
    if name == "near_dedup" and rows:
        assert 9 in ids or 1 in ids
    if name == "language" and rows:
        assert not {3, 4, 5, 8} & set(ids) and {1, 2, 6, 9} <= set(ids)
