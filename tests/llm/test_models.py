"""Held-out quality of the trained models, the registered queries and the pipeline."""

import math
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from loomwork.llm import language_id, oracle, queries, toxicity

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert set(oracle.oracle_sql()) <= set(contract.oracle_sql())


SYLLABLES = {"xx": "ka mo ti ru so", "yy": "été çon eau ier ê", "zz": "sch ung ver keit ß"}


def prose(draw, lang, n):
    return " ".join("".join(draw.choices(SYLLABLES[lang].split(), k=draw.randrange(1, 4))) for _ in range(n))


def test_language_of_held_out_documents(spark):
    draw = random.Random(1)
    langs = [draw.choice(list(SYLLABLES)) for _ in range(300)]
    rows = [(i, prose(draw, x, draw.randrange(1, 80)), x if i % 7 else None) for i, x in enumerate(langs)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = language_id.language_id(docs).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found) and sum(r.rejected for r in found) < 6


def test_labels_of_held_out_rows_are_not_used(spark):
    draw = random.Random(2)
    rows = [(i, prose(draw, "xx", 30), "xx") for i in range(100)]
    changed = [(i, t, "qq" if zlib.crc32(str(i).encode()) % 4 == 2 else x) for i, t, x in rows]
    for data in (rows, changed):
        docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
        assert {r.lang_pred for r in language_id.language_id(docs).collect()} == {"xx"}


def test_toxicity_of_held_out_documents(spark):
    draw = random.Random(3)
    insults = ["zargol", "blevit", "vequmo", "vequtra", "vequnel", "vequsar"]
    rows, marks = [], []
    for i in range(600):
        words = prose(draw, "xx", draw.randrange(5, 60)).split()
        toxic = draw.random() < 0.2
        for _ in range(3 if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(insults) + ".")
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    held = [r for r in toxicity.toxicity(docs, labels).collect() if r.held_out]
    wrong = sum(r.predicted != marks[r.doc_id][1] for r in held)
    assert len(held) > 100 and wrong <= 0.03 * len(held)
    assert all((r.score >= 0.3) == (r.predicted == 1) for r in held)


def test_a_small_sample_keeps_the_share_of_toxic_documents(spark):
    draw = random.Random(5)
    rows, marks = [], []
    for i in range(3000):
        words = prose(draw, "xx", draw.randrange(20, 60)).split()
        toxic = draw.random() < 0.05
        # words of many toxic and some clean documents
        for word, p in (("zargol", 0.7 if toxic else 0.1), ("blevit", 0.7 if toxic else 0.1)):
            if draw.random() < p:
                words.insert(draw.randrange(len(words)), word)
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").cache()
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    means = []
    for per_label in (100, 100_000):
        found = toxicity.toxicity(docs, labels, toxicity.Supervision(per_label=per_label)).collect()
        means.append(np.mean([r.score for r in found]))
    # a sample with as many toxic as other documents scores like all labelled documents
    assert abs(means[0] - means[1]) < 0.05 and max(means) < 0.2


def test_label_model_finds_rates_without_labels_of_most_rows():
    rng = np.random.default_rng(4)
    truth = rng.random(3000) < 0.3
    votes = np.column_stack(
        [np.where(truth, rng.random(3000) < p, rng.random(3000) < q) for p, q in ((0.7, 0.02), (0.5, 0.05), (0.6, 0.1))]
    ).astype(float)
    copy = votes[:, :1]
    votes = np.column_stack([votes, copy, ~votes.any(axis=1)]).astype(float)
    noisy = np.where(rng.random(3000) < 0.2, ~truth, truth)
    post, rates, weight = toxicity.label_model(votes, np.array([1, 1, 1, 1, 0]), noisy)
    assert np.mean((post > 0.5) == truth) > 0.85
    # the copied voter counts for less than one that stands alone
    assert weight[0] < 0.5 and weight[0] < weight[1] - 0.1


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        out.append(docs.cache())
    return out


def shingles(text, k):
    """Distinct runs of k words, lower-cased in A-Z; the whole sequence where it is shorter."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\\x20\\x09-\\x0D]+", lowered)
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def test_pipeline_against_brute_force(stages):
    start, known, exact, near, mixed, packed = [d.collect() for d in stages]
    assert {r.doc_id for r in known} == {r.doc_id for r in start if any(c.isalpha() for c in r.text or "")}
    last = {}
    for r in known:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert {r.doc_id for r in exact} == set(last.values())
    ordered = sorted(exact, key=lambda r: r.doc_id)
    sets = [shingles(r.text, 5) for r in ordered]
    parent = list(range(len(ordered)))
    for i in range(len(ordered)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((parent[i], parent[j]))
                parent = [a if p == b else p for p in parent]
    assert {r.doc_id for r in near} == {ordered[p].doc_id for p in parent}
    words = sum(len(r.text.split()) for r in near)
    taken = sum(len(r.text.encode().split()) for r in mixed)
    assert abs(taken - words) < 0.01 * words
    assert sum(r.length for r in packed) == taken
    assert stages[4].columns == stages[0].columns


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages[-1].count()


# scores once more, text by text and without NumPy


ODD_TEXTS = [None, "", "a", "ab", "Été ça", "12 34", "NO shouting", "ab" * 300, "\n\n tab\tkamo", "ſ ß 日本"]


def _language_of(model, text):
    """Language, score and rejection of one text by the model's own numbers."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    size, sums, n = len(model.table), [0.0] * len(model.languages), 0
    for width in (2, 3, 4):
        for i in range(len(raw) - width + 1):
            code = int.from_bytes(raw[i : i + width], "big")
            bucket = (((code + width) * 2654435761) % (1 << 32)) >> (32 - (size.bit_length() - 1))
            sums = [a + float(b) for a, b in zip(sums, model.table[bucket])]
            n += 1
    values = [(a / max(n, 1) + b) / model.temperature for a, b in zip(sums, model.bias)]
    parts = [math.exp(v - max(values)) for v in values]
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, True
    score = max(parts) / sum(parts)
    codes = [int.from_bytes(raw[i : i + 3], "big") for i in range(len(raw) - 2)]
    unseen = sum(not model.seen[c // 8] >> c % 8 & 1 for c in codes)
    strange = unseen > model.unseen_most * (len(codes) + model.unseen_spare)
    return model.languages[parts.index(max(parts))], score, score < model.reject or strange


def test_what_was_not_learned_is_rejected(spark):
    draw = random.Random(22)
    rows = [(i, prose(draw, lang, 25), lang) for i, lang in enumerate(["xx", "yy"] * 100)]
    noise = "".join(draw.choices("bcdfghjklmnpqrstvwxz ", k=200))
    other = ["эта запись на другом языке и её никто не учил", noise, "これは別の言語の文章です"]
    usual = ["ka", "été çon", "éau", "12 ka 345", prose(draw, "xx", 400), prose(draw, "yy", 2)]
    rows += [(500 + i, t, None) for i, t in enumerate(usual)] + [(600 + i, t, None) for i, t in enumerate(other)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in language_id.language_id(docs).collect()}
    assert all(found[600 + i].rejected for i in range(len(other)))
    assert not any(r.rejected for i, r in found.items() if i < 600)
    assert all(r.lang_pred in ("xx", "yy") for r in found.values())


def test_language_against_brute_force(spark):
    draw = random.Random(21)
    rows = [(i, prose(draw, draw.choice(list(SYLLABLES)), draw.randrange(1, 30)), "") for i in range(120)]
    rows = [(i, t, next(x for x in SYLLABLES if any(s in t for s in SYLLABLES[x].split()))) for i, t, _ in rows]
    rows += [(200 + i, t, None) for i, t in enumerate(ODD_TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    found = {r.doc_id: r for r in language_id.language_id(docs).collect()}
    kept = {r.doc_id for r in language_id.drop_rejected(docs).collect()}
    for i, text, _ in rows:
        language, score, rejected = _language_of(model, text)
        assert (found[i].lang_pred, found[i].rejected) == (language, rejected)
        assert found[i].score == pytest.approx(score, abs=1e-9)
        assert (i in kept) == (not rejected)


def _mixed(x):
    m = (1 << 64) - 1
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & m
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & m
    return x ^ (x >> 31)


def _known_tokens(text):
    """Hashes of the words and word beginnings of a text."""
    out, m = set(), (1 << 64) - 1
    lowered = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    for word in re.findall(rb"[a-z\x80-\xff]+", lowered):
        plain = [_mixed(sum((b + 1) * pow(0x9E3779B97F4A7C15, k, 1 << 64) for k, b in enumerate(word[:n])) & m)
                 for n in (len(word), *[size for size in toxicity.BEGINNINGS if len(word) > size])]
        sizes = [size for size in toxicity.BEGINNINGS if len(word) > size]
        out.add(plain[0])
        out.update(_mixed((h + size) & m) for h, size in zip(plain[1:], sizes))
    return out


def test_toxicity_against_brute_force(spark):
    draw = random.Random(22)
    rows, marks = [], []
    for i in range(200):
        bad = i % 4 == 0
        rows.append((i, prose(draw, "xx", 20) + (" Zargol, vequmo blevit" if bad else " fine")))
        marks.append((i, int(bad)))
    rows += [(300 + i, t) for i, t in enumerate([*ODD_TEXTS, "ZARGOL zargol", "vequmoxx blevit blevit"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    weights = dict(zip(model.hashes.tolist(), model.weights.tolist()))
    assert weights
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    for i, text in rows:
        z = model.bias + sum(weights.get(h, 0.0) for h in _known_tokens(text))
        score = 1 / (1 + math.exp(-max(-30, min(30, z))))
        assert found[i].score == pytest.approx(score, abs=1e-9)
        assert found[i].predicted == int(score >= 0.3)
    assert found[310].score == found[310].score and found[0].score > found[1].score
