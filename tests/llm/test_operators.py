"""Operators against brute force."""

import collections
import hashlib
import itertools
import random
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomwork.llm import (
    components,
    elias_fano,
    exact_dedup,
    kernels,
    mixing,
    near_dedup,
    packing,
    quality,
    sharding,
    suffix_dedup,
    token_files,
)
from loomwork.llm.suffix_array import suffix_array

SCHEMA = "doc_id bigint, text string, source string"
TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.json"))


def docs_of(spark, texts, sources=None):
    rows = [(i, t, sources[i] if sources else "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


# sharding


def test_table_is_filled_in_turns():
    table = sharding.lookup_table(["a", "b", "c"], 31)
    counts = collections.Counter(table)
    assert sorted(counts.values()) == [10, 10, 11]
    # the rule once more, slot by slot
    prefs = {
        s: [
            (sharding.digest_number(f"{s}#offset") % 31 + j * (sharding.digest_number(f"{s}#skip") % 30 + 1)) % 31
            for j in range(31)
        ]
        for s in "abc"
    }
    plain = {}
    for turn in itertools.cycle("abc"):
        plain[next(x for x in prefs[turn] if x not in plain)] = turn
        if len(plain) == 31:
            break
    assert [plain[i] for i in range(31)] == table


def test_few_slots_move_when_a_shard_leaves():
    names = sharding.SHARDS
    before, after = sharding.lookup_table(names), sharding.lookup_table(names[:-1])
    moved = sum(a != b for a, b in zip(before, after) if a != names[-1])
    assert moved < len(before) * 0.25


@pytest.mark.parametrize("shards, size", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_bad_tables(shards, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, size)


def test_written_shards(spark, tmp_path):
    rows = [(i if i % 3 else 7, f"text {i}", None) for i in range(3000)] + [(None, None, "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string").repartition(5)
    placed = sharding.place(docs)
    sharding.write_shards(placed, str(tmp_path / "out"), 100)
    back = sharding.read_shards(placed, str(tmp_path / "out"))
    key = lambda r: tuple((v is not None, v) for v in r)
    assert back.columns == placed.columns
    assert sorted(back.collect(), key=key) == sorted(placed.collect(), key=key)
    # a third of all rows have one key, and its shard has many files
    hot = placed.where("doc_id = 7").first().shard
    assert len(list((tmp_path / "out" / f"shard={hot}").glob("part-*"))) >= 5
    again = sharding.shard_documents(docs.where("false"))
    assert again.columns == placed.columns and again.collect() == []


# packing


def padding(lengths, counts, cuts):
    edges = np.searchsorted(cuts, lengths)
    return sum(c * (cuts[e] - x) for x, c, e in zip(lengths, counts, edges))


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 5))
@settings(max_examples=150, deadline=None)
def test_boundaries_are_the_best(histogram, buckets):
    lengths, counts = np.array(sorted(histogram)), np.array([histogram[x] for x in sorted(histogram)])
    cuts = packing.boundaries(lengths, counts, buckets)
    assert len(cuts) <= buckets and cuts[-1] == lengths[-1] and set(cuts) <= set(lengths.tolist())
    best = min(
        padding(lengths, counts, [*inner, lengths[-1]])
        for k in range(min(buckets, len(lengths)))
        for inner in itertools.combinations(lengths[:-1].tolist(), k)
    )
    assert padding(lengths, counts, cuts) == best


def test_batches_keep_the_budget(spark):
    draw = random.Random(3)
    texts = [" ".join(["x"] * draw.choice([3, 5, 8, 40, 150])) for _ in range(400)]
    how = packing.Packing(max_length=64, buckets=3, budget=256, block_rows=16)
    rows = packing.pack(docs_of(spark, texts), how).collect()
    assert sum(r.length for r in rows) == sum(len(t.split()) for t in texts)
    batches = collections.defaultdict(list)
    for r in rows:
        assert r.length <= r.bucket and r.start == 64 * r.piece
        batches[r.bucket, r.batch].append(r.slot)
    sizes = collections.defaultdict(list)
    for (bucket, _), slots in sorted(batches.items()):
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= max(1, 256 // bucket)
        sizes[bucket].append(len(slots))
    # only a bucket's last batch may have room left
    for bucket, found in sizes.items():
        assert sum(x < max(1, 256 // bucket) for x in found) <= 1


# token files


@given(st.lists(st.integers(0, 2**62), min_size=1, max_size=700))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values):
    values = sorted(values)
    code = elias_fano.encode(np.array(values, dtype=np.uint64))
    assert elias_fano.decode(code).tolist() == values
    assert [elias_fano.select(code, i) for i in range(0, len(values), 37)] == values[::37]
    at = np.arange(len(values))[::-3]
    assert elias_fano.select_many(code, at).tolist() == [values[i] for i in at]
    with pytest.raises(IndexError):
        elias_fano.select_many(code, np.array([len(values)]))


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 800, 20_000))
    code = elias_fano.encode(values)
    bits = 8 * sum(len(code[c]) for c in ("low", "high", "samples"))
    assert bits / len(values) < 2.3 + np.log2(values[-1] / len(values))
    with pytest.raises(IndexError):
        elias_fano.select(code, 20_000)


@given(st.text(alphabet=" \n\t\r\x0b\x1c ab'sé.,1<|>", max_size=40))
@settings(max_examples=500, deadline=None)
def test_pieces_encode_as_the_whole_text(text):
    encoder = token_files._encoder(TOKENIZER)
    raw, bounds = encoder.encode(pa.array([text, "", text]))
    own = encoder.whole(text)
    assert raw.tobytes() == own + own and bounds.tolist() == [0, *[len(own) // 2] * 2, len(own)]


def test_token_files_round_trip(spark, tmp_path):
    draw = random.Random(4)
    texts = [" ".join(draw.choices(["Haus", "the", "of.", "x\ny", "été", "<|endoftext|>"], k=draw.randrange(90))) for _ in range(200)]
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs_of(spark, texts), path, TOKENIZER)
    rows = {r.doc_id: r for r in token_files.read_token_files(spark, path).collect()}
    library = token_files._encoder(TOKENIZER).library
    at = 0
    for i, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (at, len(ids), crc)
        at += len(ids)
    for segment in spark.read.schema(token_files.SCHEMA).parquet(path).collect():
        segment = segment.asDict(recursive=True)
        doc_ids, ends, ids = token_files.documents_of(segment)
        for k in range(len(doc_ids)):
            own = token_files.ids_at(segment, k)
            start = ends[k - 1] if k else 0
            assert own.tolist() == ids[start : ends[k]].tolist()


# exact dedup


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: c.substr(1, 1)])
def test_exact_dedup(spark, digest):
    draw = random.Random(5)
    texts = [draw.choice(["ab", "ac", "b", "", None, "a" * 5000]) for _ in range(120)]
    rows = exact_dedup.exact_dedup(docs_of(spark, texts), digest, salts=3).collect()
    groups = collections.defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    assert len(rows) == len(texts)
    for r in rows:
        own = groups[texts[r.doc_id] or ""]
        assert (r.keep_id, r.group_size, r.kept) == (max(own), len(own), r.doc_id == max(own))
        assert r.text_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


# mixing


@given(
    st.dictionaries(st.integers(1, 30), st.integers(1, 4), min_size=1, max_size=6),
    st.floats(0, 1),
    st.sampled_from([4, 1000]),
)
@settings(max_examples=200, deadline=None)
def test_knapsack_comes_close(histogram, share, window):
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[x] for x in lengths])
    budget = int(share * (lengths * counts).sum())
    taken = mixing.fitted(lengths, counts, budget, window)
    assert (taken >= 0).all() and (taken <= counts).all()
    got = int((taken * lengths).sum())
    assert got <= budget
    if min(window, mixing.RESERVED * int(lengths.max())) >= budget:
        # the knapsack has the whole budget, so no subset comes closer
        reach = {0}
        for x, n in zip(lengths.tolist(), counts.tolist()):
            reach = {s + k * x for s in reach for k in range(n + 1)}
        assert got == max(s for s in reach if s <= budget)


@pytest.mark.parametrize(
    ("histogram", "budget", "expected"),
    [
        # one text is longer than the budget, the others come to exactly the budget
        ({100: 2000, 300_000: 1}, 200_000, 200_000),
        # a text that fits at first, but not once others are taken
        ({100: 2000, 190_000: 1}, 200_000, 200_000),
        # no spare text fits into what is left
        ({10_000: 10, 300_000: 1}, 290_000, 100_000),
    ],
)
def test_long_texts_leave_the_budget_to_others(histogram, budget, expected):
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[x] for x in lengths])
    taken = mixing.fitted(lengths, counts, budget, mixing.Mixture().window)
    assert (taken >= 0).all() and (taken <= counts).all()
    assert int((taken * lengths).sum()) == expected


def brute_targets(sizes, weights, cap=3.0):
    full, total = set(), float(sum(sizes.values()))
    while True:
        open_weight = sum(w for s, w in weights.items() if s not in full)
        left = total - sum(cap * sizes[s] for s in full)
        over = {s for s, w in weights.items() if s not in full and left * w / open_weight > cap * sizes[s] + 1e-9}
        if not over:
            return {s: cap * sizes[s] if s in full else left * weights[s] / open_weight for s in sizes}
        full |= over


def test_mix_meets_targets(spark):
    draw = random.Random(6)
    names = ["a", "b", None, "B", "d"]
    sources = [names[min(int(draw.expovariate(1)), 4)] for _ in range(500)]
    texts = [" ".join(["x"] * draw.choice([1, 2, 3, 50, 51])) for _ in range(500)]
    how = mixing.Mixture(block_rows=20)
    rows = mixing.mix(docs_of(spark, texts, sources), how).collect()
    again = mixing.mix(docs_of(spark, texts, sources).repartition(3), how).collect()
    assert sorted(rows) == sorted(again)
    order = sorted((s for s in set(sources) if s is not None)) + ([None] if None in sources else [])
    sizes = {s: sum(len(t.split()) for t, x in zip(texts, sources) if x == s) for s in order}
    weights = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    wanted = brute_targets(sizes, weights)
    got = collections.Counter()
    for r in rows:
        got[sources[r.doc_id]] += r.taken
        assert r.target == pytest.approx(wanted[sources[r.doc_id]])
        assert r.source_size == sizes[sources[r.doc_id]] and r.taken <= 3 * r.size
    for s in order:
        assert abs(got[s] - wanted[s]) <= 1


def test_draw_repeats_rows(spark):
    docs = docs_of(spark, ["a b c"] * 30, ["x"] * 3 + ["y"] * 27)
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    drawn = collections.Counter(r.doc_id for r in mixing.draw(docs).collect())
    assert drawn == {i: n for i, n in taken.items() if n} and max(drawn.values()) > 1


# near dedup


def link_components(sets, percent=80):
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def shingles(text, k):
    """Distinct runs of k words, lower-cased in A-Z; the whole sequence where it is shorter."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\\x20\\x09-\\x0D]+", lowered)
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def test_refused_links_hide_no_others(spark, monkeypatch):
    """Of six links between two components the words refuse all but one; it is found all the same."""
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join(base[:i] + ["own%d" % i] + base[i + 1 :]) for i in range(0, 24, 4)]
    texts.append(" ".join(base[:40] + ["last"] + base[41:]))
    last, confirmed, asked = len(texts) - 1, near_dedup._confirmed, []

    def stricter(pairs, *rest):
        asked.append(pairs.count())
        return confirmed(pairs, *rest).where(f"b <> {last} OR a = {last - 1}")

    how = near_dedup.Sketching(words=2, partners=1)
    docs = docs_of(spark, texts)
    assert {r.component_id for r in near_dedup.near_components(docs, how).collect()} == {0}
    monkeypatch.setattr(near_dedup, "_confirmed", stricter)
    rows = {r.doc_id: r.component_id for r in near_dedup.near_components(docs, how).collect()}
    assert rows == dict.fromkeys(range(len(texts)), 0)
    assert len(asked) > 1



@pytest.mark.parametrize("words, block", [(2, 1024), (5, 4)])
def test_near_components(spark, words, block):
    draw = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [draw.choices(vocabulary, k=60) for _ in range(12)]
    texts = []
    for _ in range(150):
        own = list(draw.choice(base))
        for _ in range(draw.randrange(7)):
            own[draw.randrange(60)] = draw.choice(vocabulary)
        texts.append(" ".join(own))
    texts += ["A b", "a  B", "a", "", None, "c d e"] + texts[:20]
    how = near_dedup.Sketching(words=words, block=block)
    rows = {r.doc_id: r for r in near_dedup.near_components(docs_of(spark, texts), how).collect()}
    sets = [shingles(t, words) for t in texts]
    wanted = link_components(sets)
    assert [rows[i].n_shingles for i in range(len(texts))] == list(map(len, sets))
    assert [rows[i].component_id for i in range(len(texts))] == wanted
    assert [rows[i].kept for i in range(len(texts))] == [i == c for i, c in enumerate(wanted)]


def test_shingles_that_share_half_a_hash(spark):
    words = [f"w{i}" for i in range(400_000)]
    hashes, _ = near_dedup.shingle_sets(pa.array(words), 1)
    high = hashes >> np.uint64(32)
    order = np.argsort(high, kind="stable")
    again = np.flatnonzero(high[order][1:] == high[order][:-1])[:6]
    common = sorted({words[order[k + d]] for k in again.tolist() for d in (0, 1)})
    assert len(again) == 6 and len(common) == 12
    # 12 of 15 words in common; the first document is the bucket's head and near to neither
    texts = [" ".join(x) for x in (common[:9] + list("cdefgh"), common + ["i", "j"], common + ["k"])]
    hashes, bounds = near_dedup.shingle_sets(pa.array(texts), 1)
    for seed in range(1000):
        how = near_dedup.Sketching(words=1, bands=1, rows=1, seed=seed)
        if len(np.unique(near_dedup.sketches(hashes, bounds, how))) == 1:
            break
    rows = {r.doc_id: r for r in near_dedup.near_components(docs_of(spark, texts), how).collect()}
    assert [rows[i].component_id for i in range(3)] == link_components([set(t.split()) for t in texts]) == [0, 1, 1]


@pytest.mark.parametrize("size", [0, 1, 1000])
def test_ranks(size):
    values = np.random.default_rng(12).choice(np.arange(1, 400, dtype=np.uint64) << np.uint64(40), size)
    ranks = near_dedup._ranks(values)
    assert len(ranks) == size and (ranks.astype(np.int64) == np.unique(values, return_inverse=True)[1]).all()


def test_registers_estimate_similarity():
    how = near_dedup.Sketching(words=1)
    shared = [f"s{i}" for i in range(800)]
    texts = [" ".join(shared + [f"a{i}" for i in range(100)]), " ".join(shared + [f"b{i}" for i in range(200)])]
    hashes, bounds = near_dedup.shingle_sets(pa.array(texts), 1)
    registers = near_dedup.sketches(hashes, bounds, how)
    n = np.diff(bounds)
    best, _ = near_dedup.estimates(registers[:1], registers[1:], n[:1], n[1:], how)
    assert best[0] == pytest.approx(800 / 1100, abs=0.1)
    # registers of a union are the maxima
    joined, both = near_dedup.shingle_sets(pa.array([" ".join(texts)]), 1)
    assert (near_dedup.sketches(joined, both, how)[0] == registers.max(axis=0)).all()


def test_components(spark):
    draw = random.Random(8)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    found = {r.doc_id: r.component_id for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent = {x: x for pair in links for x in pair}
    for _ in range(200):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == {x: p for x, p in parent.items() if any(x in (a, b) for a, b in links if a != b)}


# suffix dedup


@given(st.lists(st.integers(1, 3), min_size=1, max_size=80), st.integers(1, 90))
@settings(max_examples=200, deadline=None)
def test_suffix_array(symbols, enough):
    t = np.array(symbols)
    found = suffix_array(t, enough)
    assert sorted(found.tolist()) == list(range(len(t)))
    prefixes = [tuple(symbols[i : i + enough]) for i in found]
    assert prefixes == sorted(prefixes)


@given(st.lists(st.text("ab", max_size=60), min_size=1, max_size=6), st.integers(1, 30))
@settings(max_examples=100, deadline=None)
def test_least_hashes_over_blocks(texts, block):
    how = suffix_dedup.Passages(length=12, gram=5)
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    expected = [(int(offsets[i]) + p, i, t[p : p + 12]) for i, t in enumerate(texts) for p in range(len(t) - 11)]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(suffix_dedup, "_BLOCK", block)
        starts, text, least = suffix_dedup.least_hashes(raw, offsets, how)
    assert list(zip(starts.tolist(), text.tolist())) == [e[:2] for e in expected]
    for (_, _, string), found in zip(expected, least.tolist()):
        alone = np.frombuffer(string.encode(), np.uint8)
        own = suffix_dedup.least_hashes(alone, np.array([0, 12]), how)[2]
        assert own.tolist() == [found]


def brute_removed(texts, length):
    first = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            first.setdefault(t[p : p + length], i)
    out = []
    for i, t in enumerate(texts):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(
    "how",
    [
        suffix_dedup.Passages(),
        suffix_dedup.Passages(length=12, gram=5, answered=2, hot=3, hot_share=0.0, sorted_bytes=200),
        suffix_dedup.Passages(length=6, gram=3),
    ],
)
def test_suffix_dedup(spark, how):
    draw = random.Random(9)
    passage = "".join(draw.choices("abcdefé ", k=90))
    texts = []
    for _ in range(80):
        t = "".join(draw.choices("abcdefghé ", k=draw.randrange(140)))
        at = draw.randrange(len(t) + 1)
        cut = draw.randrange(20)
        texts.append(t[:at] + passage[cut : 90 - draw.randrange(20)] + t[at:] if draw.random() < 0.6 else t)
    texts += texts[:10] + ["a" * 300, "a" * 120, ""]
    rows = {r.doc_id: r for r in suffix_dedup.suffix_dedup(docs_of(spark, texts), how).collect()}
    for i, wanted in enumerate(brute_removed([t.encode() for t in texts], how.length)):
        r = rows[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == wanted


# quality


def brute_counts(text):
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {
        j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)
    }
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


@given(st.lists(st.text(alphabet="ab é\n\t#|", max_size=80), max_size=6))
@settings(max_examples=150, deadline=None)
def test_quality_counts(texts):
    found = quality.quality_kernel(quality.Bands())(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert tuple(int(found[c][i]) for c in range(5)) == brute_counts(text)


def test_quality_bands(spark):
    draw = random.Random(10)
    syllables = "ti on er th re an ed le mo sa ku vi or ne".split()
    prose = " ".join("".join(draw.choices(syllables, k=draw.randrange(1, 4))) for _ in range(3000))
    noise = "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=9000))
    noise = " ".join(noise[i : i + 60] for i in range(0, 9000, 60))
    half = prose[:9000] + "ab " * 6000
    rows = {r.doc_id: r for r in quality.quality(docs_of(spark, [prose, noise, half, "la " * 4000])).collect()}
    assert rows[0].kept and not rows[1].kept and not rows[2].kept and not rows[3].kept
    assert not rows[1].base_failed


@pytest.mark.parametrize("size", [4097, 6000, 8000, 8191])
def test_chunks_of_texts_below_two_chunks(size):
    draw = random.Random(9)
    vocabulary = ["".join(draw.choices("etaoinshrdlu", k=draw.randrange(2, 9))) for _ in range(600)]
    prose = " ".join(draw.choices(vocabulary, k=3000))
    noise = "".join(draw.choices(string.ascii_letters + string.digits + "+/", k=4096))
    texts = [prose[:size], (noise + " " + prose)[:size], ("la " * 1366)[:4096] + noise[: size - 4096]]
    ratio, bad = quality.quality_kernel(quality.Bands())(pa.array(texts, pa.string()))[5:]
    assert bad[0] < 0.5
    assert (bad[1:] >= 0.5).all()
    if size == 8000:  # the halves cancel out in the whole text
        assert 0.26 <= ratio[1].as_py() <= 0.72


# kernels


@given(st.lists(st.text(alphabet="ab é\n\x0b", max_size=12), max_size=5))
@settings(max_examples=150, deadline=None)
def test_words(texts):
    raw, offsets = kernels.text_bytes(pa.array(texts, pa.string()))
    w = kernels.words(raw, offsets)
    found = [
        [bytes(raw[w.starts[j] : w.ends[j]]) for j in range(w.first[i], w.first[i + 1])] for i in range(len(texts))
    ]
    assert found == [t.encode().split() for t in texts]
    by_word = collections.defaultdict(set)
    for j in range(len(w.starts)):
        by_word[bytes(raw[w.starts[j] : w.ends[j]])].add(int(w.hashes[j]))
    assert all(len(h) == 1 for h in by_word.values())
    assert len({min(h) for h in by_word.values()}) == len(by_word)


# words whose polynomials modulo 2^64 are equal


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_with_equal_polynomials_are_told_apart(spark):
    one = _thue_morse(2048)
    two = one.translate(str.maketrans("ab", "ba"))
    found = near_dedup.near_components(docs_of(spark, [one, two]), near_dedup.Sketching(words=2, percent=80))
    assert {r.doc_id: r.component_id for r in found.collect()} == {0: 0, 1: 1}
    lines = f"{one}\n{two}\n{one}"
    many = " ".join([one, *"bcdefgh", two, *"bcdefgh"])
    counts = {r.doc_id: r for r in quality.quality(docs_of(spark, [f"{one}\n{two}", lines, many])).collect()}
    assert [counts[i].n_dup_lines for i in range(3)] == [0, 1, 0]
    assert [counts[i].n_repeat_words for i in range(3)] == [0, 0, 0]


def test_content_hashes_tell_ranges_apart():
    raw = np.frombuffer(b"abcabc\x00\x00abd", np.uint8)
    starts, stops = np.array([0, 3, 0, 6, 7, 8, 0]), np.array([3, 6, 2, 8, 8, 11, 0])
    found = kernels.content_hashes(raw, starts, stops)
    assert found[0] == found[1] and len(set(found.tolist())) == 6
    long = np.frombuffer(random.Random(1).randbytes(1 << 12) * 2, np.uint8)
    twice = kernels.content_hashes(long, np.array([0, 1 << 12]), np.array([1 << 12, 1 << 13]))
    assert twice[0] == twice[1]


def test_short_hashes_lose_no_link(spark, monkeypatch):
    """Sets of one-byte hashes have many equal ones; what they hide is allowed for."""
    draw = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(6):
        base = [draw.choice(words) for _ in range(120)]
        for cut in range(4):
            texts.append(" ".join(base[cut * 4 :]))
    how = near_dedup.Sketching(words=2, percent=80)
    whole = {r.doc_id: r.component_id for r in near_dedup.near_components(docs_of(spark, texts), how).collect()}
    monkeypatch.setattr(near_dedup, "HASH_BYTES", 1)
    assert {r.doc_id: r.component_id for r in near_dedup.near_components(docs_of(spark, texts), how).collect()} == whole
