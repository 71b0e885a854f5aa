"""Set-similarity join and weighted MinHash against plain Python."""

import hashlib
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from loomwork.functions.text import PRIME
from loomwork.operators import setjoin, similarity, weighted


def sets_of(seed, n=60):
    draw = random.Random(seed)
    words = [f"s{i}" for i in range(150)]
    out = {}
    for i in range(n):
        if i % 3 and i > 3:
            base = sorted(out[draw.choice(list(out))] or {"s0"})
            kept = [w for w in base if draw.random() > 0.08]
            out[i] = set(kept) | {w for w in draw.sample(words, 2) if draw.random() < 0.3}
        else:
            out[i] = set(draw.sample(words, draw.randrange(1, 40)))
    out[1000], out[1001] = set(), set(out[0])
    # a shingle that is in all sets
    return {k: v | {"everywhere"} if v else v for k, v in out.items()}


def frame(spark, sets):
    return spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "doc_id int, shingles array<string>").repartition(5)


@pytest.mark.parametrize("percent", [50, 80, 100])
@pytest.mark.parametrize("small", [3, 1_000_000])
def test_similar_sets_against_all_pairs(spark, percent, small):
    sets = sets_of(percent)
    classes = setjoin.set_classes(frame(spark, sets), salt_rows=small)
    named = {r.doc_id: r.set_id for r in classes.collect()}
    assert named == {k: min(j for j in sets if sets[j] == v) for k, v in sets.items() if v}
    found = setjoin.similar_sets(classes, percent, pair_rows=small, salt_rows=small)
    expected = set()
    for a, b in itertools.combinations(sorted(set(named.values())), 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * len(sets[a] | sets[b]):
            expected.add((a, b, common, len(sets[a]), len(sets[b])))
    assert {tuple(r) for r in found.collect()} == expected
    assert percent == 100 or expected


def test_no_sets_and_bad_threshold(spark):
    classes = setjoin.set_classes(frame(spark, {1: set()}))
    assert setjoin.similar_sets(classes).collect() == []
    with pytest.raises(ValueError):
        setjoin.similar_sets(classes, 0)


def test_recall_of_candidates(spark):
    sets = sets_of(4)
    shingled = frame(spark, sets)
    classes = setjoin.set_classes(shingled)
    similar = setjoin.similar_sets(classes, 60)
    groups = similarity.signature_groups(similarity.minhash(shingled, 20))
    pairs = similarity.group_pairs(groups, 20, 5)
    row = setjoin.candidate_recall(classes, similar, groups, pairs).first()
    candidates = {(r.doc_id_1, r.doc_id_2) for r in similarity.candidate_pairs(groups, pairs, 20, 5).collect()}
    wanted = {(r.set_id_1, r.set_id_2) for r in similar.collect()}
    assert tuple(row) == (len(wanted), len(wanted & candidates), pytest.approx(len(wanted & candidates) / len(wanted)))


def test_share_of_equal_samples_is_the_weighted_similarity(spark):
    draw = random.Random(6)
    weight = {f"s{i}": draw.choice([0.05, 0.5, 1.0, 3.0, 8.0]) for i in range(120)}
    sets = {i: set(draw.sample(sorted(weight), 60)) for i in range(6)}
    sets[6] = set(sets[0])
    rows = [(i, s, weight[s]) for i, own in sets.items() for s in own]
    k = 1500
    samples = weighted.weighted_minhash(spark.createDataFrame(rows, "doc_id int, shingle string, weight double"), k)
    pairs = spark.createDataFrame(list(itertools.combinations(sets, 2)), "doc_id_1 int, doc_id_2 int")
    for r in weighted.sample_similarity(pairs, samples).collect():
        a, b = sets[r.doc_id_1], sets[r.doc_id_2]
        true = sum(weight[s] for s in a & b) / sum(weight[s] for s in a | b)
        assert abs(r.similarity - true) <= 3 * math.sqrt(true * (1 - true) / k) + 1e-12
        if (r.doc_id_1, r.doc_id_2) == (0, 6):
            assert r.similarity == 1


def test_different_weights_of_one_shingle(spark):
    """The weights of a shingle may differ between documents: min over max counts."""
    rows = [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (2, "b", 2.0)]
    samples = weighted.weighted_minhash(spark.createDataFrame(rows, "doc_id int, shingle string, weight double"), 2000)
    (row,) = weighted.sample_similarity(spark.createDataFrame([(1, 2)], "doc_id_1 int, doc_id_2 int"), samples).collect()
    assert abs(row.similarity - 3 / 5) <= 3 * math.sqrt(0.24 / 2000)


def test_samples_are_drawn_once_and_a_document_at_a_time(spark, monkeypatch):
    draw = random.Random(8)
    rows = [(i, f"w{draw.randrange(400)}-{j}", draw.choice([0.5, 1.0, 4.0])) for i in (1, 2, 3, None) for j in range(60)]
    table = spark.createDataFrame(rows, "doc_id int, shingle string, weight double")
    samples = weighted.weighted_minhash(table, 8)
    plan = samples.select("doc_id", F.posexplode("samples"))._jdf.queryExecution().optimizedPlan().toString().lower()
    # a filter on the samples does not draw them again, and no row holds a document's shingles
    assert plan.count("mapinarrow") + plan.count("evalpython") == 1 and "collect_list" not in plan
    whole = {r.doc_id: r.samples for r in samples.collect()}
    assert set(whole) == {1, 2, 3, None}
    # documents that pass in several batches
    monkeypatch.setattr(weighted, "KERNEL_ROWS", 7)
    assert {r.doc_id: r.samples for r in weighted.weighted_minhash(table, 8).collect()} == whole
    for i, own in whole.items():
        expected = []
        for maps in weighted.sampling_parameters(8, 42):
            scored = []
            for _, shingle, weight in (r for r in rows if r[0] == i):
                digest = hashlib.md5(shingle.encode()).digest()
                u = [((a * int.from_bytes(digest[3 * j : 3 * j + 3]) + b) % PRIME + 0.5) / PRIME for j, (a, b) in enumerate(maps)]
                r, c = -math.log(u[0] * u[1]), -math.log(u[2] * u[3])
                t = math.floor(math.log(weight) / r + u[4])
                scored.append((math.log(c) - r * (t - u[4]) - r, shingle, t))
            expected.append(min(scored)[1:])
        assert [(s.shingle, s.t) for s in own] == expected


def test_weights_of_zero_are_left_out(spark):
    shingled = frame(spark, {1: {"x", "y"}, 2: {"x"}})
    rows = weighted.weighted_shingles(shingled, similarity.idf(shingled)).collect()
    assert [(r.doc_id, r.shingle) for r in rows] == [(1, "y")]


def test_no_shuffle_of_the_prefixes_carries_shingles(spark):
    classes = setjoin.set_classes(frame(spark, sets_of(7)))
    heads = classes.where("doc_id = set_id").select("set_id", "shingles")
    plan = setjoin._places(heads, 80)._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan[plan.index("RepartitionByExpression") :].splitlines()
    assert "mapinarrow" in dealt[1].lower()
    # sets that are alike in nothing have no place, however many hashes they have
    alone = frame(spark, {i: {f"{i}-{j}" for j in range(30)} for i in range(20)})
    own = setjoin.set_classes(alone).select("set_id", "shingles")
    assert setjoin._places(own, 80).count() == 0
