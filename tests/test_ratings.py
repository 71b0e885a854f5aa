import math
import random

import pytest
from pyspark.sql import functions as F

from loomwork.operators import ratings as ops

SCHEMA = "user_id int, item_id int, rating int"


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    cells = [(u, i) for u in range(1, 16) for i in range(1, 13)]
    # user 1 rated everything, item 2 was rated by everybody
    kept = [c for c in cells if c[0] == 1 or c[1] == 2 or draw.random() < 0.4]
    return [(u, i, draw.randint(1, 5)) for u, i in kept]


def centered(rows, axis):
    groups = {}
    for r in rows:
        groups.setdefault(r[axis], []).append(r[2])
    return {(u, i): x - sum(groups[(u, i)[axis]]) / len(groups[(u, i)[axis]]) for u, i, x in rows}


def test_rankings(spark):
    data = make(spark, [(1, 7, 4), (2, 7, 5), (1, 8, 5), (2, 9, 5)])
    users = spark.createDataFrame([(1, "F"), (2, "M")], "user_id int, gender string")
    items = spark.createDataFrame([(7, "a|b"), (8, "a"), (9, "b")], "item_id int, genres string")
    assert [tuple(r) for r in ops.top_rated(data).collect()] == [(8, 5.0), (9, 5.0), (7, 4.5)]
    by = [tuple(r) for r in ops.top_rated_by(data, users, "gender").collect()]
    assert by == [(7, "M", 5.0), (8, "F", 5.0), (9, "M", 5.0), (7, "F", 4.0)]
    assert [tuple(r) for r in ops.user_means(data).collect()] == [(2, 5.0), (1, 4.5)]
    whole = {(r.user_id, r.genre): r.score for r in ops.user_genre_means(data, items).collect()}
    assert whole == {(1, "a|b"): 4.0, (2, "a|b"): 5.0, (1, "a"): 5.0, (2, "b"): 5.0}
    single = {(r.user_id, r.genre): r.score for r in ops.user_genre_means(data, items, True).collect()}
    assert single == {(1, "a"): 4.5, (1, "b"): 4.0, (2, "a"): 5.0, (2, "b"): 5.0}


@pytest.mark.parametrize("by, axis", [("user", 0), ("item", 1)])
@pytest.mark.parametrize("salt_rows", [3, 1_000_000])
def test_center(spark, rows, by, axis, salt_rows):
    found = ops.center(make(spark, rows), by, salt_rows=salt_rows).collect()
    expected = centered(rows, axis)
    assert len(found) == len(rows)
    for r in found:
        assert r.centered == pytest.approx(expected[r.user_id, r.item_id])


def test_center_nulls(spark):
    data = make(spark, [(1, 1, 2), (1, 2, None), (None, 3, 4), (2, None, 4), (3, 1, None)])
    found = {(r.user_id, r.item_id): r.centered for r in ops.center(data, "user").collect()}
    assert found == {(1, 1): 0.0, (1, 2): 0.0, (3, 1): 0.0}


def similarities(rows, axis, target):
    x = centered(rows, axis)
    mine = {c[1 - axis]: v for c, v in x.items() if c[axis] == target}
    norm = math.sqrt(sum(v * v for v in mine.values()))
    found = {}
    for other in {c[axis] for c in x} - {target}:
        shared = {c[1 - axis]: v for c, v in x.items() if c[axis] == other and c[1 - axis] in mine}
        if shared:
            own = math.sqrt(sum(v * v for v in shared.values()))
            dot = sum(v * mine[k] for k, v in shared.items())
            found[other] = dot / (own * norm) if own * norm else None
    return found


@pytest.mark.parametrize("by, axis, column", [("user", 0, "user_id"), ("item", 1, "item_id")])
@pytest.mark.parametrize("target", [1, "2"])
def test_similar(spark, rows, by, axis, column, target):
    found = ops.similar(make(spark, rows), by, target).collect()
    expected = similarities(rows, axis, int(target))
    assert {r[column] for r in found} == set(expected)
    for r in found:
        assert r.similarity == pytest.approx(expected[r[column]])
    scores = [r.similarity for r in found if r.similarity is not None]
    assert scores == sorted(scores, reverse=True)


def test_zero_norm_is_null_and_strangers_are_left_out(spark):
    data = make(spark, [(1, 1, 5), (1, 2, 1), (2, 1, 3), (2, 2, 3), (3, 9, 4)])
    assert [tuple(r) for r in ops.similar(data, "user", 1).collect()] == [(2, None)]


@pytest.mark.parametrize("target", [99, "no id", None])
def test_unknown_target(spark, rows, target):
    data = make(spark, rows)
    assert ops.similar(data, "user", target).count() == 0
    assert ops.recommend_user_based(data, target).count() == 0
    assert ops.recommend_item_based(data, target).count() == 0


def user_based(rows, user):
    x, sims = centered(rows, 1), similarities(rows, 0, user)
    seen = {i for u, i, _ in rows if u == user}
    scores = {}
    for item in {i for _, i, _ in rows} - seen:
        pairs = [(v, sims[u]) for (u, i), v in x.items() if i == item and sims.get(u) is not None]
        if any(i == item and u in sims for u, i in x):
            weight = sum(abs(s) for _, s in pairs)
            scores[item] = sum(v * s for v, s in pairs) / weight if weight else None
    return scores


def item_based(rows, user):
    x = centered(rows, 1)
    mine = {i: v for (u, i), v in x.items() if u == user}
    norm = {}
    for (_, i), v in x.items():
        norm[i] = norm.get(i, 0.0) + v * v
    scores = {}
    for item in {i for _, i, _ in rows} - set(mine):
        top = weight = 0.0
        met = False
        for j, r in mine.items():
            common = [u for (u, i) in x if i == j and (u, item) in x]
            if common:
                met = True
                n = math.sqrt(norm[j]) * math.sqrt(norm[item])
                if n:
                    s = sum(x[u, j] * x[u, item] for u in common) / n
                    top, weight = top + s * r, weight + abs(s)
        if met:
            scores[item] = top / weight if weight else None
    return scores


def test_hot_keys_do_not_change_scores(spark, rows):
    data = make(spark, rows)
    plain = ops.recommend_user_based(data, 2, k=50).collect()
    split = ops.recommend_user_based(data, 2, k=50, salt_rows=3).collect()
    assert {r.item_id: pytest.approx(r.score) for r in plain} == {r.item_id: r.score for r in split}


@pytest.mark.parametrize("operator, expected", [
    (ops.recommend_user_based, user_based),
    (ops.recommend_item_based, item_based),
])
@pytest.mark.parametrize("user", [2, 3])
def test_recommendations(spark, rows, operator, expected, user):
    found = operator(make(spark, rows), user, k=50).collect()
    wanted = expected(rows, user)
    assert {r.item_id for r in found} == set(wanted)
    for r in found:
        assert r.score == (wanted[r.item_id] if wanted[r.item_id] is None else pytest.approx(wanted[r.item_id]))
    assert len(operator(make(spark, rows), user, k=2).collect()) == min(2, len(wanted))


def test_more_hot_keys_than_a_fixed_list(spark):
    from loomwork.operators.skew import attach, hot_keys

    rows = spark.range(1500 * 4).selectExpr("id div 4 AS k", "id AS v")
    counts = rows.groupBy("k").count()
    assert hot_keys(counts, ["k"], "count", 3).count() == 1500
    joined = attach(rows, counts, ["k"], ["v"], salt_rows=3)
    assert joined.count() == 6000 and joined.where("count <> 4").count() == 0


def test_ratings_are_made_once_for_user_based_recommendations(spark, rows):
    derived = make(spark, rows).groupBy("user_id", "item_id").agg(F.max("rating").alias("rating"))
    found = ops.recommend_user_based(derived, 2, k=50)
    assert "max(rating" not in found._jdf.queryExecution().optimizedPlan().toString()
    wanted = user_based(rows, 2)
    assert {r.item_id: r.score for r in found.collect()} == {i: x if x is None else pytest.approx(x) for i, x in wanted.items()}
