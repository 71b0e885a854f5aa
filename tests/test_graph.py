import random

import numpy as np
import pytest

from loomwork.operators import graph

# node 5 dangles, node 1 has no in-edges, 3 links to itself, 1 -> 2 occurs twice
SMALL = [("1", "2"), ("1", "2"), ("2", "3"), ("3", "3"), ("3", "2"), ("2", "5")]


def make(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string")


def random_edges():
    draw = random.Random(11)
    edges = [(str(draw.randrange(40)), str(draw.randrange(40))) for _ in range(150)]
    # node 0 has a third of all edges, in both directions
    return edges + [("0", str(draw.randrange(40))) for _ in range(75)] + [
        (str(draw.randrange(30)), "0") for _ in range(75)
    ]


def matrix(edges):
    ids = sorted({n for e in edges for n in e})
    at = {n: i for i, n in enumerate(ids)}
    a = np.zeros((len(ids), len(ids)))
    for s, d in edges:
        a[at[s], at[d]] += 1
    return ids, a


def test_degrees_count_distinct(spark):
    edges = make(spark, [*SMALL, (None, "1"), ("1", None)])
    assert {tuple(r) for r in graph.out_degree(edges).collect()} == {("1", 1), ("2", 2), ("3", 2)}
    assert [tuple(r) for r in graph.in_degree(edges).collect()] == [("2", 2), ("3", 2), ("5", 1)]


def lists(edges, **options):
    found = {}
    for r in graph.adjacency(edges, **options).collect():
        found.setdefault((r.node, r.direction), []).append(r.neighbours)
    return found


def expected_lists(edges):
    wanted = {}
    for s, d in edges:
        wanted.setdefault((s, "out"), []).append(d)
        wanted.setdefault((d, "in"), []).append(s)
    return {k: sorted(v) for k, v in wanted.items()}


def test_adjacency_keeps_repeats(spark):
    found = lists(make(spark, SMALL))
    assert {k: v[0] for k, v in found.items()} == expected_lists(SMALL)
    assert all(len(v) == 1 for v in found.values())


def test_adjacency_of_hubs_is_cut_but_whole(spark):
    edges = random_edges() + [("7", "8")] * 40
    found = lists(make(spark, edges), per_row=10, salt_rows=5)
    assert {k: sorted(sum(v, [])) for k, v in found.items()} == expected_lists(edges)
    assert len(found["0", "out"]) > 3 and len(found["7", "out"]) > 2
    assert max(len(part) for parts in found.values() for part in parts) <= 40


def test_neighbors(spark):
    edges = make(spark, SMALL)
    assert {tuple(r) for r in graph.neighbors(edges, 2).collect()} == {
        ("out", "3", 1), ("out", "5", 1), ("in", "1", 2), ("in", "3", 1)
    }
    assert graph.neighbors(edges, "nowhere").count() == 0
    numbers = spark.createDataFrame([(1, 2)], "src int, dst int")
    assert graph.neighbors(numbers, "no number").count() == 0


def power_rank(edges, rounds=10, d=0.85):
    ids, a = matrix(edges)
    out = a.sum(axis=1)
    share = np.divide(a, out[:, None], out=np.zeros_like(a), where=out[:, None] > 0)
    v = np.full(len(ids), 1 / len(ids))
    for _ in range(rounds):
        v = (1 - d) / len(ids) + d * (share.T @ v)
    return dict(zip(ids, v))


@pytest.mark.parametrize("edges", [SMALL, random_edges()], ids=["small", "hub"])
@pytest.mark.parametrize("salt_rows", [4, 1_000_000])
def test_pagerank(spark, edges, salt_rows):
    found = {r.id: r.rank for r in graph.pagerank(make(spark, edges), salt_rows=salt_rows).collect()}
    assert found == pytest.approx(power_rank(edges))
    assert sum(found.values()) <= 1 + 1e-9


def test_pagerank_odd_rounds_and_closed_graph(spark):
    ring = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")]
    found = {r.id: r.rank for r in graph.pagerank(make(spark, ring), iters=3).collect()}
    assert found == pytest.approx(power_rank(ring, 3))
    assert sum(found.values()) == pytest.approx(1.0)


def test_pagerank_without_edges(spark):
    assert graph.pagerank(make(spark, [])).count() == 0


@pytest.mark.parametrize("edges", [SMALL, random_edges()], ids=["small", "hub"])
@pytest.mark.parametrize("salt_rows", [4, 1_000_000])
def test_hits(spark, edges, salt_rows):
    ids, a = matrix(edges)
    hub = np.ones(len(ids))
    for _ in range(10):
        auth = a.T @ hub
        auth /= np.linalg.norm(auth)
        hub = a @ auth
        hub /= np.linalg.norm(hub)
    found = {r.id: (r.hub, r.auth) for r in graph.hits(make(spark, edges), salt_rows=salt_rows).collect()}
    assert {k: v[0] for k, v in found.items()} == pytest.approx(dict(zip(ids, hub)))
    assert {k: v[1] for k, v in found.items()} == pytest.approx(dict(zip(ids, auth)))


def test_rounds_move_only_what_changes(spark, monkeypatch):
    # 60 sources that nobody links to, and a ring of three
    edges = [(f"s{i}", "abc"[i % 3]) for i in range(60)] + [("a", "b"), ("b", "c"), ("c", "a")]
    laid, tables, lay, cut = [], [], graph._laid_out, graph.cut_lineage
    monkeypatch.setattr(graph, "_laid_out", lambda df, *rest: (laid.append(df.count()), lay(df, *rest))[1])
    monkeypatch.setattr(graph, "cut_lineage", lambda df: (tables.append(df.columns), cut(df))[1])
    found = {r.id: r.rank for r in graph.pagerank(make(spark, edges)).collect()}
    assert found == pytest.approx(power_rank(edges))
    assert laid == [3, 3]
    assert graph.hits(make(spark, edges)).count() == 63
    # all nodes are written once, after the last round
    assert [c for c in tables if "auth" in c] == [["id", "auth", "hub"]]


def test_only_live_tables_stay(spark):
    from loomwork.shared import hadoop_path, shared_folder

    def tables():
        found, system = hadoop_path(spark, shared_folder(spark))
        return {f.getPath().getName() for f in system.listStatus(found)}

    edges = spark.createDataFrame([(i, (i * 7 + 1) % 20) for i in range(40)], "src int, dst int")
    shared_folder(spark)
    for measure in (graph.pagerank, graph.hits):
        before = tables()
        result = measure(edges, iters=6)
        assert len(tables() - before) == 1
        assert result.count() == graph.nodes(edges).count()
    assert [r.auth for r in result.collect()] == sorted((r.auth for r in result.collect()), reverse=True)


def test_sketches_of_parts_equal_the_sketch_of_all(spark):
    draw = random.Random(12)
    rows = [("hub", f"s{draw.randrange(40_000)}") for _ in range(60_000)]
    rows += [(f"d{draw.randrange(50)}", f"s{draw.randrange(40)}") for _ in range(3000)]
    edges = spark.createDataFrame([(s, d) for d, s in rows], "src string, dst string").repartition(6)
    exact = {r.node: r.in_degree for r in graph.in_degree(edges).collect()}
    parts = edges.randomSplit([0.3, 0.5, 0.2], 1)
    merged = graph.sketched_degrees(graph.merged_sketches(*[graph.degree_sketches(p) for p in parts]))
    found = {r.node: r.degree for r in merged.collect()}
    assert found.keys() == exact.keys()
    for node, n in exact.items():
        # three standard errors of a sketch of this size; small counts are exact
        assert abs(found[node] - n) <= (3 * 0.0104 * n if n > 150 else 0)
    whole = {r.node: r.degree for r in graph.sketched_degrees(graph.degree_sketches(edges)).collect()}
    assert {k: v for k, v in whole.items() if k != "hub"} == {k: v for k, v in found.items() if k != "hub"}
    assert abs(whole["hub"] - found["hub"]) <= 0.02 * found["hub"]
    assert {r.node for r in graph.sketched_degrees(graph.degree_sketches(edges, "src")).collect()} == {s for _, s in rows}
    assert graph.sketched_degrees(graph.degree_sketches(edges.where("false"))).collect() == []
