"""Path a-b-c-d with a doubled and a reciprocal edge, a pair e-f and a lonely node g."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import graph
from ledgerline.session import materialise


@pytest.fixture(scope="module")
def world(spark):
    edges = [("a", "b", "x", 0), ("b", "c", "y", 1), ("a", "b", "z", 2), ("b", "a", "x", 3), ("c", "d", "x", 4), ("e", "f", "q", 5)]
    df = spark.createDataFrame(edges, "source string, target string, action string, pos bigint")
    weighted = materialise(graph.collapse(df), "w")
    nodes = spark.createDataFrame([("g", "lonely"), ("a", "first")], "id string, label string")
    return df, weighted, materialise(graph.node_table(weighted, nodes), "n")


def test_collapse_keeps_last_action_and_first_position(world):
    got = {(r.source, r.target): (r.weight, r.action, r.edge_id) for r in world[1].collect()}
    assert got["a", "b"] == (2, "z", 0) and got["b", "a"] == (1, "x", 3) and len(got) == 5


def test_nodes_and_sizes(world):
    _, weighted, nodes = world
    assert {(r.id, r.label) for r in nodes.collect()} == {("a", "first"), ("g", "lonely")} | {(x, x) for x in "bcdef"}
    assert tuple(graph.size_report(weighted, nodes).first()) == (5, 7)


def test_degrees(world):
    got = {r.id: r for r in graph.degrees(world[1], world[2]).collect()}
    assert (got["a"].indegree, got["a"].outdegree, got["a"].degree) == (1, 1, 2)
    assert (got["b"].weighted_indegree, got["b"].weighted_outdegree, got["b"].weighted_degree) == (2, 2, 4)
    assert got["g"].degree == 0


def test_components(world):
    got = {r.id: r.component for r in graph.components(world[1], world[2]).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e", "f": "e", "g": "g"}


@pytest.mark.parametrize("batch", [100, 2])
def test_path_metrics(world, batch):
    got = {r.id: r for r in graph.path_metrics(world[1], world[2], batch=batch).collect()}
    assert got["a"].closeness == pytest.approx(3 / 6) and got["b"].closeness == pytest.approx(3 / 4)
    assert got["a"].eccentricity == 3 and got["b"].eccentricity == 2
    assert got["a"].harmonic_closeness == pytest.approx((1 + 1 / 2 + 1 / 3) / 3)
    assert [got[x].betweenness for x in "abcd"] == pytest.approx([0, 2, 2, 0])
    for x in "efg":
        assert (got[x].closeness, got[x].betweenness, got[x].in_largest_component) == (0, 0, 0)


def test_distances_alone_hold_no_row_per_pair(spark, world, monkeypatch):
    draw = random.Random(4)
    pairs = {(str(draw.randrange(70)), str(draw.randrange(70))) for _ in range(85)}
    links = spark.createDataFrame([(a, b, 1) for a, b in sorted(pairs) if a != b], "source string, target string, weight bigint")
    # A node given twice.
    nodes = graph.node_table(links, world[2])
    nodes = materialise(nodes.union(nodes.where(F.col("id").isin(sorted(pairs)[0][0], "g"))), "n")
    wanted = {r.id: r for r in graph.path_metrics(links, nodes).drop("betweenness").collect()}
    monkeypatch.setattr(graph, "_levels", None)
    monkeypatch.setattr(graph, "WORDS", 1)
    got = {r.id: r for r in graph.path_metrics(links, nodes, betweenness=False, batch=45).collect()}
    assert got.keys() == wanted.keys() and max(r.eccentricity for r in got.values()) > 4
    for k, r in wanted.items():
        assert (got[k].id, got[k].in_largest_component, got[k].eccentricity) == (r.id, r.in_largest_component, r.eccentricity)
        assert (got[k].closeness, got[k].harmonic_closeness) == pytest.approx((r.closeness, r.harmonic_closeness))


def test_pagerank_and_eigenvector_are_symmetric(spark, world):
    star = spark.createDataFrame([("h", x, 1) for x in "pqrs"], "source string, target string, weight bigint")
    nodes = graph.node_table(star)
    rank = {r.id: r.pagerank for r in graph.pagerank(star, nodes, rounds=60).collect()}
    assert sum(rank.values()) == pytest.approx(1) and rank["p"] == pytest.approx(rank["s"])
    # Fixed point of the star: hub = 0.15/5 + 0.85 * leaves.
    assert rank["h"] == pytest.approx(0.03 + 0.85 * 4 * rank["p"], abs=1e-4)
    value = {r.id: r.eigencentrality for r in graph.eigenvector(star, nodes, 60).collect()}
    assert value["h"] == 1.0 and value["p"] == pytest.approx(0.5, abs=1e-6)


def test_long_chain_and_hub_components(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}", 1) for i in range(60)]
    hub = [("hub", f"x{i}", 1) for i in range(60)]
    draw = random.Random(9)
    rows = chain + hub
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "source string, target string, weight bigint")
    got = {}
    for r in graph.components(df, graph.node_table(df)).collect():
        got.setdefault(r.component, set()).add(r.id)
    assert sorted(map(len, got.values())) == [61, 61]


def test_communities_and_modularity(spark):
    def clique(names):
        return [(a, b, 3) for i, a in enumerate(names) for b in names[i + 1 :]]

    rows = clique("abcd") + clique("wxyz") + [("d", "w", 1)]
    df = spark.createDataFrame(rows, "source string, target string, weight bigint")
    labels = graph.communities(df, graph.node_table(df))
    got = {r.id: r.community for r in labels.collect()}
    assert len({got[x] for x in "abcd"}) == 1 and len({got[x] for x in "wxyz"}) == 1 and got["a"] != got["z"]
    row = graph.modularity(df, labels).first()
    total, inner = 74, 36
    assert row.n_communities == 2 and row.modularity == pytest.approx(2 * (inner / total - (37 / total) ** 2))


def test_subgraph_and_tops(world):
    df = world[0]
    assert graph.subgraph(df, "x|q").count() == 4
    assert [tuple(r) for r in graph.top_values(df, "action", 2).collect()] == [("x", 3), ("q", 1)]
