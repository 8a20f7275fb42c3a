"""Graph jobs on edge tables: collapse, degrees, components, centralities, communities.

Every step is a join or an aggregation over (source, target) rows. Loops write their
state to the shared folder each round, which keeps plans short and lets a lost executor
reread it. Searches from all nodes run in batches of sources, so the largest table held
is one batch times the nodes it reaches, and only per-node sums leave a batch.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.segments import row_numbers
from ledgerline.session import materialise, materialise_by

SOURCES_PER_BATCH = 20_000
#: Sources whose reach is followed side by side where only distances are wanted: one bit each, 64 to a word.
BIT_SOURCES, WORDS = 65_536, 16
ROUNDS_PER_WRITE = 10
#: Most links in a row of the spectral rounds.
TO_EACH = 4096


# -- edge and node tables -------------------------------------------------------------------


def subgraph(edges: DataFrame, pattern: str) -> DataFrame:
    """Edges whose action matches a keyword pattern."""
    return edges.filter(F.col("action").rlike(pattern))


def numbered(edges: DataFrame, order: list[str]) -> DataFrame:
    """Edges with their 0-based position ``pos`` in the given order."""
    return row_numbers(edges, [], order, "pos").withColumn("pos", F.col("pos") - 1)


def collapse(edges: DataFrame) -> DataFrame:
    """Parallel edges as one: their number, the last action, the first position as id."""
    return edges.groupBy("source", "target").agg(
        F.count(F.lit(1)).alias("weight"),
        F.max_by("action", "pos").alias("action"),
        F.min("pos").alias("edge_id"),
    )


def node_table(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """All endpoints, and the given nodes even when they have no edge."""
    ends = edges.select(F.col("source").alias("id")).union(edges.select("target")).distinct()
    if nodes is None:
        return ends.withColumn("label", F.col("id"))
    return ends.join(nodes.select("id", "label"), "id", "full_outer").withColumn("label", F.coalesce("label", "id"))


def size_report(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return edges.agg(F.count(F.lit(1)).alias("n_edges")).select(
        "n_edges", nodes.agg(F.count(F.lit(1))).scalar().alias("n_nodes")
    )


def undirected(weighted: DataFrame) -> DataFrame:
    """Both directions of every edge, weights of reciprocal edges added; no self-loops."""
    w = F.col("weight")
    forward = weighted.select(F.col("source").alias("src"), F.col("target").alias("dst"), w)
    back = weighted.select(F.col("target").alias("src"), F.col("source").alias("dst"), w)
    both = forward.unionByName(back).filter(F.col("src") != F.col("dst"))
    return both.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def degrees(weighted: DataFrame, nodes: DataFrame) -> DataFrame:
    """In, out and total degree, plain and weighted; 0 for nodes without edges."""
    ends = weighted.select(
        F.inline(
            F.array(
                F.struct(F.col("source").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o"), F.col("weight").alias("w")),
                F.struct(F.col("target").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o"), F.col("weight").alias("w")),
            )
        )
    )
    sums = ends.groupBy("id").agg(
        F.sum("i").alias("indegree"),
        F.sum("o").alias("outdegree"),
        F.sum(F.col("i") * F.col("w")).alias("weighted_indegree"),
        F.sum(F.col("o") * F.col("w")).alias("weighted_outdegree"),
    )
    full = nodes.select("id").join(sums, "id", "left").fillna(0)
    return full.withColumns(
        {
            "degree": F.col("indegree") + F.col("outdegree"),
            "weighted_degree": F.col("weighted_indegree") + F.col("weighted_outdegree"),
        }
    )


# -- components -----------------------------------------------------------------------------


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest of the node and its neighbours."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    moved = both.filter(F.col("v") > F.col("u")).join(low, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(F.col("u") != F.col("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _print(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(weighted: DataFrame, nodes: DataFrame) -> DataFrame:
    """Weakly connected component of every node, named by its smallest id.

    Alternating large-star and small-star rounds: about log(size) of them even for long
    chains, until a round changes nothing. No hub is collected.
    """
    e = weighted.select(F.col("source").alias("u"), F.col("target").alias("v")).filter(F.col("u") != F.col("v"))
    e = materialise(e.distinct(), "component_edges")
    seen = _print(e)
    while True:
        e = materialise(_small_star(_large_star(e)), "stars")
        now = _print(e)
        if now == seen:
            break
        seen = now
    root = e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return nodes.select("id").join(root, "id", "left").withColumn("component", F.coalesce("component", "id"))


def largest_component(parts: DataFrame) -> DataFrame:
    """Ids of the largest component; the smallest name wins a tie."""
    sizes = parts.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    best = sizes.agg(F.min(F.struct((-F.col("n")).alias("n"), "component")).alias("b")).select("b.component").scalar()
    return parts.filter(F.col("component") == best).select("id")


# -- distances ------------------------------------------------------------------------------


def _levels(adjacency: DataFrame, sources: DataFrame) -> list[DataFrame]:
    """Breadth-first levels from many sources: (source, node, paths) per distance.

    A new level can only repeat nodes of the level before it, or of its own.
    """
    start = sources.select(
        F.col("id").alias("source"), F.col("id").alias("node"), F.lit(1.0).alias("paths")
    )
    levels = [materialise(start, "level")]
    while True:
        last = levels[-1]
        reached = (
            last.join(adjacency, last["node"] == adjacency["src"])
            .groupBy("source", F.col("dst").alias("node"))
            .agg(F.sum("paths").alias("paths"))
        )
        for known in levels[-2:]:
            reached = reached.join(known.select("source", "node"), ["source", "node"], "left_anti")
        step = materialise(reached, "level")
        if step.isEmpty():
            return levels
        levels.append(step)


def _distance_sums(levels: list[DataFrame]) -> DataFrame:
    long = levels[0].select("source", F.lit(0).alias("d"))
    for d, level in enumerate(levels[1:], 1):
        long = long.unionByName(level.select("source", F.lit(d).alias("d")))
    d = F.col("d")
    return long.groupBy(F.col("source").alias("id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(d).alias("total"),
        F.coalesce(F.sum(F.when(d > 0, 1.0 / d)), F.lit(0.0)).alias("inverse"),
        F.max(d).alias("eccentricity"),
    )


def _bit_levels(adjacency: DataFrame, sources: DataFrame) -> list[DataFrame]:
    """Breadth-first levels from many sources: (node, block, w0..) per distance.

    ``sources`` has ``id`` and its 0-based number ``pos``. A row holds which of the 64 * WORDS sources of
    its block are that far from the node, a bit each. A new level can only repeat nodes of the level
    before it, or of its own.
    """
    words = [f"w{k}" for k in range(WORDS)]
    at = F.expr("cast(pos % 64 as int)")
    start = sources.select(
        F.col("id").alias("node"),
        F.expr(f"cast(pos div {64 * WORDS} as int)").alias("block"),
        *[F.when(F.expr(f"pos div 64 % {WORDS}") == k, F.call_function("shiftleft", F.lit(1).cast("long"), at)).otherwise(F.lit(0).cast("long")).alias(w) for k, w in enumerate(words)],
    )
    levels = [materialise(start, "level")]
    nothing = F.lit(0).cast("long")
    while True:
        sent = adjacency.join(levels[-1], F.col("src") == F.col("node")).select(
            F.col("dst").alias("node"), "block", *words, *[nothing.alias(f"k{w}") for w in words]
        )
        for known in levels[-2:]:
            sent = sent.unionByName(known.select("node", "block", *[nothing.alias(w) for w in words], *[F.col(w).alias(f"k{w}") for w in words]))
        met = sent.groupBy("node", "block").agg(*[F.bit_or(c).alias(c) for w in words for c in (w, f"k{w}")])
        fresh = met.select("node", "block", *[F.col(w).bitwiseAND(F.bitwise_not(f"k{w}")).alias(w) for w in words])
        step = materialise(fresh.filter(" or ".join(f"{w} <> 0" for w in words)), "level")
        if step.isEmpty():
            return levels
        levels.append(step)


def _bit_distance_sums(levels: list[DataFrame]) -> DataFrame:
    """As ``_distance_sums`` for the sources at each distance from a node, which links in both directions make the same."""
    n = sum(F.bit_count(f"w{k}") for k in range(WORDS))
    long = None
    for d, level in enumerate(levels):
        rows = level.select(F.col("node").alias("id"), F.lit(d).alias("d"), n.cast("long").alias("n"))
        long = rows if long is None else long.unionByName(rows)
    per = long.groupBy("id", "d").agg(F.sum("n").alias("n"))
    d = F.col("d")
    return per.groupBy("id").agg(
        F.sum("n").alias("n"),
        F.sum(d * F.col("n")).alias("total"),
        F.coalesce(F.sum(F.when(d > 0, F.col("n") / d)), F.lit(0.0)).alias("inverse"),
        F.max(d).alias("eccentricity"),
    )


def _exact_distances(adjacency: DataFrame, inside: DataFrame, batch: int) -> DataFrame:
    """``_bit_distance_sums`` over all sources, ``batch`` of them at a time. An id given twice counts itself twice."""
    copies = inside.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    dealt = materialise(row_numbers(copies, [], ["id"], "pos").withColumn("pos", F.col("pos") - 1), "sources")
    sums = None
    for first in range(0, dealt.count(), batch):
        sources = dealt.filter((F.col("pos") >= first) & (F.col("pos") < first + batch)).withColumn("pos", F.col("pos") - first)
        part = materialise(_bit_distance_sums(_bit_levels(adjacency, sources)), "sums")
        sums = part if sums is None else sums.unionByName(part)
    whole = sums.groupBy("id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("inverse").alias("inverse"), F.max("eccentricity").alias("eccentricity"))
    return whole.join(dealt.select("id", "copies"), "id").withColumn("n", F.col("n") + F.col("copies") - 1).drop("copies")


def _dependencies(adjacency: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Share of shortest paths through each node, summed over a batch of sources.

    Walks the levels backwards: a node passes (1 + its own share), split by path counts,
    to its predecessors.
    """
    share = levels[-1].withColumn("share", F.lit(0.0))
    total = None
    for before in reversed(levels[1:-1]):
        back = (
            share.join(adjacency, share["node"] == adjacency["src"])
            .select("source", F.col("dst").alias("node"), ((1.0 + F.col("share")) / F.col("paths")).alias("part"))
            .groupBy("source", "node")
            .agg(F.sum("part").alias("part"))
        )
        share = materialise(
            before.join(back, ["source", "node"], "left").select(
                "source", "node", "paths", F.coalesce(F.col("paths") * F.col("part"), F.lit(0.0)).alias("share")
            ),
            "share",
        )
        part = share.groupBy(F.col("node").alias("id")).agg(F.sum("share").alias("share"))
        total = part if total is None else total.unionByName(part)
    if total is None:
        return levels[0].select(F.col("node").alias("id"), F.lit(0.0).alias("share"))
    return total


def path_metrics(
    weighted: DataFrame, nodes: DataFrame, betweenness: bool = True, batch: int | None = None
) -> DataFrame:
    """Closeness, harmonic closeness, eccentricity and betweenness, undirected and unweighted.

    Path counts need a row per source and node reached; distances alone need a bit.

    They are defined inside the largest component; other nodes get 0.
    """
    inside = materialise(largest_component(components(weighted, nodes)), "largest")
    links = undirected(weighted).select("src", "dst")
    links = links.join(inside.withColumnRenamed("id", "src"), "src", "left_semi")
    adjacency = materialise(links, "adjacency")
    sums, shares = None, None
    if betweenness:
        n_batches = max(1, math.ceil(inside.count() / (batch or SOURCES_PER_BATCH)))
        dealt = inside.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(n_batches)))
        for b in range(n_batches):
            levels = _levels(adjacency, dealt.filter(F.col("_b") == b).select("id"))
            part = materialise(_distance_sums(levels), "sums")
            sums = part if sums is None else sums.unionByName(part)
            through = materialise(_dependencies(adjacency, levels), "through")
            shares = through if shares is None else shares.unionByName(through)
    elif not inside.isEmpty():
        sums = _exact_distances(adjacency, inside, batch or BIT_SOURCES)
    if sums is None:
        sums = _distance_sums([inside.select(F.col("id").alias("source"))])
    others = F.col("n") - 1
    measured = sums.select(
        "id",
        F.lit(1).alias("in_largest_component"),
        F.when(F.col("total") > 0, others / F.col("total")).otherwise(0.0).alias("closeness"),
        F.when(others > 0, F.col("inverse") / others).otherwise(0.0).alias("harmonic_closeness"),
        F.col("eccentricity"),
    )
    if betweenness:
        through = shares.groupBy("id").agg((F.sum("share") / 2.0).alias("betweenness"))
        measured = measured.join(through, "id", "left")
    return nodes.select("id").join(measured, "id", "left").fillna(0)


# -- spectral measures ------------------------------------------------------------------------


def _counted(ids: DataFrame) -> DataFrame:
    """(id, pos) of the different ids in their order: rounds join and group whole numbers, and the smaller id stays the smaller."""
    known = ids.select("id").filter(F.col("id").isNotNull()).distinct()
    return materialise(row_numbers(known, [], ["id"], "pos"), "numbers")


def _between(links: DataFrame, numbers: DataFrame) -> DataFrame:
    """Links (src, dst, weight) with the numbers of their ends."""
    ends = (numbers.select(F.col("id").alias(c), F.col("pos").alias(f"_{c}")) for c in ("src", "dst"))
    for end, c in zip(ends, ("src", "dst"), strict=True):
        links = links.join(end, c).drop(c).withColumnRenamed(f"_{c}", c)
    return links.select("src", "dst", "weight")


def _component_links(weighted: DataFrame, nodes: DataFrame, inside: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The largest component's nodes (pos), its links between numbers, and the numbers (id, pos); ``inside`` are its ids where known."""
    inside = inside or materialise(largest_component(components(weighted, nodes)), "largest")
    numbers = _counted(inside)
    links = undirected(weighted).join(inside.withColumnRenamed("id", "src"), "src", "left_semi")
    return materialise(inside.join(numbers, "id").select("pos"), "inside"), materialise(_between(links, numbers), "links"), numbers


def _bundled(links: DataFrame, *what: str) -> DataFrame:
    """One row for a node's links to TO_EACH numbers that follow each other: a round joins few rows."""
    bundles = links.groupBy("src", F.expr(f"dst div {TO_EACH}").alias("part")).agg(F.collect_list(F.struct(*what)).alias("ends"))
    return materialise_by(bundles.select("src", "ends"), "src", "steps")


def _sent(steps: DataFrame, state: DataFrame, *what: str) -> DataFrame:
    """The ends of all bundles with the columns ``what`` of the node they leave."""
    return steps.join(state, steps["src"] == state["pos"]).select(*what, F.inline("ends"))


def pagerank(
    weighted: DataFrame, nodes: DataFrame, damping: float = 0.85, rounds: int = 20
) -> DataFrame:
    """PageRank on the undirected weighted largest component; other nodes get 0.

    Every node there has an edge, so no mass dangles.
    """
    inside, links, numbers = _component_links(weighted, nodes)
    n = inside.count()
    out = links.groupBy("src").agg(F.sum("weight").alias("out"))
    # The links stay where they are; a round moves only ranks and what they pass on.
    steps = _bundled(links.join(out, "src").select("src", "dst", (F.col("weight") / F.col("out")).alias("share")), "dst", "share")
    rank = inside.withColumn("rank", F.lit(1.0 / max(n, 1)))
    for i in range(1, rounds + 1):
        moved = (
            _sent(steps, rank, "rank")
            .groupBy(F.col("dst").alias("pos"))
            .agg((F.sum(F.col("rank") * F.col("share")) * damping + (1.0 - damping) / max(n, 1)).alias("rank"))
        )
        rank = materialise(moved, "rank") if i % ROUNDS_PER_WRITE == 0 or i == rounds else moved
    named = rank.join(numbers, "pos").select("id", F.col("rank").alias("pagerank"))
    return nodes.select("id").join(named, "id", "left").fillna(0.0)


def eigenvector(weighted: DataFrame, nodes: DataFrame, rounds: int = 100, inside: DataFrame | None = None) -> DataFrame:
    """Eigenvector centrality of the undirected largest component, largest value 1.

    A node keeps its own value in each step, which keeps bipartite graphs from
    alternating without changing the eigenvectors.
    """
    inside, links, numbers = _component_links(weighted, nodes, inside)
    steps = links.select("src", "dst").unionByName(inside.select(F.col("pos").alias("src"), F.col("pos").alias("dst")))
    steps = _bundled(steps, "dst")
    value = inside.withColumn("value", F.lit(1.0))
    for i in range(1, rounds + 1):
        value = _sent(steps, value, "value").groupBy(F.col("dst").alias("pos")).agg(
            F.sum("value").alias("value")
        )
        if i % ROUNDS_PER_WRITE == 0 or i == rounds:
            value = materialise(value, "value")
            top = value.agg(F.max("value")).scalar()
            value = value.select("pos", (F.col("value") / top).alias("value"))
    named = value.join(numbers, "pos").select("id", F.col("value").alias("eigencentrality"))
    return nodes.select("id").join(named, "id", "left").fillna(0.0)


# -- communities --------------------------------------------------------------------------------


def communities(weighted: DataFrame, nodes: DataFrame, rounds: int = 10) -> DataFrame:
    """Label propagation: the heaviest label among the neighbours and the node's own.

    A node's own label counts with its heaviest single edge; a tie goes to the smallest
    label, so the result is repeatable.
    """
    links = materialise(undirected(weighted), "links")
    own = links.groupBy("src").agg(F.max("weight").alias("weight")).select(
        "src", F.col("src").alias("dst"), "weight"
    )
    votes_over = materialise(links.unionByName(own), "votes_over")
    labels = materialise(nodes.select("id", F.col("id").alias("community")), "labels")
    for _ in range(rounds):
        votes = (
            votes_over.join(labels, votes_over["dst"] == labels["id"])
            .groupBy("src", "community")
            .agg(F.sum("weight").alias("w"))
        )
        best = votes.groupBy(F.col("src").alias("id")).agg(
            F.min(F.struct((-F.col("w")).alias("w"), "community")).alias("b")
        )
        updated = materialise(
            labels.join(best, "id", "left").select(
                "id",
                F.coalesce("b.community", "community").alias("community"),
                (F.col("b.community") != F.col("community")).alias("moved"),
            ),
            "labels",
        )
        labels = updated.select("id", "community")
        if updated.filter("moved").isEmpty():
            break
    return labels


def modularity_shares(weighted: DataFrame, parts: DataFrame) -> DataFrame:
    """(community, share) of every community with links: inner weight share minus squared degree share, which add up to Q."""
    links = undirected(weighted)
    side = parts.select(F.col("id").alias("src"), F.col("community").alias("c_src"))
    other = parts.select(F.col("id").alias("dst"), F.col("community").alias("c_dst"))
    joined = links.join(side, "src").join(other, "dst")
    per = joined.groupBy(F.col("c_src").alias("community")).agg(
        F.sum("weight").alias("degree"),
        F.coalesce(F.sum(F.when(F.col("c_src") == F.col("c_dst"), F.col("weight"))), F.lit(0)).alias("inner"),
    )
    total = links.agg(F.sum("weight")).scalar()
    share = F.col("degree") / total
    return per.select("community", (F.col("inner") / total - share * share).alias("share"))


def modularity(weighted: DataFrame, parts: DataFrame) -> DataFrame:
    """Q of a partition: per community, inner weight share minus squared degree share."""
    return modularity_shares(weighted, parts).agg(F.sum("share").alias("modularity"), F.count(F.lit(1)).alias("n_communities"))


# -- reports --------------------------------------------------------------------------------------


def top_rows(df: DataFrame, by: str | Column, ties: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by a measure, ties by the given columns."""
    return df.orderBy(F.desc(by) if isinstance(by, str) else by.desc(), *ties).limit(n)


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return top_rows(counts, "n", [column], n)
