"""Graph reports on the supplier graph.

Nodes are suppliers. Two neighbouring lines of an order make an edge from the first line's
supplier to the second's; its action names brand, type and priority. Measures run on the whole
graph; a keyword picks the subgraph of ``w4_size`` and of the exact search in ``w4_closeness``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.common import Catalogue, r
from ledgerline.operators import graph, reach
from ledgerline.operators.louvain import louvain
from ledgerline.operators.segments import previous_value
from ledgerline.session import materialise, together
from ledgerline.sources import roles

catalogue = Catalogue()
KEYWORD = "^Brand#12 (PROMO|SMALL) 1-URGENT$"
PAGERANK_ROUNDS, EIGEN_ROUNDS, LABEL_ROUNDS, DEPTH = 20, 100, 10, 24

LINE_ORDER = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]

EDGES_SQL = f"""lines as (select l_orderkey, {', '.join(LINE_ORDER)},
 lag(l_suppkey) over (partition by l_orderkey order by {', '.join(LINE_ORDER)}) as before from lineitem),
 alle as (select cast(before as varchar) as source, cast(l_suppkey as varchar) as target, concat(p_brand, ' ', p_type, ' ', o_orderpriority) as action,
 row_number() over (order by l_orderkey, {', '.join(LINE_ORDER)}) - 1 as pos
 from lines join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey where before is not null and before <> l_suppkey),
 nodes as (select cast(s_suppkey as varchar) as id, s_name as label from supplier),
 wall as (select source, target, count(*) as weight, arg_max(action, pos) as action, min(pos) as edge_id from alle group by 1, 2),
 e as (select * from alle where regexp_matches(action, '{KEYWORD}')),
 w as materialized (select source, target, count(*) as weight, arg_max(action, pos) as action, min(pos) as edge_id from e group by 1, 2)"""


def all_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = roles.table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    # Full copies of a line are told apart so that the order is total.
    linked = previous_value(lines, ["l_orderkey"], LINE_ORDER, "l_suppkey", "before")
    linked = linked.filter(F.col("before").isNotNull() & (F.col("before") != F.col("l_suppkey")))
    parts = roles.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    joined = linked.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(
        F.col("before").cast("string").alias("source"),
        F.col("l_suppkey").cast("string").alias("target"),
        F.concat_ws(" ", "p_brand", "p_type", "o_orderpriority").alias("action"),
        "l_orderkey",
        *LINE_ORDER,
    )


def positioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = materialise(all_edges(spark, sf_dir), "edges")
    return graph.numbered(edges, ["l_orderkey", *LINE_ORDER]).select("source", "target", "action", "pos")


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("label")
    )


def keyword_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Collapsed keyword subgraph and the full node table, both stored."""
    weighted = graph.collapse(graph.subgraph(positioned(spark, sf_dir), KEYWORD))
    weighted = materialise(weighted, "weighted")
    everyone = graph.node_table(weighted, nodes(spark, sf_dir))
    return weighted, materialise(everyone, "nodes")


def whole_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All edges collapsed and the full node table, both stored."""
    weighted = materialise(graph.collapse(positioned(spark, sf_dir)), "weighted")
    return weighted, materialise(graph.node_table(weighted, nodes(spark, sf_dir)), "nodes")


@catalogue.add("w4_collapse", f"with {EDGES_SQL} select * from wall")
def collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted simple digraph of all edges."""
    return graph.collapse(positioned(spark, sf_dir))


@catalogue.add(
    "w4_size",
    f"with {EDGES_SQL} select (select count(*) from w) as n_edges, (select count(*) from nodes) as n_nodes",
)
def size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges and nodes of the keyword subgraph."""
    return graph.size_report(*keyword_graph(spark, sf_dir))


@catalogue.add(
    "w4_top_actions",
    f"with {EDGES_SQL} select action, count(*) as n from wall group by 1 order by n desc, action limit 10",
)
def top_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent actions of the collapsed edges."""
    return graph.top_values(graph.collapse(positioned(spark, sf_dir)), "action", 10)


@catalogue.add(
    "w4_heaviest",
    f"with {EDGES_SQL} select source, target, weight from wall order by weight desc, source, target limit 10",
)
def heaviest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heaviest edges."""
    collapsed = graph.collapse(positioned(spark, sf_dir))
    return graph.top_rows(collapsed, "weight", ["source", "target"], 10).select("source", "target", "weight")


DEGREES_SQL = """, ends as (select source as id, 0 as i, 1 as o, weight as wt from {w} union all select target, 1, 0, weight from {w}),
 dg as (select n.id, coalesce(sum(i), 0)::bigint as indegree, coalesce(sum(o), 0)::bigint as outdegree,
 coalesce(sum(i * wt), 0)::bigint as weighted_indegree, coalesce(sum(o * wt), 0)::bigint as weighted_outdegree,
 coalesce(sum(i + o), 0)::bigint as degree, coalesce(sum(wt), 0)::bigint as weighted_degree from nodes n left join ends using (id) group by 1)"""


@catalogue.add("w4_degrees", f"with {EDGES_SQL}{DEGREES_SQL.format(w='wall')} select * from dg")
def degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees of all nodes in the whole graph."""
    return graph.degrees(materialise(graph.collapse(positioned(spark, sf_dir)), "weighted"), nodes(spark, sf_dir))


@catalogue.add(
    "w4_top_degree",
    f"with {EDGES_SQL}{DEGREES_SQL.format(w='wall')} select label, degree, indegree, outdegree from dg join nodes using (id) order by degree desc, id limit 10",
)
def top_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with most neighbours."""
    weighted, everyone = whole_graph(spark, sf_dir)
    ranked = graph.degrees(weighted, everyone).join(everyone, "id")
    return graph.top_rows(ranked, "degree", ["id"], 10).select("label", "degree", "indegree", "outdegree")


def _adjacent_sql(w: str) -> str:
    return f"""with recursive {EDGES_SQL},
 u as materialized (select src, dst, sum(weight)::bigint as weight from (select source as src, target as dst, weight from {w}
 union all select target, source, weight from {w}) where src <> dst group by 1, 2),
 reach as (select id, id as seen from nodes union select reach.id, u.dst from reach join u on u.src = reach.seen),
 comp as materialized (select id, min(seen) as component from reach group by 1),
 big as materialized (select id from comp where component = (select component from comp group by 1 order by count(*) desc, component limit 1)),
 a as materialized (select u.* from u join big on u.src = big.id)"""


ADJACENT_SQL, SUBGRAPH_SQL = _adjacent_sql("wall"), _adjacent_sql("w")


@catalogue.add("w4_components", ADJACENT_SQL + " select id, component from comp")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weakly connected component of every node."""
    return graph.components(*whole_graph(spark, sf_dir))


def _level_sql(depth: int) -> str:
    """Breadth-first levels with path counts, unrolled."""
    parts = [", l0 as materialized (select id as s, id as v, 1.0e0 as k from big)"]
    for d in range(1, depth + 1):
        seen = f"l{d - 1}" if d == 1 else f"(select * from l{d - 1} union all select * from l{d - 2})"
        parts.append(
            f", l{d} as materialized (select x.s, a.dst as v, sum(x.k) as k from l{d - 1} x join a on a.src = x.v"
            f" where not exists (select 1 from {seen} y where y.s = x.s and y.v = a.dst) group by 1, 2)"
        )
    rows = " union all ".join(f"select s, v, k, {d} as d from l{d}" for d in range(depth + 1))
    return "".join(parts) + f", dist as materialized ({rows})"


CLOSE_SQL = """, cl as (select s as id, 1 as in_largest_component, (count(*) - 1) / sum(d) as closeness,
 sum(case when d > 0 then 1.0e0 / d end) / (count(*) - 1) as harmonic, max(d) as eccentricity from dist group by 1)"""


CLOSE_SELECT = f""" select nodes.id, coalesce(in_largest_component, 0) as in_largest_component, {r('coalesce(closeness, 0)')} as closeness,
 {r('coalesce(harmonic, 0)')} as harmonic_closeness, coalesce(eccentricity, 0) as eccentricity from nodes left join cl using (id)"""


@catalogue.add("w4_closeness", SUBGRAPH_SQL + _level_sql(DEPTH) + CLOSE_SQL + CLOSE_SELECT)
def closeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closeness, harmonic closeness and eccentricity of the keyword subgraph, by exact search."""
    return graph.path_metrics(*keyword_graph(spark, sf_dir), betweenness=False)


@catalogue.add("w4_closeness_all", ADJACENT_SQL + _level_sql(DEPTH) + CLOSE_SQL + CLOSE_SELECT)
def closeness_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closeness, harmonic closeness and eccentricity of the whole graph, exact."""
    return reach.sketched_distances(*whole_graph(spark, sf_dir))


BETWEEN_SQL = """, bt as (select x.v as id, sum(x.k * y.k / z.k) / 2 as betweenness from dist x join dist y on x.v = y.s join dist z on z.s = x.s and z.v = y.v
 where x.d + y.d = z.d and x.d > 0 and y.d > 0 group by 1)"""


@catalogue.add(
    "w4_betweenness",
    ADJACENT_SQL
    + _level_sql(DEPTH)
    + BETWEEN_SQL
    + f" select nodes.id, {r('coalesce(betweenness, 0)')} as betweenness from nodes left join bt using (id)",
)
def betweenness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Betweenness, each pair counted once, from all sources."""
    return reach.sampled_betweenness(*whole_graph(spark, sf_dir)).select("id", "betweenness")


def _pagerank_sql(rounds: int) -> str:
    parts = [
        ", st as materialized (select src, dst, weight / sum(weight) over (partition by src) as share from a)",
        ", r0 as (select id, 1.0e0 / (select count(*) from big) as rank from big)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f", r{i} as materialized (select dst as id, 0.85e0 * sum(rank * share) + 0.15e0 / (select count(*) from big) as rank"
            f" from st join r{i - 1} p on p.id = st.src group by 1)"
        )
    return "".join(parts)


@catalogue.add(
    "w4_pagerank",
    ADJACENT_SQL
    + _pagerank_sql(PAGERANK_ROUNDS)
    + f" select nodes.id, {r(f'coalesce(rank, 0)')} as pagerank from nodes left join r{PAGERANK_ROUNDS} using (id)",
)
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PageRank after a fixed number of rounds."""
    return graph.pagerank(*whole_graph(spark, sf_dir), rounds=PAGERANK_ROUNDS)


def _eigen_sql(rounds: int) -> str:
    parts = [
        ", st as materialized (select src, dst from a union all select id, id from big)",
        ", v0 as (select id, 1.0e0 as value from big)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f", v{i} as materialized (select dst as id, sum(value) as value from st join v{i - 1} p on p.id = st.src group by 1)"
        )
    return "".join(parts)


EIGEN = f"select id, value / (select max(value) from v{EIGEN_ROUNDS}) as value from v{EIGEN_ROUNDS}"


@catalogue.add(
    "w4_eigen",
    ADJACENT_SQL
    + _eigen_sql(EIGEN_ROUNDS)
    + f" select nodes.id, {r('coalesce(value, 0)')} as eigencentrality from nodes left join ({EIGEN}) x using (id)",
)
def eigen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eigenvector centrality after a fixed number of rounds."""
    return graph.eigenvector(*whole_graph(spark, sf_dir), rounds=EIGEN_ROUNDS)


def _label_sql(rounds: int) -> str:
    parts = [
        ", vt as materialized (select src, dst, weight from u union all select src, src, max(weight) from u group by 1)",
        ", c0 as (select id, id as community from nodes)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f", b{i} as materialized (select src, community, sum(weight) as s from vt join c{i - 1} on id = dst group by 1, 2)"
            f", c{i} as materialized (select c.id, coalesce(t.community, c.community) as community from c{i - 1} c left join"
            f" (select src, community from (select *, row_number() over (partition by src order by s desc, community) as k from b{i}) where k = 1) t on t.src = c.id)"
        )
    return "".join(parts)


@catalogue.add(
    "w4_communities",
    ADJACENT_SQL + _label_sql(LABEL_ROUNDS) + f" select id, community from c{LABEL_ROUNDS}",
)
def communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community label of every node."""
    return graph.communities(*whole_graph(spark, sf_dir), rounds=LABEL_ROUNDS)


@catalogue.add("w4_louvain")
def louvain_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communities by modularity, with their size and share of the modularity."""
    return with_communities(*whole_graph(spark, sf_dir))


def with_communities(weighted: DataFrame, everyone: DataFrame) -> DataFrame:
    """(id, community, size, modularity_share) of every node; an id given twice is one node of its community."""
    parts = materialise(louvain(weighted, everyone), "communities")
    distinct = parts.distinct()
    sizes = distinct.groupBy("community").agg(F.count(F.lit(1)).alias("size"))
    shares = graph.modularity_shares(weighted, distinct).withColumnRenamed("share", "modularity_share")
    told = materialise(sizes.join(shares, "community", "left").fillna(0.0, ["modularity_share"]), "community-table")
    told = told.withColumnRenamed("community", "of")
    return parts.join(told, F.col("community").eqNullSafe(F.col("of")), "left").drop("of")


@catalogue.add(
    "w4_community_sizes",
    ADJACENT_SQL
    + _label_sql(LABEL_ROUNDS)
    + f" select community, count(*) as n from c{LABEL_ROUNDS} group by 1 order by n desc, community limit 10",
)
def community_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest communities."""
    return graph.top_values(graph.communities(*whole_graph(spark, sf_dir), rounds=LABEL_ROUNDS), "community", 10)


@catalogue.add(
    "w4_modularity",
    ADJACENT_SQL
    + _label_sql(LABEL_ROUNDS)
    + f""", p as (select x.community, sum(weight) as degree, coalesce(sum(weight) filter (where x.community = y.community), 0) as inner_w
 from u join c{LABEL_ROUNDS} x on x.id = src join c{LABEL_ROUNDS} y on y.id = dst group by 1), t as (select sum(weight) as m from u)
 select {r('sum(inner_w / m - (degree / m) * (degree / m))')} as modularity, count(*) as n_communities from p, t""",
)
def modularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of the communities."""
    weighted, everyone = whole_graph(spark, sf_dir)
    return graph.modularity(weighted, graph.communities(weighted, everyone, LABEL_ROUNDS))


@catalogue.add(
    "w4_top_central",
    ADJACENT_SQL
    + DEGREES_SQL.format(w="wall")
    + _level_sql(DEPTH)
    + CLOSE_SQL
    + BETWEEN_SQL
    + _eigen_sql(EIGEN_ROUNDS)
    + _label_sql(LABEL_ROUNDS)
    + f""" select label as "Node", degree as "Degree", {r('coalesce(betweenness, 0)')} as "Betweenness", {r('coalesce(closeness, 0)')} as "Closeness",
 {r('coalesce(value, 0)')} as "Eigenvector", coalesce(eccentricity, 0) as "Eccentricity", community as "Community"
 from nodes join dg using (id) left join cl using (id) left join bt using (id) left join ({EIGEN}) x using (id) join c{LABEL_ROUNDS} using (id)
 order by degree desc, id limit 20""",
)
def top_central(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined centralities of the best-connected nodes."""
    weighted, everyone = whole_graph(spark, sf_dir)
    largest = reach.Largest(weighted, everyone)

    def paths() -> tuple[DataFrame, DataFrame]:
        far = reach.sketched_distances(weighted, everyone, largest=largest)
        return far, reach.sampled_betweenness(weighted, everyone, largest=largest).select("id", "betweenness")

    measures = together(
        paths,
        lambda: graph.eigenvector(weighted, everyone, EIGEN_ROUNDS, inside=largest.inside),
        lambda: graph.communities(weighted, everyone, LABEL_ROUNDS),
    )
    table = graph.degrees(weighted, everyone)
    for part in (everyone, *measures[0], *measures[1:]):
        table = table.join(part, "id")
    return graph.top_rows(table, "degree", ["id"], 20).select(
        F.col("label").alias("Node"),
        F.col("degree").alias("Degree"),
        F.col("betweenness").alias("Betweenness"),
        F.col("closeness").alias("Closeness"),
        F.col("eigencentrality").alias("Eigenvector"),
        F.col("eccentricity").alias("Eccentricity"),
        F.col("community").alias("Community"),
    )
