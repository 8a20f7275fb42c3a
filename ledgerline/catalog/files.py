"""Round trips through files: given tables are written in an input's format and read back by its reader."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog import graph as graph_catalogue
from ledgerline.catalog import revenue_diagnostics, revenue_features
from ledgerline.catalog.common import Catalogue, r
from ledgerline.operators.graph import degrees
from ledgerline.session import shared_folder
from ledgerline.sources import files, roles
from ledgerline.sources.splitting import read_json_array, read_numbered_lines

catalogue = Catalogue()
LOG_RUNS = 16


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_KEPT = "cust_id sale_id prod_id order_date sale_revenue sale_discount_applied returned_to_shop_id prod_size prod_brand prod_season prod_web_only".split()


@catalogue.add(
    "f_csv_tables",
    f"with {roles.TRANSACTION_ORACLE}, {roles.CUSTOMER_ORACLE} select {', '.join(_KEPT)}, (select count(*) from train) as n_train,"
    f" (select {r('sum(revenue_2018_2019)', 2)} from train) as train_revenue, (select count(*) from test) as n_test from tx",
)
def csv_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables of the customer workload through CSV files."""
    tables = {"train": roles.train(spark, sf_dir), "test": roles.test(spark, sf_dir), "transactions": roles.transactions(spark, sf_dir)}
    paths = {name: files.write_csv(df, _path(spark, f"csv-{name}")) for name, df in tables.items()}
    train, test, tx = files.read_datasets(spark, **paths)
    return tx.select(
        *_KEPT,
        train.agg(F.count(F.lit(1))).scalar().alias("n_train"),
        train.agg(F.round(F.sum("revenue_2018_2019"), 2)).scalar().alias("train_revenue"),
        test.agg(F.count(F.lit(1))).scalar().alias("n_test"),
    )


@catalogue.add("f_matrix_parquet", revenue_features.MATRIX_SQL)
def matrix_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned feature matrix through Parquet files."""
    features = revenue_features.customer_features(spark, sf_dir, store=True)
    return spark.read.parquet(files.write_parquet(features.matrix(), _path(spark, "matrix")))


@catalogue.add("f_submission_csv", revenue_diagnostics.catalogue.oracles["w1_submission"])
def submission_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The submission through CSV files."""
    path = files.write_csv(files.submission(revenue_diagnostics.scored(spark, sf_dir), "y_pred"), _path(spark, "submission"))
    return files.read_csv(spark, path, "cust_id BIGINT, prediction DOUBLE")


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """JSON rows of a task as the lines of one array."""
    first = True
    for batch in batches:
        rows = [("[" if first and i == 0 else ",") + row for i, row in enumerate(batch.column("value").to_pylist())]
        if rows:
            first = False
            yield pa.RecordBatch.from_arrays([pa.array(rows)], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], names=["value"])


@catalogue.add("f_json_array", "select doc_id as id, text, source as category, list_value(lang, source) as themes from documents")
def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with free text through files that hold one JSON array each."""
    docs = roles.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", F.col("source").alias("category"), F.array("lang", "source").alias("themes"))
    path = _path(spark, "arrays")
    docs.select(F.to_json(F.struct("id", "text", "category", "themes", F.struct(F.col("text").alias("again")).alias("nested"))).alias("value")).mapInArrow(_arrays, "value string").write.text(path)
    return read_json_array(spark, path, "id bigint, text string, category string, themes array<string>")


@catalogue.add("f_rebuild", "select part_no, count(*) as n from (select p_partkey % 7 as part_no from part) group by 1")
def rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store that is dropped and built anew holds the new rows only."""
    path = _path(spark, "store")
    files.rebuild(roles.table(spark, sf_dir, "supplier").select("s_suppkey"), path)
    stored = files.rebuild(roles.table(spark, sf_dir, "part").select((F.col("p_partkey") % 7).alias("part_no")), path)
    return stored.groupBy("part_no").agg(F.count(F.lit(1)).alias("n"))


@catalogue.add("f_edge_csv", f"with {graph_catalogue.EDGES_SQL} select source, target, action, pos from alle")
def edge_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges through CSV files, numbered in the order of the files."""
    path = files.write_csv(graph_catalogue.positioned(spark, sf_dir).orderBy("pos").select("source", "target", "action"), _path(spark, "edges"))
    return files.read_edges(spark, path)


@catalogue.add(
    "f_node_metrics_csv",
    f"with {graph_catalogue.EDGES_SQL}{graph_catalogue.DEGREES_SQL.format(w='wall')} select id as \"Id\", label as \"Label\", indegree::int as indegree, outdegree::int as outdegree,"
    ' degree::int as "Degree", weighted_indegree::double as "weighted indegree" from dg join nodes using (id)',
)
def node_metrics_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and an exported metric table, with a blank in a column name, through CSV files."""
    nodes = files.read_nodes(spark, files.write_csv(graph_catalogue.nodes(spark, sf_dir), _path(spark, "nodes")))
    weighted, _ = graph_catalogue.whole_graph(spark, sf_dir)
    metrics = degrees(weighted, nodes).join(nodes, "id").select(
        F.col("id").alias("Id"), F.col("label").alias("Label"), "indegree", "outdegree", F.col("degree").alias("Degree"), F.col("weighted_indegree").alias("weighted indegree")
    )
    return files.read_node_metrics(spark, files.write_csv(metrics, _path(spark, "metrics")))


@catalogue.add(
    "f_log_lines",
    f"select run, row_number() over (partition by run order by conv_id, turn) as line_no, line from (select conv_id % {LOG_RUNS} as run, conv_id, turn,"
    " concat('turn ', turn, ' of ', conv_id, ': ', role, ' ', length(text)) as line from conversations)",
)
def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines through text files, one per run, with their number in the file."""
    rows = roles.table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") % LOG_RUNS).alias("run"), "conv_id", "turn",
        F.concat(F.lit("turn "), "turn", F.lit(" of "), "conv_id", F.lit(": "), "role", F.lit(" "), F.length("text")).alias("line"),
    )
    path = _path(spark, "logs")
    # A run's log is one file by its nature; runs are spread over tasks.
    rows.repartition("run").sortWithinPartitions("run", "conv_id", "turn").select("run", "line").write.partitionBy("run").text(path)
    found = read_numbered_lines(spark, path)
    return found.select(F.regexp_extract("file", r"run=(\d+)/", 1).cast("long").alias("run"), "line_no", "line")
