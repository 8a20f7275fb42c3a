"""Readers and writers. Paths may live on any Hadoop file system."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.expr import nan_to_null, sentinel_to_null
from ledgerline.params import REQUIRED_TRANSACTION_COLUMNS, TRANSACTION_DEFAULTS
from ledgerline.sources import schemas
from ledgerline.sources.splitting import read_json_array, read_numbered_lines


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return file_system.exists(hadoop_path)


def require_paths(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Raise once, naming every input that is absent."""
    missing = [f"{name} ({path})" for name, path in paths.items() if not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError("missing input files: " + ", ".join(missing))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; columns are matched by name, extra file columns are left out."""
    header = spark.read.option("header", True).csv(path).columns
    wanted = spark.createDataFrame([], schema).schema
    present = [f for f in wanted.fields if f.name in header]
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in present])


def read_train(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.TRAIN)


def read_test(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.TEST)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.TRANSACTIONS)


def read_datasets(spark: SparkSession, train: str, test: str, transactions: str):
    """The three tables of the customer workload, after one presence check."""
    require_paths(spark, {"train": train, "test": test, "transactions": transactions})
    return read_train(spark, train), read_test(spark, test), read_transactions(spark, transactions)


def with_transaction_contract(tx: DataFrame) -> DataFrame:
    """Raise on missing required columns; add absent optional ones with their default.

    Missing-value words in a default mean NULL. NaN in numbers becomes NULL, so that the
    aggregates skip it.
    """
    missing = [c for c in REQUIRED_TRANSACTION_COLUMNS if c not in tx.columns]
    if missing:
        raise ValueError(f"transactions lack required columns: {missing}")
    added: dict[str, Column] = {}
    for name, default in TRANSACTION_DEFAULTS.items():
        if name not in tx.columns:
            value = F.lit(default)
            added[name] = sentinel_to_null(value) if isinstance(default, str) else value
    cleaned = {
        f.name: nan_to_null(F.col(f.name))
        for f in tx.schema.fields
        if f.dataType.simpleString() in ("double", "float")
    }
    return tx.withColumns({**cleaned, **added})


def read_figures(spark: SparkSession, path: str, layout: str = "array") -> DataFrame:
    """Records of JSON files. Layout "array": each file one array, cut into blocks that many tasks read.
    Layout "lines": one record per line."""
    if layout not in ("array", "lines"):
        raise ValueError(f"unknown layout {layout!r}")
    return read_json_array(spark, path, schemas.FIGURES) if layout == "array" else spark.read.schema(schemas.FIGURES).json(path)


def read_text_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with the file they came from and their number in it, from 1."""
    return read_numbered_lines(spark, path).select(F.col("file").alias("run_id"), "line_no", "line")


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.NODES)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Edges with the row position ``pos`` in the file order."""
    from ledgerline.operators.segments import row_numbers

    rows = spark.read.schema(schemas.EDGES).option("header", True).csv(path)
    order = F.struct(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("r"),
    )
    placed = row_numbers(rows.select("source", "target", "action", order.alias("_at")), [], ["_at"], "pos")
    return placed.select("source", "target", "action", (F.col("pos") - 1).alias("pos"))


def read_node_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Exported node metrics; one column name holds a blank, so names are matched, not guessed."""
    return read_csv(spark, path, schemas.NODE_METRICS)


def read_edge_weights(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.EDGE_WEIGHTS)


def read_relational(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Table of a relational store; filters and columns are pushed into its query.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read
    with many tasks.
    """
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()


def named_items(items: DataFrame) -> DataFrame:
    """Items with a name that is not blank."""
    return items.filter(F.col("name").isNotNull() & (F.trim("name") != ""))


def first_items(items: DataFrame, n: int) -> DataFrame:
    """The first ``n`` named items by id; top-n per task, then merged."""
    return named_items(items).orderBy("appid").limit(n)


def uniform_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``n`` rows drawn without replacement, the same ones for the same seed."""
    draw = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(draw, key).limit(n)


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV parts with a header; the part count follows the data."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def submission(predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Customer id and prediction clipped at zero."""
    value = F.col(prediction).cast("double")
    return predictions.select(
        "cust_id", F.when(value.isNotNull(), F.greatest(value, F.lit(0.0))).alias("prediction")
    )


def upsert_latest(stored: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Stored rows replaced or extended by ``changes``, the last change of a key winning.

    ``changes`` carries ``_version``. One aggregation with partial maxima per task, so many
    copies of one key never meet in one place.
    """
    columns = stored.columns
    old = stored.withColumn("_version", F.lit(None).cast(changes.schema["_version"].dataType))
    both = old.unionByName(changes.select(*columns, "_version"))
    rest = [c for c in columns if c != key]
    rank = F.struct(F.col("_version").isNotNull().alias("new"), F.col("_version").alias("v"))
    latest = both.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return latest.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*columns)


def rebuild(df: DataFrame, path: str) -> DataFrame:
    """Drop what is stored at ``path`` and store ``df`` anew."""
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
