"""Session settings and durable intermediate tables."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: str = "8", app: str = "ledgerline", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> None:
    """Pin the runtime settings the plans rely on; all can be changed on a live session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is chosen only when nothing is set and the master is local.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = os.path.join(tempfile.gettempdir(), f"ledgerline-{os.getpid()}")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors and gives later joins true sizes.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(table: DataFrame) -> None:
    """Frees what ``materialise`` wrote for ``table``, once nothing lazy reads it any more."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def together(*jobs: Callable[[], object], at_once: int = 4) -> list:
    """Results of independent jobs, a few of them at a time: they share the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(job)) for job in jobs]]


def materialise_by(df: DataFrame, key: str, label: str = "step") -> DataFrame:
    """As ``materialise``, but bucketed by ``key``: joins and groupings on it do not move the rows again."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Changes with the name, length or time of any file under ``paths``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for path in paths:
        root = jvm.org.apache.hadoop.fs.Path(path)
        found = root.getFileSystem(conf).listFiles(root, True)
        while found.hasNext():
            status = found.next()
            seen.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:32]


def derived(spark: SparkSession, name: str, paths: Sequence[str], build: Callable[[], DataFrame]) -> DataFrame:
    """Table ``name`` derived from the files under ``paths``, stored in the shared folder under their fingerprint.

    It is built again as soon as one of the files is another; an unfinished one counts as absent.
    """
    path = f"{shared_folder(spark)}/{name}-{fingerprint(spark, paths)}"
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
