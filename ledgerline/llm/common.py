"""Helpers shared by the operators of this subpackage: stored steps, text buffers, hashing."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerline
from ledgerline.session import apply_settings, shared_folder

# Tasks get the functions by value, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules["ledgerline"])

CHUNK_BYTES = 1 << 20
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: adaptive plans, and Arrow batches that stay small with long texts."""
    apply_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back; the path is for ``remove``."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete step tables that a later step has replaced."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def documents(docs: DataFrame) -> DataFrame:
    """The two columns most operators read; other columns, whatever their names, stay out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if len(column) == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    places = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, places - places[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``most`` bytes (one row at least): first row, end row, bytes, offsets."""
    data, places = text_buffer(column)
    first = 0
    while first < len(places) - 1:
        end = max(first + 1, int(np.searchsorted(places, places[first] + most, side="right")) - 1)
        yield first, end, data[places[first] : places[end]], places[first : end + 1] - places[first]
        first = end


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words so that every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Roller:
    """Polynomial hashes of any byte range, modulo 2**64, from prefix sums."""

    def __init__(self, seed: int = 7):
        self.table = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = 0x9E3779B97F4A7C15 | 1
        self.back = pow(self.base, -1, 1 << 64)
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 1 << 16)
            for name, value in (("powers", self.base), ("inverse", self.back)):
                steps = np.full(size, value, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[: len(data)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.inverse[start])


SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_places(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (bytes that are no ASCII white space); words end with their row."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[places] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(places, start, side="right") - 1
