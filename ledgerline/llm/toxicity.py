"""Toxicity by class-conditional Kneser-Ney models of characters.

Two interpolated Kneser-Ney models, one of toxic and one of ordinary training texts, tell how likely
each word is, byte by byte, from up to ``ORDER - 1`` bytes before; invented and inflected forms of
an expression share its contexts. The lower orders, on which rare expressions fall back, are
continuation counts shared by both classes.

A document's evidence is the difference of its two log-likelihoods over its number of words. The
share of a word in it is brought towards zero by a margin: smaller differences come from the mix
of languages and from chance, and over hundreds of words they would outweigh a few clear
expressions. The margin is that of ``MARGINS`` whose evidence ranks training documents best that the
fitted models have not seen; a logistic curve fitted on the same documents gives the score.

Bytes are first mapped to 32 symbols, so an n-gram of ORDER symbols is a number below 2**(5 ORDER).
All training rows are counted and the models are computed from the exact counts as DataFrames; the
log-ratios go to the tasks in tables of a fixed size, one half-precision number for each n-gram
(64 MB) and one for each context (2 MB), compressed on the way: most n-grams are never seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import LOWER, chunks, prepare, remove, store, word_places

ORDER = 5
BACKOFF = (4, 3, 2, 1)
SYMBOL_BITS = 5
DISCOUNT = 0.9
MARGINS = (0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0)
GRAM_CELLS = 1 << (SYMBOL_BITS * ORDER)
CONTEXT_CELLS = GRAM_CELLS >> SYMBOL_BITS
COUNT_SYMBOLS = 1 << 23
FOLDS = 5
CALIBRATION_FOLD = 4
CALIBRATION_ROWS = 20_000

#: Letters are symbols 1 to 26; 0 ends a word; other ASCII, and the bytes of longer characters, share the rest.
SYMBOL = np.full(256, 27, np.int64)
SYMBOL[ord("a") : ord("z") + 1] = np.arange(1, 27)
SYMBOL[0x80:0xC0] = 28 + (np.arange(0x40) % 3)
SYMBOL[0xC0:] = 31


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def grams(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-gram number of every symbol (its ORDER - 1 predecessors in the word, padded with word ends,
    then itself) with the row; every word ends with symbol 0."""
    data = LOWER[data]
    start, end, row = word_places(data, places)
    size = end - start + 1
    first = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.int64)
    at = np.arange(len(out)) - np.repeat(first, size)
    inside = at < np.repeat(size - 1, size)
    out[inside] = SYMBOL[data[(np.repeat(start, size) + at)[inside]]]
    k = 1
    while k < ORDER:  # numbers of k symbols make those of 2 k
        before = np.zeros_like(out)
        before[k:] = out[:-k]
        before[at < k] = 0
        out |= before << (SYMBOL_BITS * k)
        k *= 2
    return out & ((1 << (SYMBOL_BITS * ORDER)) - 1), np.repeat(row, size)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by class and fold, some megabytes at a time; texts of the calibration fold go along."""
    names = ["gram", "t0", "o0", "t1", "o1", "text", "toxic"]
    waiting: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
        gram, kind = keys >> 2, keys & 3
        columns = [pa.array(np.where(kind == k, counts, 0)) for k in range(4)]
        return pa.RecordBatch.from_arrays([pa.array(gram), *columns, pa.nulls(len(keys), pa.string()), pa.nulls(len(keys), pa.int32())], names=names)

    for batch in batches:
        toxic, late = batch.column("toxic").to_numpy(), batch.column("late").to_numpy()
        kind = (1 - toxic) + 2 * late
        for first, end, data, places in chunks(batch.column("text")):
            gram, row = grams(data, places)
            waiting.append(gram << 2 | kind[first:end][row])
            held += len(gram)
            if held >= COUNT_SYMBOLS:
                yield flush()
                waiting, held = [], 0
        keep = np.flatnonzero(late)
        none = pa.nulls(len(keep), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, none, batch.column("text").take(pa.array(keep)), pa.array(toxic[keep].astype(np.int32))], names=names
        )
    if waiting:
        yield flush()


def _low(gram: str, symbols: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << (SYMBOL_BITS * symbols)) - 1))


def _context(gram: str) -> Column:
    return F.shiftright(F.col(gram), SYMBOL_BITS)


def shared_backoff(counts: DataFrame) -> DataFrame:
    """(low, p): probability of the last symbol of every n-gram of BACKOFF[0] symbols after the ones
    before, from continuation counts of both classes; shorter n-grams smooth longer ones."""
    levels, longer = [], counts.select("gram")
    for k in BACKOFF:
        longer = longer.groupBy(_low("gram", k).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels.append((k, longer))
    p = None
    for k, level in reversed(levels):
        # A context has at most 32 successors, so these windows are small whatever the input.
        own = Window.partitionBy(_context("gram"))
        level = level.withColumn("total", F.sum("n").over(own)).withColumn("kinds", F.count(F.lit(1)).over(own))
        if p is None:
            level = level.withColumn("p", F.lit(1.0 / (1 << SYMBOL_BITS)))
        else:
            level = level.withColumn("low", _low("gram", shorter)).join(p, "low")
        value = (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds") * F.col("p")) / F.col("total")
        p, shorter = level.select(F.col("gram").alias("low"), value.alias("p")), k
    return p


def ratio_tables(counts: DataFrame) -> bytes:
    """Log-ratios by cell for (gram, toxic, ordinary) counts: of n-grams (not a number: not seen), and of
    contexts for the symbols that neither class has seen after them; ``unpacked`` restores both."""
    own = Window.partitionBy(_context("gram"))
    joined = counts.withColumn("low", _low("gram", BACKOFF[0])).join(shared_backoff(counts), "low")
    for c in ("toxic", "ordinary"):
        total, kinds = F.sum(c).over(own), F.sum((F.col(c) > 0).cast("long")).over(own)
        joined = joined.withColumn(f"{c}_total", total).withColumn(f"{c}_rest", F.when(total > 0, DISCOUNT * kinds / total).otherwise(1.0))
    p = {
        c: F.when(F.col(f"{c}_total") > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"{c}_total")).otherwise(0.0) + F.col(f"{c}_rest") * F.col("p")
        for c in ("toxic", "ordinary")
    }
    found = joined.select(
        "gram",
        (F.col("toxic") + F.col("ordinary")).alias("n"),
        F.log(p["toxic"] / p["ordinary"]).alias("ratio"),
        F.log(F.col("toxic_rest") / F.col("ordinary_rest")).alias("rest"),
    )
    cells = F.array(
        F.struct((F.col("gram") % GRAM_CELLS).alias("cell"), (F.col("ratio") * F.col("n")).alias("x")),
        F.struct((_context("gram") % CONTEXT_CELLS + GRAM_CELLS).alias("cell"), (F.col("rest") * F.col("n")).alias("x")),
    )
    # At most GRAM_CELLS + CONTEXT_CELLS rows, whatever the input.
    table = found.select("n", F.explode(cells).alias("c")).groupBy("c.cell").agg((F.sum("c.x") / F.sum("n")).cast("float").alias("x")).toArrow()
    out = np.full(GRAM_CELLS + CONTEXT_CELLS, np.nan, np.float16)
    out[table.column("cell").to_numpy()] = table.column("x").to_numpy()
    return zstandard.compress(out, 3)


def unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Tables of n-grams and of contexts."""
    cells = np.frombuffer(zstandard.decompress(packed), np.float16)
    return cells[:GRAM_CELLS], np.nan_to_num(cells[GRAM_CELLS:].astype(np.float32))


def evidence(column: pa.Array, tables: tuple[np.ndarray, np.ndarray], margins: tuple[float, ...]) -> np.ndarray:
    """Difference of log-likelihoods per word of each row, words brought towards zero by each of ``margins``
    (one column each); 0 without words."""
    seen, rest = tables
    out = []
    for first, end, data, places in chunks(column):
        gram, row = grams(data, places)
        value = seen[gram].astype(np.float32)
        new = np.flatnonzero(np.isnan(value))
        value[new] = rest[(gram[new] >> SYMBOL_BITS) % CONTEXT_CELLS]
        last = np.flatnonzero((gram & ((1 << SYMBOL_BITS) - 1)) == 0)
        words = np.diff(np.cumsum(value, dtype=np.float64)[last], prepend=0.0)
        n = np.maximum(np.bincount(row[last], minlength=end - first), 1)
        nearer = (np.sign(words) * np.maximum(np.abs(words) - margin, 0) for margin in margins)
        out.append(np.column_stack([np.bincount(row[last], weights=w, minlength=end - first) / n for w in nearer]))
    return np.concatenate(out) if out else np.zeros((0, len(margins)))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, lightly regularised; the slope is never negative."""
    middle, scale = x.mean(), x.std() or 1.0
    z = np.column_stack([(x - middle) / scale, np.ones_like(x)])
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (p - y) + 1e-3 * theta)
        theta -= np.clip(step, -4, 4)
    slope = max(0.0, theta[0]) / scale
    return slope, theta[1] - slope * middle


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Margin that ranks best (equal values count half; the first of equals), slope and shift; ``x`` has a column for each of MARGINS."""
    # Sums of average ranks of the toxic rows order the margins as the areas under their curves do.
    best = int(np.argmax([pd.Series(column).rank().to_numpy() @ y for column in x.T]))
    return MARGINS[best], *logistic(x[:, best], y)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, margin, slope, shift = model.value
        tables = unpacked(packed)
        for batch in batches:
            score = 1 / (1 + np.exp(-np.clip(slope * evidence(batch.column("text"), tables, (margin,))[:, 0] + shift, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Learns from labelled rows outside fold 0 of crc32(doc_id); rows whose label is null are no
    training rows. A null or wordless text has no evidence either way and gets the curve's value at 0. Without training rows
    of both classes every score is the share of toxic rows (0 without any). Rows without doc_id are
    held_out false. Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("fold", fold(F.col("doc_id")))
    marks = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # A sort-merge join at every size: the labels grow with the documents.
    training = rows.where("fold <> 0").join(marks.where(fold(F.col("doc_id")) != 0).hint("merge"), "doc_id").select(
        "text", F.when(F.col("toxic") > 0, 1).otherwise(0).cast("long").alias("toxic"), F.when(F.col("fold") == CALIBRATION_FOLD, 1).otherwise(0).cast("long").alias("late")
    )
    counted, path = store(training.mapInArrow(_count, "gram long, t0 long, o0 long, t1 long, o1 long, text string, toxic int"), "toxicity-counts")
    kinds = ("t0", "o0", "t1", "o1")
    sums, sums_path = store(counted.where("gram is not null").groupBy("gram").agg(*[F.sum(c).alias(c) for c in kinds]), "toxicity-grams")
    both = all(sums.agg(F.max("t0") > 0, F.max("o0") > 0).first())
    early = spark.sparkContext.broadcast(ratio_tables(sums.where("t0 + o0 > 0").select("gram", F.col("t0").alias("toxic"), F.col("o0").alias("ordinary"))))

    def calibrating(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = unpacked(early.value)
        for batch in batches:
            x = evidence(batch.column("text"), tables, MARGINS)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(MARGINS), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([lists, batch.column("toxic")], names=["x", "y"])

    # The margin and the curve's two numbers come from a bounded sample, spread over the fold by a hash of the evidence.
    sample = counted.where("toxic is not null").select("text", "toxic").mapInArrow(calibrating, "x array<double>, y int").orderBy(F.xxhash64("x"), "y").limit(CALIBRATION_ROWS).toPandas()
    early.destroy()
    y = sample["y"].to_numpy(np.float64)
    if both and 0 < y.sum() < len(y):
        margin, slope, shift = fit_curve(np.stack(sample["x"]), y)
    else:
        share = (y.sum() + 1e-9) / (len(y) + 1e-6)
        margin, slope, shift = 0.0, 0.0, float(np.log(share / (1 - share))) if 0 < share < 1 else -30.0
    tables = ratio_tables(sums.select("gram", F.expr("t0 + t1").alias("toxic"), F.expr("o0 + o1").alias("ordinary")))
    model = spark.sparkContext.broadcast((tables, margin, slope, shift))
    remove(spark, path, sums_path)
    return rows.select("doc_id", F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"), "text").mapInArrow(
        _score(model), "doc_id long, held_out boolean, score double, predicted int"
    )
