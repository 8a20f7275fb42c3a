"""Quality classifier: naive Bayes support vectors over n-gram indicators.

A document's features are the distinct word 1- and 2-grams (lower case) and byte 2- to 4-grams of its
whole text, hashed into ``CELLS`` cells; each is an indicator scaled by its class log-count ratio r,
and the vector is brought to length 1 so that long and short texts compare. The ratios are counts
over all training rows. A linear hinge-loss model is then fitted by dual coordinate descent on a
sample of training rows of at most about ``SAMPLE_ROWS`` of each class, drawn by a hash, in one task;
weights and their mean magnitude are mixed, so n-grams that the sample lacks still count by r.

The score is a logistic curve over the margin. Margins for the curve come from a first model that
has not seen fold ``LATE_FOLD``, neither in its ratios nor in its sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import CHUNK_BYTES, LOWER, Roller, chunks, prepare, remove, store, word_places

FOLDS, HELD_FOLD, LATE_FOLD = 4, 2, 3
THRESHOLD = 0.7
CELL_BITS = 20
CELLS = 1 << CELL_BITS
BYTE_ORDERS = (2, 3, 4)
MULTIPLIERS = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}
SLICE_CELLS = 1 << 14
SMOOTHING = 1.0
SAMPLE_ROWS = 3000
COST = 1.0
EPOCHS = 30
TOLERANCE = 1e-3
#: Weight of the fitted model against the mean magnitude of its weights.
SHARE = 0.25
KINDS = ("bad_early", "good_early", "bad_late", "good_late")
ROLLER = Roller(13)


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


# -- features ------------------------------------------------------------------------------


def byte_grams(data: np.ndarray, first: int, stop: int) -> list[np.ndarray]:
    """Cells of the byte n-grams that start from ``first`` to ``stop - 1``, one array for each of BYTE_ORDERS."""
    part = data[first : stop + BYTE_ORDERS[-1] - 1]
    code, out = part.astype(np.uint32), []
    for k in range(2, BYTE_ORDERS[-1] + 1):
        n = max(len(part) - k + 1, 0)
        code = code[:n] | part[k - 1 : k - 1 + n].astype(np.uint32) << np.uint32(8 * (k - 1))
        if k in BYTE_ORDERS:
            out.append((code[: stop - first] * np.uint32(MULTIPLIERS[k]) >> np.uint32(32 - CELL_BITS)).astype(np.intp))
    return out


def word_grams(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the words ``first`` to ``stop - 1``, and of the pairs that begin with them (-1 where a row ends)."""
    last = min(stop + 1, len(start))  # the word after them ends their last pair
    if stop <= first:
        return np.zeros(0, np.intp), np.zeros(0, np.intp)
    low = LOWER[data[start[first] : end[last - 1]]]
    own = slice(first, last)
    word = ROLLER.ranges(ROLLER.sums(low), start[own] - start[first], end[own] - start[first])
    shift = np.uint64(64 - CELL_BITS)
    pair = np.full(stop - first, -1, np.intp)
    same = np.flatnonzero(row[first : last - 1] == row[first + 1 : last])
    pair[same] = ((word[same] * np.uint64(0x100000001B3) ^ word[same + 1]) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.intp)
    return (word[: stop - first] >> shift).astype(np.intp), pair


class Features:
    """Distinct cells of the n-grams of each row, in no order. A scratch table tells repeats without sorting."""

    def __init__(self) -> None:
        self.stamp = np.zeros(CELLS, np.int32)

    def distinct(self, parts: list[np.ndarray]) -> np.ndarray:
        cells = np.concatenate(parts)
        turn = np.arange(len(cells), dtype=np.int32)
        self.stamp[cells] = turn
        return cells[self.stamp[cells] == turn]

    def __call__(self, data: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
        start, end, row = word_places(data, places)
        if len(data) > 2 * CHUNK_BYTES:  # a single very long row, taken in slices
            out = np.zeros(0, np.intp)
            for first in range(0, len(data), CHUNK_BYTES):
                stop = min(first + CHUNK_BYTES, len(data))
                word, pair = word_grams(data, start, end, row, *np.searchsorted(start, [first, stop]))
                out = self.distinct([out, word, pair[pair >= 0], *byte_grams(data, first, stop)])
            yield out
            return
        grams = byte_grams(data, 0, len(data))
        word, pair = word_grams(data, start, end, row, 0, len(start))
        cuts = np.searchsorted(row, np.arange(len(places)))
        for r, (a, b) in enumerate(zip(places[:-1], places[1:])):
            own = slice(cuts[r], cuts[r + 1])
            pairs = pair[own]
            yield self.distinct([word[own], pairs[pairs >= 0], *(g[a : max(b - k + 1, a)] for k, g in zip(BYTE_ORDERS, grams))])


def log_ratios(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Log-count ratios of the cells, 0 for cells that neither class has."""
    seen = (good + bad) > 0
    n = max(int(seen.sum()), 1)
    ratio = np.log((good + SMOOTHING) / (good.sum() + SMOOTHING * n)) - np.log((bad + SMOOTHING) / (bad.sum() + SMOOTHING * n))
    return np.where(seen, ratio, 0.0)


# -- the model -------------------------------------------------------------------------------


def dual_descent(rows: list[np.ndarray], sign: np.ndarray, squares: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float, np.ndarray]:
    """Hinge-loss model of unit vectors with cells ``rows`` and squared cell values ``squares``.

    Returns weight times value of every cell, the weight of a constant 1, and the dual variables. A
    step solves the dual problem exactly in one row's variable, kept between 0 and COST. An epoch
    visits all rows in random order; it is the last when no step's projected gradient exceeds TOLERANCE.
    """
    z, bias = np.zeros(len(squares)), 0.0
    alpha = np.zeros(len(rows))
    scale = np.array([1 / np.sqrt(s) if (s := squares[r].sum()) > 0 else 0.0 for r in rows])
    diagonal = np.where(scale > 0, 2.0, 1.0)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * (scale[i] * z[rows[i]].sum() + bias) - 1
            projected = min(gradient, 0.0) if alpha[i] <= 0 else max(gradient, 0.0) if alpha[i] >= COST else gradient
            worst = max(worst, abs(projected))
            if projected:
                new = min(max(alpha[i] - gradient / diagonal[i], 0.0), COST)
                step = (new - alpha[i]) * sign[i]
                z[rows[i]] += step * scale[i] * squares[rows[i]]
                bias += step
                alpha[i] = new
        if worst < TOLERANCE:
            break
    return z, bias, alpha


def interpolated(z: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Weight times value of every cell after mixing weights with their mean magnitude."""
    live = ratio != 0
    mean = np.abs(z[live] / ratio[live]).mean() if live.any() else 0.0
    return (1 - SHARE) * mean * ratio + SHARE * z


def margin(rows: list[np.ndarray], values: np.ndarray, squares: np.ndarray, bias: float) -> np.ndarray:
    return np.array([values[r].sum() / np.sqrt(max(squares[r].sum(), 1e-12)) + bias for r in rows])


def curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (never negative) and shift of a weighted logistic curve, lightly regularised."""
    weight = weight / weight.mean()
    middle, scale = np.average(x, weights=weight), x.std() or 1.0
    z = np.column_stack([(x - middle) / scale, np.ones_like(x)])
    theta = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2), z.T @ (weight * (p - y)) + 1e-2 * theta)
        theta -= np.clip(step, -4, 4)
    slope = max(0.0, theta[0]) / scale
    return float(slope), float(theta[1] - slope * middle)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that have each cell, by class and fold, packed by slices of cells once per task; sampled texts go along."""
    names = ["slice", "packed", "text", "good", "late"]
    counts = np.zeros((len(KINDS), CELLS), np.int64)
    features = Features()
    for batch in batches:
        good, late = batch.column("good").to_numpy(), batch.column("late").to_numpy()
        kind = good + 2 * late
        for first, _, data, places in chunks(batch.column("text")):
            for i, cells in enumerate(features(data, places)):
                counts[kind[first + i], cells] += 1
        keep = np.flatnonzero(batch.column("sampled").to_numpy(zero_copy_only=False))
        if len(keep):
            texts = batch.column("text").take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(keep), pa.int32()), pa.nulls(len(keep), pa.binary()), texts.fill_null(""), pa.array(good[keep]), pa.array(late[keep])], names=names)
    packer = zstandard.ZstdCompressor(level=3)
    rows = [(i, packer.compress(np.ascontiguousarray(part).tobytes())) for i, part in enumerate(np.split(counts, CELLS // SLICE_CELLS, axis=1)) if part.any()]
    none = [pa.nulls(len(rows), t) for t in (pa.string(), pa.int64(), pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), *none], names=names)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the packed counts by slice. All slices together have CELLS cells, whatever the input."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, packed in zip(batch.column("slice").to_pylist(), batch.column("packed").to_pylist()):
            part = np.frombuffer(zstandard.decompress(packed), np.int64)
            held[i] = held[i] + part if i in held else part
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["slice", "packed"])


def _fit(ratios):
    """One row with the model, from all sampled rows in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        early, whole, rates = ratios.value
        rows, good, late, features = [], [], [], Features()
        for batch in batches:
            good.append(batch.column("good").to_numpy())
            late.append(batch.column("late").to_numpy())
            for _, _, data, places in chunks(batch.column("text")):
                rows += [np.sort(cells).astype(np.int32) for cells in features(data, places)]
        good, late = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (good, late))
        if len(set(zip(good, late))) < 4:
            return
        late = late.astype(bool)
        order = np.lexsort(([int(r.sum()) for r in rows], [len(r) for r in rows], good))  # the same whatever the order of arrival
        rows, good, late = [rows[i] for i in order], good[order], late[order]
        sign = 2.0 * good - 1
        seen = [rows[i] for i in np.flatnonzero(~late)]
        squares = early * early
        z, bias, _ = dual_descent(seen, sign[~late], squares)
        x = margin([rows[i] for i in np.flatnonzero(late)], interpolated(z, early), squares, bias)
        slope, shift = curve(x, good[late].astype(float), 1 / rates[good[late]])
        squares = whole * whole
        z, bias, _ = dual_descent(rows, sign, squares)
        model = np.concatenate([interpolated(z, whole), squares]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()], pa.binary()), pa.array([bias]), pa.array([slope]), pa.array([shift])], names=["model", "bias", "slope", "shift"])

    return run


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, bias, slope, shift = model.value
        values, squares = (x.astype(np.float64) for x in np.split(np.frombuffer(packed, np.float32), 2))
        features = Features()
        for batch in batches:
            x = np.zeros(batch.num_rows)
            for first, _, data, places in chunks(batch.column("text")):
                for i, cells in enumerate(features(data, places)):
                    x[first + i] = values[cells].sum() / np.sqrt(max(squares[cells].sum(), 1e-12)) + bias
            score = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Learns from labelled rows outside fold 2 of crc32(doc_id); of several labels of a doc_id the
    largest counts, null labels do not. ``sample_rows`` bounds the rows of each class and fold group
    that the linear model is fitted on (in expectation; rows are drawn by a hash). A null or empty
    text has no features and gets the curve's value at the model's constant. Without training rows of
    both classes, in the late fold and before it, every score is the share of good rows (0 without any). Rows without
    doc_id are held_out false. Repeated rows are scored alike. Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("fold", fold(F.col("doc_id")))
    marks = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("good"))
    marks = marks.where(fold(F.col("doc_id")) != HELD_FOLD)
    n = {(r["good"], r["late"]): r["n"] for r in marks.groupBy("good", (fold(F.col("doc_id")) == LATE_FOLD).alias("late")).agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = [sum(n.get((c, late), 0) for late in (False, True)) for c in (0, 1)]
    rates = np.array([min(1.0, sample_rows / max(t, 1)) for t in totals])
    scored = rows.select("doc_id", F.coalesce(F.col("fold") == HELD_FOLD, F.lit(False)).alias("held_out"), "text")
    share = totals[1] / max(sum(totals), 1)
    alike = scored.select("doc_id", "held_out", F.lit(float(share)).alias("score"), F.lit(int(share >= THRESHOLD)).alias("predicted"))
    if len(n) < 4:
        return alike
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.when(F.col("good") > 0, int(rates[1] * (1 << 30))).otherwise(int(rates[0] * (1 << 30)))
    # A sort-merge join at every size: the labels grow with the documents.
    training = rows.where(F.col("fold") != HELD_FOLD).join(marks.hint("merge"), "doc_id").select(
        "text", F.col("good").cast("long").alias("good"), (F.col("fold") == LATE_FOLD).cast("long").alias("late"), draw.alias("sampled")
    )
    counted, path = store(training.mapInArrow(_count, "slice int, packed binary, text string, good long, late long"), "quality-counts")
    counts = np.zeros((len(KINDS), CELLS))
    added = counted.where("slice is not null").select("slice", "packed").repartition("slice").mapInArrow(_add, "slice int, packed binary")
    for row in added.toLocalIterator():
        at = row["slice"] * SLICE_CELLS
        counts[:, at : at + SLICE_CELLS] = np.frombuffer(row["packed"], np.int64).reshape(len(KINDS), -1)
    bad, good = counts[0] + counts[2], counts[1] + counts[3]
    ratios = spark.sparkContext.broadcast((log_ratios(counts[1], counts[0]), log_ratios(good, bad), rates))
    sample = counted.where("text is not null").select("text", "good", "late")
    found = sample.repartition(1).mapInArrow(_fit(ratios), "model binary, bias double, slope double, shift double").first()
    if found is None:
        return alike
    model = spark.sparkContext.broadcast((bytes(found["model"]), found["bias"], found["slope"], found["shift"]))
    ratios.destroy()
    remove(spark, path)
    return scored.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")
