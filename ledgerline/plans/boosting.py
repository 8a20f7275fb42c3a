"""Boosted trees for any loss, grown from sums of gradients and Hessians.

Features are cut into at most 255 bins, one byte each; byte 0 is a missing value, and every split
learns on which side missing values go. A level of a tree is one pass: each task adds up gradient
and Hessian per (node, feature, bin), the sums of all tasks meet by feature, and the best split of
every node and feature comes to the driver, which keeps the best of each node. What is moved does not
depend on the number of rows. Rows hold their score of the last written checkpoint; trees grown since
are applied on the way. Up to TASK_ROWS rows, which one task adds up anyway, that task keeps its rows and
grows the trees of a checkpoint in one job, by the same sums; the job of a level costs more than its work.

The validation rows are scored after every round. Fitting ends when ``patience`` rounds have brought no
better score, and the model keeps the trees up to the best round.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialise

CHECKPOINT_ROUNDS = 25
MISSING = 0
EDGE_ACCURACY = 10_000
#: Rows that one task adds up in a level (fewer while cores would be idle, but no less than the second), and bytes of sums that one task brings together.
TASK_ROWS, LEAST_TASK_ROWS = 200_000, 20_000
TASK_BYTES = 32 << 20


# -- losses --------------------------------------------------------------------------------


class Loss:
    """Scores ``s`` against targets ``y``: derivatives by s, and how validation rows are judged."""

    def start(self, mean: float, median: float) -> float:
        return mean

    def derivatives(self, s: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def value(self, s: np.ndarray) -> np.ndarray:
        return s

    def judge(self, s: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.abs(self.value(s) - y)


class Squared(Loss):
    def derivatives(self, s, y):
        return s - y, np.ones_like(s)

    def judge(self, s, y):
        return (s - y) ** 2


class Absolute(Loss):
    """Leaves take the median of their residuals, as steps of the sign alone would have no scale."""

    def start(self, mean, median):
        return median

    def derivatives(self, s, y):
        return np.sign(s - y), np.ones_like(s)


class PseudoHuber(Loss):
    """Squared near 0, absolute far away; the slope is 1."""

    def start(self, mean, median):
        return median

    def derivatives(self, s, y):
        z = s - y
        scale = 1 + z * z
        return z / np.sqrt(scale), scale**-1.5

    def judge(self, s, y):
        return np.sqrt(1 + (s - y) ** 2) - 1


class Tweedie(Loss):
    """Compound Poisson-gamma deviance of the given power, log link."""

    def __init__(self, power: float):
        self.power = power

    def start(self, mean, median):
        return math.log(max(mean, 1e-6))

    def derivatives(self, s, y):
        a, b = y * np.exp((1 - self.power) * s), np.exp((2 - self.power) * s)
        return b - a, (2 - self.power) * b - (1 - self.power) * a

    def value(self, s):
        return np.exp(s)


class Logistic(Loss):
    def start(self, mean, median):
        p = min(max(mean, 1e-6), 1 - 1e-6)
        return math.log(p / (1 - p))

    def derivatives(self, s, y):
        p = self.value(s)
        return p - y, np.maximum(p * (1 - p), 1e-16)

    def value(self, s):
        return 1 / (1 + np.exp(-s))

    def judge(self, s, y):
        return np.logaddexp(0, s) - y * s


class UnknownLoss(ValueError):
    pass


def loss_named(name: str, power: float = 1.5) -> Loss:
    known = {"squared": Squared, "absolute": Absolute, "pseudo_huber": PseudoHuber, "logistic": Logistic}
    if name == "tweedie":
        return Tweedie(power)
    if name not in known:
        raise UnknownLoss(f"no loss named {name}")
    return known[name]()


# -- trees ---------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes by number: feature (-1: a leaf), last bin that goes left, side of missing values, children, value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, values: tuple[float, float]) -> tuple[int, int]:
        first = len(self.feature)
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left
        self.left[node], self.right[node] = first, first + 1
        for v in values:
            for column, empty in ((self.feature, -1), (self.cut, 0), (self.missing_left, True), (self.left, 0), (self.right, 0), (self.value, v)):
                column.append(empty)
        return first, first + 1

    def leaves(self, bins: np.ndarray, above: np.ndarray | None = None) -> np.ndarray:
        """Leaf of every row of bins (rows x features), from the root or the nodes ``above``."""
        feature, cut, left, right = (np.array(c) for c in (self.feature, self.cut, self.left, self.right))
        missing = np.array(self.missing_left)
        node = np.zeros(len(bins), np.int64) if above is None else above.copy()
        todo = np.flatnonzero(feature[node] >= 0)
        while len(todo):
            at = node[todo]
            b = bins[todo, feature[at]]
            goes = np.where(b == MISSING, missing[at], b <= cut[at])
            node[todo] = np.where(goes, left[at], right[at])
            todo = todo[feature[node[todo]] >= 0]
        return node

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]


def _best(sums: np.ndarray, l2: float, least: float) -> tuple[np.ndarray, ...]:
    """Best gain, cut, missing_left, left sums and right sums from sums (... x bins x 2); the gain is -inf where no split helps.

    Equal gains: missing values to the left first, then the smaller cut.
    """
    total, gone = sums.sum(-2)[..., None, :], sums[..., MISSING, :][..., None, :]
    run = np.cumsum(sums[..., 1:, :], axis=-2)[..., :-1, :]
    kept = total[..., 0] ** 2 / (total[..., 1] + l2)
    found = []
    for left in (run + gone, run):
        right = total - left
        ok = (left[..., 1] >= least) & (right[..., 1] >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[..., 0] ** 2 / (left[..., 1] + l2) + right[..., 0] ** 2 / (right[..., 1] + l2) - kept
        gain = np.where(ok, gain, -np.inf)
        at = gain.argmax(-1)
        there = at[..., None]
        found.append((np.take_along_axis(gain, there, -1)[..., 0], at, *(np.take_along_axis(x, there[..., None], -2)[..., 0, :] for x in (left, right))))
    over = found[1][0] > found[0][0]
    gain, at, left, right = (np.where(over if x.ndim == over.ndim else over[..., None], y, x) for x, y in zip(*found))
    return np.where(gain > 1e-12 * (1 + total[..., 0, 1]), gain, -np.inf), at + 1, ~over, left, right


def best_splits(sums: np.ndarray, l2: float, least: float) -> list[tuple]:
    """``_best`` per node from sums (nodes x bins x 2), or None."""
    found = zip(*(x.tolist() for x in _best(sums, l2, least)))
    return [best if best[0] > -math.inf else None for best in found]


# -- fitting ---------------------------------------------------------------------------------


def tasks_for(rows: int, cores: int) -> int:
    """Tasks of a level: whole waves of the cores once there are rows enough, as every task sends its sums."""
    waves = math.ceil(rows / (TASK_ROWS * cores))
    return max(1, min(waves * cores, rows // LEAST_TASK_ROWS))


def _mixed(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Numbers between 0 and 1 from row hashes and a round."""
    x = hashes.astype(np.uint64) ^ np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


class Scorer:
    """Scores of rows: those written, and the trees grown since."""

    def __init__(self, trees: list[Tree], width: int):
        self.trees, self.width = trees, width

    def __call__(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        bins = _matrix(batch.column("bins"), self.width)
        s = batch.column("score").to_numpy().copy()
        for tree in self.trees:
            s += tree.scores(bins)
        return bins, s


def _partial(loss: Loss, scorer: Scorer, tree: Tree, frontier: list[int], features: list[int], bins_most: int, share: float, salt: int):
    """Sums of gradient and Hessian per feature over the rows of a task; the first level also judges validation rows."""
    place = {node: i for i, node in enumerate(frontier)}
    judge = frontier == [0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(features), len(frontier), bins_most, 2))
        judged, n = 0.0, 0
        lookup = np.full(len(tree.feature), -1)
        lookup[list(place)] = list(place.values())
        for batch in batches:
            if batch.num_rows == 0:
                continue
            bins, s = scorer(batch)
            y, val = batch.column("y").to_numpy(), batch.column("val").to_numpy(zero_copy_only=False)
            if judge:
                judged, n = judged + float(loss.judge(s[val], y[val]).sum()), n + int(val.sum())
            use = ~val
            if share < 1:
                use &= _mixed(batch.column("hash").to_numpy(), salt) < share
            at = lookup[tree.leaves(bins)]
            use &= at >= 0
            g, h = loss.derivatives(s[use], y[use])
            at, own = at[use], bins[use]
            _sums(at, (own[:, f] for f in features), g, h, len(frontier), bins_most, sums)
        rows = [(-1, np.array([judged, n]).tobytes())] if judge else []
        rows += [(f, sums[i].tobytes()) for i, f in enumerate(features)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["feature", "sums"])

    return run


def _meet(nodes: int, bins_most: int, l2: float, least: float):
    """Sums of all tasks by feature, then the best split of each node on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for f, raw in zip(batch.column("feature").to_pylist(), batch.column("sums").to_pylist()):
                part = np.frombuffer(raw)
                held[f] = held[f] + part if f in held else part
        rows = []
        for f, sums in held.items():
            if f < 0:
                rows.append((f, -1, sums[0], int(sums[1]), True, [0.0, 0.0], [0.0, 0.0]))
                continue
            for node, best in enumerate(best_splits(sums.reshape(nodes, bins_most, 2), l2, least)):
                if best:
                    rows.append((f, node, *best))
        types = [pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.bool_(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        columns = zip(*rows) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["feature", "node", "gain", "cut", "missing_left", "left", "right"])

    return run


def _sums(at: np.ndarray, own, g: np.ndarray, h: np.ndarray, nodes: int, bins_most: int, sums: np.ndarray) -> None:
    """Adds gradient and Hessian per (feature, node, bin); ``own`` yields the bins of a feature at a time."""
    base, one = at * bins_most, bool((h == 1).all())
    for i, b in enumerate(own):
        cell = base + b
        for k, weight in enumerate((g, None if one else h)):
            sums[i, :, :, k] += np.bincount(cell, weight, nodes * bins_most).reshape(nodes, bins_most)


def _ahead(booster: "Booster", scorer: Scorer, bins_most: int, first: int, until: int):
    """Rounds ``first`` to ``until`` - 1 in one task that holds all rows: (round, what is judged before it and its tree)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(*scorer(b), b.column("y").to_numpy(), b.column("val").to_numpy(zero_copy_only=False), b.column("hash").to_numpy()) for b in batches if b.num_rows]
        if not held:
            return
        bins, s, y, val, hashes = (np.concatenate(x) for x in zip(*held))
        del held
        columns, made = np.ascontiguousarray(bins.T), []
        for number in range(first, until):
            judged = float(booster.loss.judge(s[val], y[val]).sum()) / int(val.sum()) if val.any() else None
            tree = Tree()
            if number < booster.rounds:
                use = ~val
                if booster.subsample < 1:
                    use &= _mixed(hashes, booster.salt(number)) < booster.subsample
                booster.grow_here(tree, bins, columns, s, y, np.flatnonzero(use), booster.drawn(number, scorer.width), bins_most)
                leaf = tree.leaves(bins)
                if isinstance(booster.loss, Absolute):
                    _middles(tree, leaf[~val], (y - s)[~val], booster.rate)
                s += np.array(tree.value)[leaf]
            made.append((number, json.dumps([vars(tree), judged])))
        numbers, trees = zip(*made)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(trees, pa.string())], names=["number", "made"])

    return run


def _middles(tree: Tree, leaf: np.ndarray, rest: np.ndarray, rate: float) -> None:
    """Leaf values from the lower medians of the residuals."""
    order = np.lexsort((rest, leaf))
    found, start, n = np.unique(leaf[order], return_index=True, return_counts=True)
    for node, middle in zip(found.tolist(), rest[order][start + (n + 1) // 2 - 1].tolist()):
        tree.value[node] = rate * middle


SPLIT_SCHEMA = "feature int, node int, gain double, cut long, missing_left boolean, left array<double>, right array<double>"


@dataclass(frozen=True)
class Booster:
    loss: Loss
    rounds: int
    rate: float
    depth: int
    least_weight: float = 1.0
    l2: float = 1.0
    subsample: float = 1.0
    columns: float = 1.0
    patience: int | None = None
    bins: int = 128
    seed: int = 0

    def fit(self, rows: DataFrame) -> "BoostedTrees":
        """Model of ``rows`` (id, y, features array<double>, val boolean); nulls in features are missing values.

        Rows with ``val`` only judge the rounds. Without any, or without ``patience``, all rounds are kept.
        """
        edges = self._edges(rows.where("not val"))
        # Missing values, one bin more than edges, and an empty one, so that all values may part from missing ones.
        width, bins_most = len(edges), max((len(e) for e in edges), default=0) + 3
        start = self.loss.start(*self._middle(rows.where("not val")))
        n = rows.count()
        here = n <= TASK_ROWS
        tasks = 1 if here else tasks_for(n, rows.sparkSession.sparkContext.defaultParallelism)
        state = materialise(
            binned(rows.repartition(tasks, "id").sortWithinPartitions("id").select("id", F.col("y").cast("double").alias("y"), "val", F.xxhash64("id").alias("hash"), "features"), edges, ["id", "y", "val", "hash"]).withColumn("score", F.lit(float(start))),
            "boost-rows",
        )
        trees: list[Tree] = []
        written, best, best_rounds, history = 0, math.inf, 0, []
        known: dict[int, tuple[Tree, float | None]] | None = {} if here else None
        for number in range(self.rounds + 1):
            if number - written >= CHECKPOINT_ROUNDS:
                state = materialise(state.mapInArrow(_rescored(Scorer(trees[written:], width)), state.schema), "boost-rows")
                written = number
            tree, judged = self._grow(state, tasks, Scorer(trees[written:], width), bins_most, number, known)
            history.append(judged)
            if judged is not None and judged < best:
                best, best_rounds = judged, number
            if judged is not None and self.patience is not None and number - best_rounds >= self.patience:
                break
            if number == self.rounds:
                break
            if isinstance(self.loss, Absolute) and not here:
                self._medians(state, Scorer(trees[written:], width), tree)
            trees.append(tree)
        if self.patience is not None and best < math.inf:
            trees = trees[:best_rounds]
        return BoostedTrees(self.loss, edges, start, trees, history)

    def _edges(self, rows: DataFrame) -> list[np.ndarray]:
        """Upper ends of the bins but the last: distinct quantiles of the training values."""
        width = rows.select(F.max(F.size("features"))).first()[0] or 0
        if not width:
            return []
        shares = ", ".join(f"{i / self.bins!r}D" for i in range(1, self.bins))
        value = "if(isnan(features[{0}]), null, features[{0}])"
        found = rows.agg(*[F.expr(f"percentile_approx({value.format(i)}, array({shares}), {EDGE_ACCURACY})") for i in range(width)]).first()
        tops = rows.agg(*[F.expr(f"max({value.format(i)})") for i in range(width)]).first()
        return [np.array(sorted(set(e or []) - {top})) for e, top in zip(found, tops)]

    def _middle(self, rows: DataFrame) -> tuple[float, float]:
        mean, median = rows.agg(F.avg("y"), F.percentile_approx("y", 0.5, EDGE_ACCURACY)).first()
        return mean or 0.0, median or 0.0

    def drawn(self, number: int, width: int) -> list[int]:
        """Features of a round."""
        draw = np.random.default_rng((self.seed, number))
        return sorted(draw.choice(width, max(1, math.ceil(self.columns * width)), replace=False).tolist()) if width else []

    def salt(self, number: int) -> int:
        return self.seed * 100_003 + number

    def _grow(self, state: DataFrame, tasks: int, scorer: Scorer, bins_most: int, number: int, known: dict[int, tuple[Tree, float | None]] | None) -> tuple[Tree, float | None]:
        """Tree of a round and what is judged before it; ``known`` holds rounds that a task has grown ahead, or is None where levels are jobs."""
        if known is not None:
            if number not in known:
                until = min(number + CHECKPOINT_ROUNDS, self.rounds + 1)
                found = state.coalesce(1).mapInArrow(_ahead(self, scorer, bins_most, number, until), "number int, made string").collect()
                known.clear()
                known.update({i: (Tree(), None) for i in range(number, until)})
                for r in found:
                    grown, judged = json.loads(r["made"])
                    known[r["number"]] = Tree(**grown), judged
            return known[number]
        tree, frontier, judged, last = Tree(), [0], None, number == self.rounds
        features = self.drawn(number, scorer.width)
        for level in range(1 if last else self.depth):
            partial = state.mapInArrow(_partial(self.loss, scorer, tree, frontier, features, bins_most, self.subsample, self.salt(number)), "feature int, sums binary")
            # Every task of a level sends its sums; they meet in tasks of a bounded size.
            meeting = 1 + len(features) * len(frontier) * bins_most * 16 * tasks // TASK_BYTES
            found = partial.repartition(meeting, "feature").mapInArrow(_meet(len(frontier), bins_most, self.l2, self.least_weight), SPLIT_SCHEMA).collect()
            best: dict[int, tuple] = {}
            for r in found:
                if r["feature"] < 0:
                    judged = r["gain"] / r["cut"] if r["cut"] else None
                elif r["node"] not in best or (-r["gain"], r["feature"]) < (-best[r["node"]]["gain"], best[r["node"]]["feature"]):
                    best[r["node"]] = r
            if last or not best:
                break
            frontier = self._split(tree, frontier, {place: tuple(r[c] for c in ("feature", "cut", "missing_left", "left", "right")) for place, r in best.items()})
        return tree, judged

    def _split(self, tree: Tree, frontier: list[int], best: dict[int, tuple]) -> list[int]:
        """Splits nodes of ``frontier`` by (feature, cut, missing_left, left sums, right sums); the new nodes."""
        grown = []
        for place in sorted(best):
            feature, cut, missing_left, left, right = best[place]
            values = tuple(-self.rate * g / (h + self.l2) for g, h in (left, right))
            grown += tree.split(frontier[place], feature, cut, missing_left, values)
        return grown

    def grow_here(self, tree: Tree, bins: np.ndarray, columns: np.ndarray, s: np.ndarray, y: np.ndarray, rows: np.ndarray, features: list[int], bins_most: int) -> None:
        """Grows ``tree`` on ``rows`` of the rows at hand; ``columns`` are the bins by feature."""
        own, by_feature = bins[rows], columns[features][:, rows]
        g, h = self.loss.derivatives(s[rows], y[rows])
        node, frontier = np.zeros(len(rows), np.int64), [0]
        for _ in range(self.depth if features else 0):
            place = np.full(len(tree.feature), -1)
            place[frontier] = np.arange(len(frontier))
            at = place[node]
            live = at >= 0
            if not live.all():
                own, by_feature, g, h, node, at = own[live], by_feature[:, live], g[live], h[live], node[live], at[live]
            sums = np.zeros((len(features), len(frontier), bins_most, 2))
            _sums(at, by_feature, g, h, len(frontier), bins_most, sums)
            gain, cut, missing_left, left, right = _best(sums, self.l2, self.least_weight)
            pick = gain.argmax(0)
            best = {
                i: (features[f], int(cut[f, i]), bool(missing_left[f, i]), left[f, i].tolist(), right[f, i].tolist())
                for i, f in enumerate(pick.tolist()) if gain[f, i] > -math.inf
            }
            if not best:
                break
            frontier = self._split(tree, frontier, best)
            node = tree.leaves(own, node)

    def _medians(self, state: DataFrame, scorer: Scorer, tree: Tree) -> None:
        """Leaf values from the medians of the residuals of all training rows."""

        def residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, s = scorer(batch)
                yield pa.RecordBatch.from_arrays([pa.array(tree.leaves(bins)), pa.array(batch.column("y").to_numpy() - s)], names=["leaf", "rest"])

        rest = state.where("not val").mapInArrow(residuals, "leaf long, rest double")
        for leaf, middle in rest.groupBy("leaf").agg(F.percentile_approx("rest", 0.5, EDGE_ACCURACY)).collect():
            tree.value[leaf] = self.rate * middle


def binned(rows: DataFrame, edges: list[np.ndarray], keep: list[str]) -> DataFrame:
    """``keep`` and the features as one byte each: 0 missing, else 1 + the number of edges below the value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("features").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, max(len(edges), 1))
            out = np.zeros((batch.num_rows, len(edges)), np.uint8)
            for f, e in enumerate(edges):
                x = cells[:, f]
                out[:, f] = np.where(np.isnan(x), MISSING, 1 + np.searchsorted(e, x, side="left"))
            packed = pa.array([row.tobytes() for row in out], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), packed], names=[*keep, "bins"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.select(*keep, "features").mapInArrow(run, f"{fields}, bins binary")


def _rescored(scorer: Scorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, s = scorer(batch)
                yield batch.set_column(batch.schema.get_field_index("score"), "score", pa.array(s))

    return run


@dataclass
class BoostedTrees:
    loss: Loss
    edges: list[np.ndarray]
    start: float
    trees: list[Tree]
    history: list

    def predict(self, rows: DataFrame, keep: list[str], name: str = "y_pred") -> DataFrame:
        """``keep`` and the predicted value of every row with ``features``."""
        loss, scorer, start = self.loss, Scorer(self.trees, len(self.edges)), self.start

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                s = np.full(batch.num_rows, start)
                if batch.num_rows:
                    bins = _matrix(batch.column("bins"), scorer.width)
                    for tree in scorer.trees:
                        s += tree.scores(bins)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(loss.value(s))], names=[*keep, name])

        rows = binned(rows, self.edges, keep)
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
        return rows.mapInArrow(run, f"{fields}, {name} double")
