"""Multi-label data jobs: class list, encoding, weights, resampling, scoring, log mining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.expr import decide, multi_hot, ratio, sigmoid
from ledgerline.operators.prep import plain_split
from ledgerline.operators.segments import lowest_before, row_numbers, running_sum
from ledgerline.params import LabelParams
from ledgerline.session import materialise

# The epoch lines of a training log.
TRAIN_LINE = r"Train Loss:\s+([\d.]+)\s+\|\s+Train Acc:\s+([\d.]+)"
VAL_LINE = r"Val Loss:\s+([\d.]+)\s+\|\s+Val Acc:\s+([\d.]+)"

COPY_CHUNK = 10_000


def usable(records: DataFrame) -> DataFrame:
    """Records with both an image path and labels."""
    return records.select("id", "img_local_path", "themes").dropna("any")


def label_counts(records: DataFrame, top: int | None = None) -> DataFrame:
    """Rows per label over the flattened lists, most frequent first, ties by label."""
    counts = records.select(F.explode("themes").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), "label")
    return ordered.limit(top) if top else ordered


def categories_above(records: DataFrame, column: str, floor: int) -> DataFrame:
    counts = records.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.col("n") >= floor) & F.col(column).isNotNull()).orderBy(F.desc("n"), column)


def class_list(records: DataFrame, top: int) -> list[str]:
    """The ``top`` most frequent labels, in order; this is the model's output layout."""
    return [row["label"] for row in label_counts(records, top).collect()]


def encode(records: DataFrame, classes: Sequence[str], base: str = "") -> DataFrame:
    layout = F.array(*[F.lit(c) for c in classes])
    return records.select(
        "id",
        F.concat_ws("/", F.lit(base), "img_local_path").alias("full_path"),
        multi_hot(F.col("themes"), layout).alias("label"),
    )


def prepare(records: DataFrame, params: LabelParams, base: str = "") -> tuple[DataFrame, list[str]]:
    """Pruned, complete, encoded and split rows, and the class list."""
    kept = usable(records)
    classes = class_list(kept, params.top_labels)
    rows = plain_split(
        encode(kept, classes, base), "id", params.seed, params.holdout_share, params.test_share_of_holdout
    )
    return rows, classes


def positives(rows: DataFrame) -> DataFrame:
    """Positive and total rows per class position."""
    return (
        rows.select(F.posexplode("label").alias("pos", "hit"))
        .groupBy("pos")
        .agg(F.sum("hit").alias("n_pos"), F.count(F.lit(1)).alias("n_rows"))
    )


def class_weights(train: DataFrame, classes: Sequence[str], smoothing: float) -> DataFrame:
    """Negatives over positives per class of the training rows."""
    names = F.array(*[F.lit(c) for c in classes])
    weight = (F.col("n_rows") - F.col("n_pos")) / (F.col("n_pos") + smoothing)
    return positives(train).select(
        "pos", F.element_at(names, F.col("pos") + 1).alias("label"), "n_pos", weight.alias("pos_weight")
    )


def row_weights(train: DataFrame, n_classes: int, smoothing: float) -> DataFrame:
    """Weight of a row: that of its rarest kept label, 0 without one."""
    by_class = positives(train).select("pos", (1.0 / (F.col("n_pos") + smoothing)).alias("w"))
    # One value per class, so the list is as long as the class list.
    listed = by_class.agg(F.array_sort(F.collect_list(F.struct("pos", "w"))).alias("l")).select(
        F.transform("l", lambda x: x["w"])
    )
    weights = listed.scalar()
    held = [F.element_at("label", i) * F.element_at(weights, i) for i in range(1, n_classes + 1)]
    return train.withColumn("sample_weight", F.coalesce(F.greatest(F.lit(0.0), *held), F.lit(0.0)))


def uniform_draw(number: Column, seed: int) -> Column:
    """Repeatable uniform value in [0, 1) from a row number."""
    word = F.substring(F.md5(F.concat(F.lit(f"{seed}-"), number.cast("string"))), 1, 13)
    return F.conv(word, 16, 10).cast("double") / F.lit(float(1 << 52))


def weighted_resample(rows: DataFrame, key: str, weight: str, n: int, seed: int) -> DataFrame:
    """``n`` draws with replacement, proportional to ``weight``: (draw, key).

    Every row owns an interval of the cumulative weight, scaled to length ``n``; draw j is
    a point on it. Points and intervals meet in an equi-join on the unit cell of the line;
    a row with a long interval is unfolded in two steps, chunk by chunk.
    """
    placed = running_sum(rows.filter(F.col(weight) > 0).select(key, weight), [], [key], weight, "_upto")
    total = rows.agg(F.sum(weight)).scalar()
    stretch = F.lit(float(n)) / total
    spans = placed.select(
        key, ((F.col("_upto") - F.col(weight)) * stretch).alias("_from"), (F.col("_upto") * stretch).alias("_to")
    )
    chunks = spans.withColumn(
        "_chunk", F.explode(F.sequence(F.floor(F.col("_from") / COPY_CHUNK), F.floor(F.col("_to") / COPY_CHUNK)))
    )
    low = F.greatest(F.floor("_from"), F.col("_chunk") * COPY_CHUNK)
    high = F.least(F.floor("_to"), F.col("_chunk") * COPY_CHUNK + (COPY_CHUNK - 1))
    cells = chunks.withColumn("_cell", F.explode(F.sequence(low, high)))
    spark = rows.sparkSession
    draws = spark.range(n).select(
        F.col("id").alias("draw"), (uniform_draw(F.col("id"), seed) * n).alias("_at")
    ).withColumn("_cell", F.floor("_at"))
    hit = (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    return draws.join(cells, "_cell").filter(hit).select("draw", key)


def predicted(rows: DataFrame, threshold: float) -> DataFrame:
    """0/1 decision per class from raw scores."""
    return rows.withColumn("predicted", decide(F.col("scores"), threshold))


def cells(rows: DataFrame) -> DataFrame:
    """One row per (record, class): position, truth, decision, score."""
    zipped = F.arrays_zip("label", "predicted", "scores")
    return rows.select("id", F.posexplode(zipped).alias("pos", "c")).select(
        "id", "pos", F.col("c.label").alias("truth"), F.col("c.predicted").alias("guess"), F.col("c.scores").alias("score")
    )


def cell_accuracy(rows: DataFrame) -> DataFrame:
    """Share of right cells and number of cells."""
    right = (F.col("truth") == F.col("guess")).cast("int")
    return cells(rows).agg(F.avg(right).alias("accuracy"), F.count(F.lit(1)).alias("n_cells"))


def _scores(tp: Column, guessed: Column, true: Column) -> tuple[Column, Column, Column]:
    precision, recall = ratio(tp, guessed, 0.0), ratio(tp, true, 0.0)
    return precision, recall, ratio(2 * tp, guessed + true, 0.0)


def label_report(rows: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and support per label, and the four averages. 0/0 counts as 0."""
    names = F.array(*[F.lit(c) for c in classes])
    tp, guessed, true = F.sum(F.col("truth") * F.col("guess")), F.sum("guess"), F.sum("truth")
    counts = cells(rows).groupBy("pos").agg(tp.alias("tp"), guessed.alias("g"), true.alias("t"))
    p, r, f = _scores(F.col("tp"), F.col("g"), F.col("t"))
    per_label = counts.select(
        F.element_at(names, F.col("pos") + 1).alias("label"),
        p.alias("precision"), r.alias("recall"), f.alias("f1_score"), F.col("t").alias("support"),
        F.col("tp"), F.col("g"),
    )
    shown = ("label", "precision", "recall", "f1_score", "support")
    mp, mr, mf = _scores(F.sum("tp"), F.sum("g"), F.sum("support"))
    micro = per_label.agg(mp.alias("precision"), mr.alias("recall"), mf.alias("f1_score"), F.sum("support").alias("support"))
    macro = per_label.agg(*[F.avg(c).alias(c) for c in shown[1:4]], F.sum("support").alias("support"))
    w = F.col("support")
    weighted = per_label.agg(
        *[ratio(F.sum(F.col(c) * w), F.sum(w), 0.0).alias(c) for c in shown[1:4]], F.sum(w).alias("support")
    )
    one = F.array_size
    hits = one(F.filter(F.zip_with("label", "predicted", lambda a, b: a * b), lambda x: x == 1))
    g = one(F.filter("predicted", lambda x: x == 1))
    t = one(F.filter("label", lambda x: x == 1))
    sp, sr, sf = _scores(hits, g, t)
    samples = rows.agg(
        F.avg(sp).alias("precision"), F.avg(sr).alias("recall"), F.avg(sf).alias("f1_score"),
        F.sum(t).cast("bigint").alias("support"),
    )
    table = per_label.select(*shown)
    for name, part in (("micro avg", micro), ("macro avg", macro), ("weighted avg", weighted), ("samples avg", samples)):
        table = table.unionByName(part.withColumn("label", F.lit(name)).select(*shown))
    return table


def weighted_log_loss(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Binary cross-entropy per cell with the class's positive weight, averaged over cells."""
    by_class = weights.select("pos", "pos_weight")
    listed = by_class.agg(F.array_sort(F.collect_list(F.struct("pos", "pos_weight"))).alias("l")).select(
        F.transform("l", lambda x: x["pos_weight"])
    )
    chance = sigmoid(F.col("score"))
    weight = F.element_at(listed.scalar(), F.col("pos") + 1)
    loss = -(weight * F.col("truth") * F.log(chance) + (1 - F.col("truth")) * F.log(1 - chance))
    return cells(rows).agg(F.avg(loss).alias("loss"))


def argmax_examples(rows: DataFrame, classes: Sequence[str], n: int) -> DataFrame:
    """First ``n`` records by id whose top label is right, and first ``n`` where it is wrong."""
    names = F.array(*[F.lit(c) for c in classes])
    at = F.array_position("scores", F.array_max("scores")).cast("int")
    true_names = F.filter(
        F.transform("label", lambda hit, i: F.when(hit == 1, F.element_at(names, i + 1))), lambda x: x.isNotNull()
    )
    scored = rows.select(
        "id",
        F.element_at(names, at).alias("top_label"),
        (F.element_at("label", at) == 1).alias("correct"),
        F.when(F.size(true_names) > 0, F.array_join(true_names, ", ")).otherwise("None (Filtered)").alias("true_labels"),
    )
    # Two top-n reports; each is a per-task top-n merged once.
    right = scored.filter("correct").orderBy("id").limit(n)
    wrong = scored.filter("NOT correct").orderBy("id").limit(n)
    return right.unionByName(wrong)


# -- training logs --------------------------------------------------------------------------


def epoch_metrics(lines: DataFrame) -> DataFrame:
    """Epoch table per run from log lines (run_id, line_no, line); n-th train meets n-th val."""

    def found(pattern: str, side: str) -> Column:
        loss, accuracy = (F.regexp_extract("line", pattern, i).try_cast("double") for i in (1, 2))
        return F.when(loss.isNotNull(), F.struct(F.lit(side).alias("side"), loss.alias("loss"), accuracy.alias("acc")))

    hit = F.coalesce(found(TRAIN_LINE, "train"), found(VAL_LINE, "val"))
    parsed = materialise(
        lines.select("run_id", "line_no", hit.alias("hit")).filter("hit IS NOT NULL").select("run_id", "line_no", "hit.*"),
        "log_lines",
    )
    placed = row_numbers(parsed, ["run_id", "side"], ["line_no"], "epoch")

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column))).alias(f"{side}_{column}")

    both = placed.groupBy("run_id", "epoch").agg(
        of("train", "loss"), of("train", "acc"), of("val", "loss"), of("val", "acc"), F.count(F.lit(1)).alias("_sides")
    )
    epochs = materialise(both.filter("_sides = 2").drop("_sides"), "epochs")
    best = lowest_before(epochs, ["run_id"], ["epoch"], "val_loss", "best_before")
    return best.withColumn(
        "improved", F.col("best_before").isNull() | (F.col("val_loss") < F.col("best_before"))
    )


def best_epochs(epochs: DataFrame) -> DataFrame:
    """Epoch with the lowest validation loss per run, the earliest on a tie."""
    order = F.struct("val_loss", "epoch")
    return epochs.groupBy("run_id").agg(
        F.min_by("epoch", order).alias("best_epoch"),
        F.min("val_loss").alias("best_val_loss"),
        F.min_by("val_acc", order).alias("val_acc_at_best"),
        F.count(F.lit(1)).alias("n_epochs"),
    )
