"""Multi-label jobs. Parts play the labelled records: words of the name and the brand are
the label list; scores are a fixed function of the id and the true labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.common import Catalogue, r
from ledgerline.operators import labels as lb
from ledgerline.params import LabelParams
from ledgerline.session import materialise
from ledgerline.sources import files, roles

catalogue = Catalogue()
P = LabelParams()
DRAW_SEED = 7

RECORDS_SQL = """rec as (select p_partkey as id, p_type as category,
 case when p_size = 50 then null else concat('images/', p_partkey, '.jpg') end as img_local_path,
 case when p_size = 49 then null else list_append(string_split(p_name, ' '), p_brand) end as themes from part)"""

KEPT_SQL = f"""{RECORDS_SQL}, kept as (select id, img_local_path, themes from rec where img_local_path is not null and themes is not null),
 lc as (select label, count(*) as n from (select unnest(themes) as label from kept) group by 1),
 cls as materialized (select label, row_number() over (order by n desc, label) - 1 as pos from lc order by n desc, label limit {P.top_labels})"""

CELLS_SQL = f"""{KEPT_SQL}, raw as (select id, pos, label, list_contains(themes, label)::int as truth from kept, cls),
 cell as materialized (select id, pos, label, truth, ((id * 31 + pos * 17) % 23 - 11) / 5.0e0 + 1.5e0 * truth as score from raw),
 gc as materialized (select *, (1 / (1 + exp(-score)) > 0.5)::int as guess from cell)"""

SPLIT_SQL = f"""sp as materialized (select id, case when k <= ceil(ceil(n * {P.holdout_share}) * {P.test_share_of_holdout}) then 'test'
 when k <= ceil(n * {P.holdout_share}) then 'val' else 'train' end as split
 from (select id, row_number() over (order by md5(concat('{P.seed}-', id)), id) as k, count(*) over () as n from kept))"""

POS_SQL = f"""{CELLS_SQL}, {SPLIT_SQL}, np as materialized (select pos, label, sum(truth)::bigint as n_pos, count(*) as n_rows
 from cell join sp using (id) where split = 'train' group by 1, 2)"""

WEIGHT_SQL = f"""{POS_SQL}, rw as (select id, max(truth * (1.0e0 / (n_pos + {P.smoothing}))) as sample_weight
 from cell join sp using (id) join np using (pos) where split = 'train' group by 1)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = roles.table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_size") != 50, F.concat(F.lit("images/"), F.col("p_partkey"), F.lit(".jpg"))).alias("img_local_path"),
        F.when(F.col("p_size") != 49, F.array_append(F.split("p_name", " "), F.col("p_brand"))).alias("themes"),
    )


def scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Encoded records with raw scores per class and decisions."""
    kept = lb.usable(records(spark, sf_dir))
    classes = lb.class_list(kept, P.top_labels)
    rows = lb.encode(kept, classes)
    base = F.transform("label", lambda hit, i: ((F.col("id") * 31 + i * 17) % 23 - 11) / F.lit(5.0) + hit * F.lit(1.5))
    return lb.predicted(rows.withColumn("scores", base), P.decision), classes


@catalogue.add("w2_label_freq", f"with {KEPT_SQL} select label, n from lc order by n desc, label limit {P.top_labels}")
def label_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent labels."""
    return lb.label_counts(lb.usable(records(spark, sf_dir)), P.top_labels)


@catalogue.add(
    "w2_category_floor",
    f"with {RECORDS_SQL} select category, count(*) as n from rec where category is not null group by 1 having count(*) >= {P.category_floor}",
)
def category_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories with enough records."""
    return lb.categories_above(records(spark, sf_dir), "category", P.category_floor)


@catalogue.add(
    "w2_multihot",
    f"with {CELLS_SQL} select id, concat('data/', any_value(img_local_path)) as full_path, string_agg(truth, ',' order by pos) as label"
    " from cell join kept using (id) group by 1",
)
def multihot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path and 0/1 label vector, shown as text."""
    kept = lb.usable(records(spark, sf_dir))
    rows = lb.encode(kept, lb.class_list(kept, P.top_labels), "data")
    return rows.withColumn("label", F.array_join(F.transform("label", lambda x: x.cast("string")), ","))


@catalogue.add("w2_split", f"with {KEPT_SQL}, {SPLIT_SQL} select id, split from sp")
def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """70/15/15 split."""
    rows, _ = lb.prepare(records(spark, sf_dir), P)
    return rows.select("id", "split")


def train_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    rows, classes = lb.prepare(records(spark, sf_dir), P)
    return materialise(rows.filter(F.col("split") == "train"), "train_labels"), classes


@catalogue.add(
    "w2_class_weights",
    f"with {POS_SQL} select pos::int as pos, label, n_pos, {r(f'(n_rows - n_pos) / (n_pos + {P.smoothing})')} as pos_weight from np",
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives over positives per class, training rows."""
    train, classes = train_rows(spark, sf_dir)
    return lb.class_weights(train, classes, P.smoothing)


@catalogue.add("w2_row_weights", f"with {WEIGHT_SQL} select id, {r('sample_weight')} as sample_weight from rw")
def row_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of each training row."""
    train, classes = train_rows(spark, sf_dir)
    return lb.row_weights(train, len(classes), P.smoothing).select("id", "sample_weight")


@catalogue.add(
    "w2_resample",
    f"""with {WEIGHT_SQL}, pw as (select * from rw where sample_weight > 0), n as (select count(*) as n, sum(sample_weight) as total from rw),
 iv as (select id, (c - sample_weight) * n / total as lo, c * n / total as hi from
 (select id, sample_weight, sum(sample_weight) over (order by id rows unbounded preceding) as c from pw), n),
 dr as (select j as draw, ('0x' || substr(md5(concat('{DRAW_SEED}-', j)), 1, 13))::bigint / 4503599627370496.0e0 * n as spot from n, range(n) t(j))
 select draw, id from dr join iv on spot >= lo and spot < hi""",
)
def resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many weighted draws with replacement as training rows."""
    train, classes = train_rows(spark, sf_dir)
    rows = materialise(lb.row_weights(train, len(classes), P.smoothing), "weights")
    return lb.weighted_resample(rows, "id", "sample_weight", rows.count(), DRAW_SEED)


@catalogue.add("w2_decisions", f"with {CELLS_SQL} select id, string_agg(guess, ',' order by pos) as predicted from gc group by 1")
def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions per record, shown as text."""
    rows, _ = scored(spark, sf_dir)
    return rows.select("id", F.array_join(F.transform("predicted", lambda x: x.cast("string")), ",").alias("predicted"))


@catalogue.add(
    "w2_cell_accuracy",
    f"with {CELLS_SQL} select {r('avg((truth = guess)::int)')} as accuracy, count(*) as n_cells from gc",
)
def cell_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of right label cells."""
    return lb.cell_accuracy(scored(spark, sf_dir)[0])


def _safe(num: str, den: str) -> str:
    return f"case when {den} > 0 then {num} / {den} else 0 end"


@catalogue.add(
    "w2_label_report",
    f"""with {CELLS_SQL}, c as materialized (select label, sum(truth * guess) as tp, sum(guess) as g, sum(truth) as t from gc group by 1),
 s as (select label, {_safe('tp', 'g')} as p, {_safe('tp', 't')} as rc, {_safe('2 * tp', '(g + t)')} as f, t, tp, g from c),
 x as (select id, sum(truth * guess) as tp, sum(guess) as g, sum(truth) as t from gc group by 1)
 select label, {r('p')} as precision, {r('rc')} as recall, {r('f')} as f1_score, t::bigint as support from s
 union all select 'micro avg', {r(_safe('sum(tp)', 'sum(g)'))}, {r(_safe('sum(tp)', 'sum(t)'))}, {r(_safe('2 * sum(tp)', '(sum(g) + sum(t))'))}, sum(t)::bigint from c
 union all select 'macro avg', {r('avg(p)')}, {r('avg(rc)')}, {r('avg(f)')}, sum(t)::bigint from s
 union all select 'weighted avg', {r('sum(p * t) / sum(t)')}, {r('sum(rc * t) / sum(t)')}, {r('sum(f * t) / sum(t)')}, sum(t)::bigint from s
 union all select 'samples avg', {r(f"avg({_safe('tp', 'g')})")}, {r(f"avg({_safe('tp', 't')})")}, {r(f"avg({_safe('2 * tp', '(g + t)')})")}, sum(t)::bigint from x""",
)
def label_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification report per label with averages."""
    rows, classes = scored(spark, sf_dir)
    return lb.label_report(rows, classes)


@catalogue.add(
    "w2_logloss",
    f"""with {CELLS_SQL}, {SPLIT_SQL}, np as (select pos, sum(truth) as n_pos, count(*) as n_rows from cell join sp using (id) where split = 'train' group by 1),
 w as (select pos, (n_rows - n_pos) / (n_pos + {P.smoothing}) as pw from np)
 select {r('avg(-(pw * truth * ln(1 / (1 + exp(-score))) + (1 - truth) * ln(1 - 1 / (1 + exp(-score)))))')} as loss from gc join w using (pos)""",
)
def logloss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted log loss over all cells."""
    rows, classes = scored(spark, sf_dir)
    train, _ = train_rows(spark, sf_dir)
    return lb.weighted_log_loss(rows, lb.class_weights(train, classes, P.smoothing))


@catalogue.add(
    "w2_argmax_examples",
    f"""with {CELLS_SQL}, top as (select *, row_number() over (partition by id order by score desc, pos) as k from gc),
 tl as (select id, coalesce(string_agg(label, ', ' order by pos) filter (where truth = 1), 'None (Filtered)') as true_labels from gc group by 1),
 ex as (select id, label as top_label, truth = 1 as correct, true_labels, row_number() over (partition by truth order by id) as n from top join tl using (id) where k = 1)
 select id, top_label, correct, true_labels from ex where n <= {P.examples}""",
)
def argmax_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First right and first wrong top labels."""
    rows, classes = scored(spark, sf_dir)
    return lb.argmax_examples(rows, classes, P.examples)


@catalogue.add(
    "w2_sample",
    f"with {RECORDS_SQL} select id, category from rec order by md5(concat('{P.seed}-', id)), id limit 100",
)
def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniform sample of 100 records."""
    return files.uniform_sample(records(spark, sf_dir), 100, P.seed, "id").select("id", "category")


# -- training logs: one run per user, two epoch lines per event ---------------------------------

LOGS_SQL = """ep as (select user_id as run_id, row_number() over (partition by user_id order by event_id) as epoch,
 round(value / 100, 4) as train_loss, json_extract(props, '$.k')::double / 100 as train_acc, round(value / 50, 4) as val_loss,
 1 - json_extract(props, '$.k')::double / 100 as val_acc from events),
 bb as (select *, min(val_loss) over (partition by run_id order by epoch rows between unbounded preceding and 1 preceding) as best_before from ep)"""


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of training runs, with other lines between them."""
    events = roles.table(spark, sf_dir, "events")
    share = F.get_json_object("props", "$.k").cast("double") / 100
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")

    def line(template: str, *values):
        return F.concat(stamp, F.lit(" [INFO] "), F.format_string(template, *values))

    loss, val = F.round(F.col("value") / 100, 4), F.round(F.col("value") / 50, 4)
    texts = F.array(
        line("Train Loss: %.4f | Train Acc: %.4f", loss, share),
        line("Val Loss:   %.4f | Val Acc:   %.4f", val, 1 - share),
        line("Saving model after %s", F.col("event_type")),
    )
    return events.select(
        F.col("user_id").alias("run_id"), F.col("event_id"), F.posexplode(texts).alias("at", "line")
    ).select("run_id", (F.col("event_id") * 3 + F.col("at")).alias("line_no"), "line")


@catalogue.add(
    "w2_log_epochs",
    f"""with {LOGS_SQL} select run_id, epoch, {r('train_loss')} as train_loss, {r('train_acc')} as train_acc, {r('val_loss')} as val_loss,
 {r('val_acc')} as val_acc, {r('best_before')} as best_before, best_before is null or val_loss < best_before as improved from bb""",
)
def log_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch metrics mined from log lines, with the best loss so far."""
    return lb.epoch_metrics(log_lines(spark, sf_dir))


@catalogue.add(
    "w2_best_epoch",
    f"""with {LOGS_SQL} select run_id, arg_min(epoch, val_loss * 1000000 + epoch * 0.0001) as best_epoch, {r('min(val_loss)')} as best_val_loss,
 {r('arg_min(val_acc, val_loss * 1000000 + epoch * 0.0001)')} as val_acc_at_best, count(*) as n_epochs from ep group by 1""",
)
def best_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best epoch per run."""
    return lb.best_epochs(lb.epoch_metrics(log_lines(spark, sf_dir)))
