"""Mixing sources to target weights by hierarchical budgeting.

A token budget is dealt down a tree of domain, language and source. Every node deals its budget to
its children by weight; what a child cannot use (its epochs are used up) goes to its siblings, and
only what a whole family cannot use was never given to it, so it stays with the relatives of its
ancestor. A leaf with budget for more than one epoch repeats all its documents, and takes a prefix
of the last epoch's seeded order. Everything is DataFrame expressions; no Python runs in the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import prepare, store

SEED = 20240
MAX_EPOCHS = 3
BUDGET_PERCENT = 80
LANGUAGE_WEIGHTS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}
DOMAIN_WEIGHTS = {"domain0": 3.0, "domain1": 2.0, "domain2": 2.0, "domain3": 1.0}
DEFAULT_WEIGHT = 1.0
DOMAINS = 4
#: Documents of a leaf are first summed in this many cells of their seeded order.
CELL_DIGITS = 3


def default_domain() -> Column:
    """Domain of a source: the number in its name, modulo ``DOMAINS``; names without one are domain0."""
    number = F.coalesce(F.regexp_extract("source", "([0-9]{1,9})", 1).try_cast("int"), F.lit(0))
    return F.concat(F.lit("domain"), (number % DOMAINS).cast("string"))


def _weight(column: str, weights: dict[str, float]) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for name, value in weights.items():
        out = F.when(F.col(column) == name, F.lit(value)).otherwise(out)
    return out


def _deal(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Deal ``total`` of each family by ``weight``, no child above ``room``: the level at which the
    children of small room per weight are full and the rest share by weight."""
    family = Window.partitionBy(*parent)
    ordered = family.orderBy(F.col("room") / F.col("weight"), name)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    df = nodes.withColumn("full", F.coalesce(F.sum("room").over(before), F.lit(0.0)))
    df = df.withColumn("rest", F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    df = df.withColumn("level", (F.col("total") - F.col("full")) / F.col("rest"))
    # The first child in that order whose room is above its share; from there on all share alike.
    df = df.withColumn("cut", F.min(F.when(F.col("level") * F.col("weight") <= F.col("room"), F.struct((F.col("room") / F.col("weight")).alias("o"), F.col(name).alias("n"), "level"))).over(family))
    share = F.when(F.col("cut").isNull(), F.col("room")).otherwise(F.least(F.col("room"), F.col("cut.level") * F.col("weight")))
    return df.withColumn("budget", share).drop("full", "rest", "level", "cut")


def budgets(leaves: DataFrame, total: Column, max_epochs: int, domain_weights: dict, language_weights: dict, source_weights: dict) -> DataFrame:
    """(domain, lang, source, supply, budget) from (domain, lang, source, supply)."""
    leaves = leaves.withColumn("room", (F.col("supply") * max_epochs).cast("double"))
    languages = leaves.groupBy("domain", "lang").agg(F.sum("room").alias("room"))
    domains = languages.groupBy("domain").agg(F.sum("room").alias("room"))
    top = domains.withColumn("weight", _weight("domain", domain_weights)).withColumn("root", F.lit(0)).join(total)
    top = _deal(top, ["root"], "domain").select("domain", F.col("budget").alias("total"))
    middle = languages.withColumn("weight", _weight("lang", language_weights)).join(top, "domain")
    middle = _deal(middle, ["domain"], "lang").select("domain", "lang", F.col("budget").alias("total"))
    low = leaves.withColumn("weight", _weight("source", source_weights)).join(middle, ["domain", "lang"])
    return _deal(low, ["domain", "lang"], "source").select("domain", "lang", "source", "supply", F.floor(F.col("budget") + 1e-6).cast("long").alias("budget"))


def mix(
    docs: DataFrame, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED, domain: Column | None = None,
    domain_weights: dict = DOMAIN_WEIGHTS, language_weights: dict = LANGUAGE_WEIGHTS, source_weights: dict | None = None,
) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch) for every document of the mixture, once for
    each epoch that takes it.

    Tokens are words apart by ASCII white space; the budget is ``budget_percent`` of all tokens. A
    leaf takes the longest run of whole documents, in the seeded order of its epoch, that fits its
    budget. Null lang or source is the name "unknown". Documents without tokens (null, empty) cost
    nothing and are taken where the order reaches them. Rows that are equal in doc_id and token
    number stand side by side and are taken or left together. Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("unknown")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("unknown")).alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    stripped = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    n_tokens = F.when(stripped == "", 0).otherwise(F.length(stripped) - F.length(F.replace(stripped, F.lit(" "), F.lit(""))) + 1)
    rows = rows.select("doc_id", (domain if domain is not None else default_domain()).alias("domain"), "lang", "source", n_tokens.cast("long").alias("n_tokens"))
    rows, _ = store(rows, "mix-rows")
    leaf = ["domain", "lang", "source"]
    leaves = rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("supply"))
    total = rows.agg((F.sum("n_tokens") * budget_percent / 100.0).alias("total"))
    dealt = budgets(leaves, total, max_epochs, domain_weights, language_weights, source_weights or {})
    dealt = dealt.withColumn("whole", F.when(F.col("supply") > 0, F.floor(F.col("budget") / F.col("supply"))).otherwise(F.lit(max_epochs)).cast("int"))
    dealt, _ = store(dealt.withColumn("left", F.col("budget") - F.col("whole") * F.col("supply")), "mix-budgets")

    joined = rows.join(dealt.select(*leaf, "whole", "left"), leaf)
    repeated = joined.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))
    # The last epoch of a leaf: cells of the seeded order are summed first, so that only one cell of
    # a leaf, the one in which the budget ends, has to be put in order.
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.col("doc_id").cast("string")))
    last = joined.where(F.col("whole") < max_epochs).withColumn("place", place).withColumn("cell", F.substring("place", 1, CELL_DIGITS))
    cells = last.groupBy(*leaf, "cell").agg(F.sum("n_tokens").alias("cell_tokens"))
    upto = Window.partitionBy(*leaf).orderBy("cell")
    cells = cells.withColumn("before", F.sum("cell_tokens").over(upto) - F.col("cell_tokens"))
    last = last.join(cells, [*leaf, "cell"])
    inside = last.where(F.col("before") + F.col("cell_tokens") <= F.col("left"))
    ends = last.where((F.col("before") + F.col("cell_tokens") > F.col("left")) & (F.col("before") <= F.col("left")))
    order = Window.partitionBy(*leaf, "cell").orderBy("place", "doc_id", "n_tokens")
    prefix = ends.withColumn("so_far", F.col("before") + F.sum("n_tokens").over(order)).where("so_far <= left")
    names = ["doc_id", *leaf, "n_tokens"]
    taken = inside.select(*names, F.col("whole").alias("epoch")).unionByName(prefix.select(*names, F.col("whole").alias("epoch")))
    return repeated.select(*names, "epoch").unionByName(taken)


def mix_sql(budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """The same mixture of the table documents in DuckDB's SQL."""

    def case(column: str, weights: dict) -> str:
        arms = " ".join(f"when {column} = '{k}' then {v}" for k, v in weights.items())
        return f"cast(case {arms} else {DEFAULT_WEIGHT} end as double)" if arms else f"cast({DEFAULT_WEIGHT} as double)"

    def deal(name: str, source: str, parent: str, key: str) -> str:
        return f"""
        {name}_w as (select *, coalesce(sum(room) over b, 0) as full_, sum(weight) over (partition by {parent}) - coalesce(sum(weight) over b, 0) as rest
            from {source} window b as (partition by {parent} order by room / weight, {key} rows between unbounded preceding and 1 preceding)),
        {name}_l as (select *, (total - full_) / rest as lev from {name}_w),
        {name}_c as (select *, first_value(case when lev * weight <= room then lev end ignore nulls) over (partition by {parent} order by room / weight, {key} rows between unbounded preceding and unbounded following) as cut from {name}_l),
        {name} as (select *, case when cut is null then room else least(room, cut * weight) end as budget from {name}_c)"""

    return f"""
    with r as (select doc_id, coalesce(lang, 'unknown') as lang, coalesce(source, 'unknown') as source,
            'domain' || cast(coalesce(try_cast(regexp_extract(coalesce(source, 'unknown'), '([0-9]{{1,9}})', 1) as int), 0) % {DOMAINS} as varchar) as domain,
            cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) as bigint) as n_tokens from documents),
        leaves as (select domain, lang, source, sum(n_tokens)::bigint as supply, cast(sum(n_tokens) * {max_epochs} as double) as room from r group by all),
        langs as (select domain, lang, sum(room) as room from leaves group by all),
        doms as (select domain, sum(room) as room from langs group by all),
        d0 as (select *, 0 as root, {case('domain', DOMAIN_WEIGHTS)} as weight, (select sum(n_tokens) * {budget_percent} / 100.0e0 from r) as total from doms),
        {deal('d1', 'd0', 'root', 'domain')},
        l0 as (select langs.*, {case('lang', LANGUAGE_WEIGHTS)} as weight, d1.budget as total from langs join d1 using (domain)),
        {deal('l1', 'l0', 'domain', 'lang')},
        s0 as (select leaves.*, {case('source', {})} as weight, l1.budget as total from leaves join l1 using (domain, lang)),
        {deal('s1', 's0', 'domain, lang', 'source')},
        b as (select domain, lang, source, supply, cast(floor(budget + 1e-6) as bigint) as budget from s1),
        w as (select *, cast(case when supply > 0 then budget // supply else {max_epochs} end as int) as whole from b),
        j as (select r.*, whole, budget - whole * supply as left_ from r join w using (domain, lang, source)),
        o as (select *, sum(n_tokens) over (partition by domain, lang, source order by md5('{seed}:' || whole || ':' || doc_id), doc_id, n_tokens) as so_far from j where whole < {max_epochs})
    select doc_id, domain, lang, source, n_tokens, epoch from (
        select doc_id, domain, lang, source, n_tokens, unnest(range(whole))::int as epoch from j
        union all select doc_id, domain, lang, source, n_tokens, whole from o where so_far <= left_)
    """
