"""Quality rules on divergence: histograms of a document against references of its language.

Two histograms describe a document: character classes, and the common words of all known
languages (with one cell for every other word). The reference of a language is the mean histogram
of its documents that pass the base rules. A document is kept when its Jensen-Shannon distances
to the nearest reference stay under both limits. The limit of the word distance is the upper fence
of the distances of all documents that pass the base rules, as their scale depends on how often the
common words stand in the texts. Documents too short for a stable histogram are not judged by it.
Everything is DataFrame expressions; there is no Python in the tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import prepare, store

# Frequent function words by language.
COMMON_WORDS = {
    "en": "the of and to in is that for it with as was on be by this are from at or an have not".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus au sur ne se pas".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como".split(),
}
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
REPEATED_PERCENT = 50
MIN_CHARS_CLASSES = 200
MIN_WORDS_COMMON = 100
CLASS_LIMIT = 0.25
#: The word limit lies this many quartile distances over the upper quartile; quartiles need some documents.
WORD_FENCE = 1.5
MIN_DOCUMENTS = 20
DISTANCE_CELLS = 4096
#: Character classes by what removing everything else leaves; the rest of the text is the last class.
CLASSES = {"upper": "[^A-Z]+", "digit": "[^0-9]+", "symbol": r"[^#*$%&|<>!~^_={}\[\]\\/@+]+", "mark": r"[^.,;:?'\"()-]+", "beyond": r"[\x00-\x7F]+"}


def _vocabulary() -> list[str]:
    return sorted({w for words in COMMON_WORDS.values() for w in words})


def _count_in(text: Column, word: str) -> Column:
    """How often ``|word|`` stands in a text of words between bars, each with bars of its own."""
    token = f"|{word}|"
    return ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(token), F.lit("")))) / len(token.encode())).cast("double")


def _entropy_term(x: Column) -> Column:
    return F.when(x > 0, x * F.log2(x)).otherwise(0.0)


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two arrays of shares."""
    pairs = F.arrays_zip(p.alias("p"), q.alias("q"))
    term = lambda z: (
        (_entropy_term(z["p"]) + _entropy_term(z["q"])) / 2 - _entropy_term((z["p"] + z["q"]) / 2)
    )
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(pairs, F.lit(0.0), lambda a, z: a + term(z))))


def measures(docs: DataFrame) -> DataFrame:
    """Counts of each whole text, and its two histograms as counts."""
    df = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    df = df.withColumn("words", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))))
    # A 3-word window with its place; equal windows stand side by side once sorted.
    n = F.size("words")
    three = F.transform(
        F.arrays_zip(F.slice("words", 1, F.greatest(n - 2, F.lit(0))).alias("a"), F.slice("words", 2, F.greatest(n - 2, F.lit(0))).alias("b"), F.slice("words", 3, F.greatest(n - 2, F.lit(0))).alias("c")),
        lambda z, i: F.struct(F.xxhash64(z["a"], z["b"], z["c"]).alias("h"), i.alias("i")),
    )
    common = _vocabulary()
    df = df.select(
        "doc_id", "lang",
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        three.alias("windows"),
        F.array(*[F.length(F.regexp_replace("text", p, "")) for p in CLASSES.values()]).alias("classes"),
        F.concat(F.lit("|"), F.array_join(F.filter(F.transform("words", F.lower), lambda w: w.isin(common)), "||"), F.lit("|")).alias("frequent"),
    )
    df = df.withColumn("hashes", F.transform("windows", lambda z: z["h"]))
    df = df.withColumn("repeats", F.size("hashes") > F.size(F.array_distinct("hashes")))
    df = df.withColumn("ordered", F.when(F.col("repeats"), F.sort_array("windows")))
    m = F.size("ordered")
    # Of windows side by side with equal hashes both are repeated; their places, in order, cover up to three words each.
    df = df.withColumn(
        "places",
        F.when(F.col("repeats"), F.sort_array(F.array_distinct(F.flatten(F.transform(
            F.filter(F.arrays_zip(F.slice("ordered", 1, m - 1).alias("x"), F.slice("ordered", 2, m - 1).alias("y")), lambda z: z["x"]["h"] == z["y"]["h"]),
            lambda z: F.array(z["x"]["i"], z["y"]["i"]),
        ))))),
    )
    covered = F.aggregate(
        F.arrays_zip(F.slice("places", 1, F.size("places") - 1).alias("x"), F.slice("places", 2, F.size("places") - 1).alias("y")),
        F.lit(3).cast("long"),
        lambda a, z: a + F.least(F.lit(3), z["y"] - z["x"]),
    )
    df = df.withColumn("n_repeat_words", F.when(F.col("repeats"), covered).otherwise(F.lit(0)).cast("long"))
    counts = [_count_in(F.col("frequent"), w) for w in common]
    return df.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", F.array(*counts).alias("common"))


def _shares(df: DataFrame) -> DataFrame:
    """Histograms as shares of their total, with the rest in a last cell."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    spread = lambda c, n: F.when(n > 0, F.concat(F.transform(c, lambda x: x / n), F.array((n - total(c)) / n)))
    return df.withColumn("class_shares", spread(F.col("classes"), F.col("word_chars"))).withColumn("word_shares", spread(F.col("common"), F.col("n_words")))


def _mean(column: str, size: int) -> Column:
    return F.array(*[F.avg(F.element_at(column, k + 1)) for k in range(size)]).alias(column)


def word_limit(judged: DataFrame) -> float | None:
    """Upper fence of the word distances of all documents that pass the base rules and are long enough;
    equal histograms count once, so that copies do not narrow it. None with too few."""
    own = judged.where(~F.col("base_failed") & (F.col("n_words") >= MIN_WORDS_COMMON) & F.col("word_distance").isNotNull())
    cells = own.select(F.floor(F.col("word_distance") * DISTANCE_CELLS).cast("int").alias("cell"), "histogram").distinct()
    # At most DISTANCE_CELLS + 1 rows, whatever the input.
    counts = sorted((r["cell"], r["n"]) for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in counts)
    if total < MIN_DOCUMENTS:
        return None
    quartiles = []
    for part in (1, 3):
        before = 0
        for cell, n in counts:
            before += n
            if 4 * before >= part * total:
                quartiles.append((cell + 0.5) / DISTANCE_CELLS)
                break
    lower, upper = quartiles
    return upper + WORD_FENCE * (upper - lower)


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts, base_failed, kept and the two distances.

    A null or empty text has no words, so it fails the base rules. A document without a known
    language, or of a language without a reference, is compared with all references; the nearest
    counts for every document, so a wrong label does no harm. With no reference at all (no document
    passes the base rules) nothing is judged by distance; with fewer than MIN_DOCUMENTS long enough
    for it, nothing by words. Repeated rows are judged one by one.
    Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    found, _ = store(measures(docs), "quality-measures")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    found = _shares(found).withColumn("base_failed", base)
    sizes = {"class_shares": len(CLASSES) + 1, "word_shares": len(_vocabulary()) + 1}
    # One row for each known language, so the join below is with a handful of rows.
    references = (
        found.where(~F.col("base_failed") & F.col("lang").isin(*COMMON_WORDS))
        .groupBy("lang").agg(*[_mean(c, n) for c, n in sizes.items()])
        .agg(F.collect_list(F.struct("class_shares", "word_shares")).alias("references"))
    )
    judged = found.join(F.broadcast(references))
    nearest = lambda c: F.array_min(F.transform("references", lambda r: js_distance(F.col(c), r[c])))
    judged = judged.withColumn("class_distance", nearest("class_shares")).withColumn("word_distance", nearest("word_shares"))
    judged, _ = store(
        judged.select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance",
            F.xxhash64("n_words", "common").alias("histogram"),
        ),
        "quality-distances",
    )
    limit = F.lit(word_limit(judged)).cast("double")
    strange = (
        ((F.col("word_chars") >= MIN_CHARS_CLASSES) & (F.col("class_distance") > CLASS_LIMIT))
        | ((F.col("n_words") >= MIN_WORDS_COMMON) & (F.col("word_distance") > limit))
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(strange, F.lit(False))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"
    )
