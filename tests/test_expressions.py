from pyspark.sql import functions as F

from ledgerline.functions import expr, text


def values(spark, schema, rows, *columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*columns).collect()]


def test_season_year(spark):
    got = values(spark, "s string", [("W17",), ("S99",), ("S5",), (None,), ("x1y49",), ("50",), ("none",)], expr.season_year(F.col("s")))
    assert [g[0] for g in got] == [2017, 1999, None, None, 2049, 1950, None]


def test_numbers_and_sentinels(spark):
    got = values(
        spark, "s string", [("38",), ("XS",), ("NaN",), (None,)],
        expr.numeric_or_null(F.col("s")), expr.sentinel_to_null(F.col("s")),
    )
    assert got == [(38.0, "38"), (None, "XS"), (None, None), (None, None)]


def test_whole_days_round_down(spark):
    rows = [("2018-01-01 00:00:00", "2017-12-31 12:00:00"), ("2018-01-01 00:00:00", "2018-01-01 06:00:00")]
    days = expr.whole_days(F.to_timestamp("a"), F.to_timestamp("b"))
    assert [g[0] for g in values(spark, "a string, b string", rows, days)] == [0, -1]


def test_clips_keep_null(spark):
    rows = [(-5.0,), (None,), (30.0,)]
    got = values(spark, "x double", rows, expr.at_least(F.col("x"), 0.0), expr.at_most(F.col("x"), 20.0))
    assert got == [(0.0, -5.0), (None, None), (30.0, 20.0)]


def test_guarded_ratio(spark):
    rows = [(1.0, 2.0), (1.0, 0.0), (1.0, None)]
    got = values(spark, "a double, b double", rows, expr.ratio(F.col("a"), F.col("b"), 1.0))
    assert [g[0] for g in got] == [0.5, 1.0, 1.0]


def test_brand_flag_names():
    assert expr.brand_flag_name("STONES and BONES") == "buys_stones__bones"
    assert expr.brand_flag_name("Tommy Hilfiger") == "buys_tommy_hilfiger"
    assert expr.brand_flag_name("adidas") == "buys_adidas"


def test_multi_hot_ignores_unknown(spark):
    classes = F.array(F.lit("a"), F.lit("b"))
    got = values(spark, "t array<string>", [(["b", "z"],), ([],)], expr.multi_hot(F.col("t"), classes))
    assert [g[0] for g in got] == [[0, 1], [0, 0]]


def test_reasoning_is_removed(spark):
    rows = [
        ("<think>a\nb</think> answer ",), ("kept <think>cut",), ("<think>only",), ("plain ",), (None,),
        ("<think>x</think>a<think>y</think>b",),
    ]
    got = [g[0] for g in values(spark, "t string", rows, text.strip_reasoning(F.col("t")))]
    assert got == ["answer", "kept", "", "plain", "", "ab"]


def test_json_names(spark):
    rows = [('{"x": 5, "a": 3}',), ('["p", "q"]',), ("{bad",), ("",), (None,)]
    got = [g[0] for g in values(spark, "t string", rows, text.json_names(F.col("t")))]
    assert got == [["x", "a"], ["p", "q"], [], [], []]


def test_number_formats_round_half_even(spark):
    got = values(
        spark, "x double", [(0.625,), (0.635,)], text.percent0(F.col("x")), text.money(F.col("x") * 100), text.thousands(F.col("x") * 1e7)
    )
    assert got == [("62%", "$62.50", "6,250,000"), ("64%", "$63.50", "6,350,000")]


def test_first_filled_and_shorten(spark):
    got = values(
        spark, "a string, b string", [("", "second"), (None, None)], text.first_filled(F.col("a"), F.col("b")),
        text.shorten(F.col("b"), 3),
    )
    assert got == [("second", "sec..."), ("", None)]


def test_percent_label(spark):
    assert values(spark, "x double", [(0.3667,)], expr.percent_label(F.col("x"))) == [("36.67%",)]


def test_exact_rounding_equals_python(spark):
    import random

    draw = random.Random(6)
    numbers = [0.61235, 0.57875, 2.5, 3.5, -2.5, 0.125, 0.375, 62.5, 1e-9, 0.0]
    numbers += [round(draw.uniform(-3, 100), 5) for _ in range(2000)] + [k / 1000 + 0.0005 for k in range(500)]
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    for digits in (0, 2, 4):
        got = df.select("x", expr.round_exact(F.col("x"), digits).alias("r")).collect()
        assert [(r.x, r.r) for r in got if r.r != round(r.x, digits)] == []
