"""Ordered operators and quantiles: the plain and the segmented way give the same rows."""

import random
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import binning, quantiles, segments, skew

WAYS = {"plain": {}, "segmented": {"group_rows": 0, "segment_rows": 7}}


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    # One key holds most rows.
    data = [(("hot" if i < 60 else draw.choice("abc")), i, draw.choice([1, 2, 2, 5, 8])) for i in range(90)]
    return data, spark.createDataFrame(data, "k string, i int, v int")


@pytest.mark.parametrize("way", WAYS)
def test_running_sum_min_and_previous(rows, way):
    data, df = rows
    total = {(r.k, r.i): r.s for r in segments.running_sum(df, ["k"], ["i"], "v", "s", **WAYS[way]).collect()}
    low = {(r.k, r.i): r.s for r in segments.lowest_before(df, ["k"], ["i"], "v", "s", **WAYS[way]).collect()}
    prev = {(r.k, r.i): r.s for r in segments.previous_value(df, ["k"], ["i"], "v", "s", **WAYS[way]).collect()}
    number = {(r.k, r.i): r.s for r in segments.row_numbers(df, ["k"], ["i"], "s", **WAYS[way]).collect()}
    for k in {d[0] for d in data}:
        seen = []
        for _, i, v in sorted(d for d in data if d[0] == k):
            assert prev[k, i] == (seen[-1] if seen else None)
            assert low[k, i] == (min(seen) if seen else None)
            seen.append(v)
            assert total[k, i] == sum(seen) and number[k, i] == len(seen)


@pytest.mark.parametrize("way", WAYS)
def test_null_keys_form_a_group(spark, way):
    df = spark.createDataFrame([(None, i, 1) for i in range(10)] + [("a", 1, 1)], "k string, i int, v int")
    got = segments.running_sum(df, ["k"], ["i"], "v", "s", **WAYS[way]).filter("k IS NULL").agg(F.max("s")).first()[0]
    assert got == 10


@pytest.mark.parametrize("way", WAYS)
def test_grouped_quantiles(rows, way):
    data, df = rows
    got = quantiles.grouped_quantiles(df, ["k"], "v", {"m": 0.5, "p": 0.2}, **WAYS[way]).collect()
    for row in got:
        values = [d[2] for d in data if d[0] == row.k]
        assert row.m == pytest.approx(statistics.median(values))
        assert row.p == pytest.approx(np.quantile(values, 0.2))


@pytest.mark.parametrize("way", WAYS)
def test_global_quantile_and_missing_values(spark, way):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (3.0,), (4.0,)], "v double")
    assert quantiles.grouped_quantiles(df, [], "v", {"p": 0.2}, **WAYS[way]).first().p == pytest.approx(1.6)


@pytest.mark.parametrize("way", WAYS)
def test_column_quantiles(spark, way):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    limit = WAYS[way].get("group_rows", 100)
    got = {r.feature: r.m for r in quantiles.column_quantiles(df, ["a", "b"], {"m": 0.5}, limit).collect()}
    assert got == {"a": 2.0, "b": None}


@pytest.mark.parametrize("way", WAYS)
def test_average_rank_shares_ties(spark, way):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0.0, 0.0, 0.0, 5.0, 2.0])], "id int, v double")
    got = {r.id: r.rank for r in quantiles.with_average_rank(df, "v", "rank", **WAYS[way]).collect()}
    assert got == {0: 2.0, 1: 2.0, 2: 2.0, 3: 5.0, 4: 4.0}


def test_salted_lookup_equals_plain_join(spark):
    draw = random.Random(5)
    left = spark.createDataFrame([(i, draw.choice(["hot"] * 8 + ["b", "c", None, "lost"])) for i in range(200)], "i int, k string")
    lookup = spark.createDataFrame([("hot", 1), ("b", 2), ("c", 3), (None, 4)], "k string, x int")
    want = sorted(map(tuple, left.join(lookup, "k", "left").select("i", "x").collect()))
    for limit in (1_000_000, 30):
        got = skew.salted_lookup(left, lookup, "k", ["x"], rows_per_task=limit).select("i", "x").collect()
        assert sorted(map(tuple, got)) == want
    inner = skew.salted_lookup(left, lookup, "k", ["x"], "inner", rows_per_task=30)
    assert inner.count() == left.join(lookup, "k").count()


def test_a_key_with_half_of_the_rows_is_spread_by_its_size(spark):
    """Heavy on the joined side, whatever the counts of the lookup say."""
    left = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    heavy = skew.heavy_hitters(left, ["k"], 1000)
    assert list(heavy.values()) == [10]
    (key,) = heavy
    assert key == spark.range(1).select(F.xxhash64(F.lit(-1).cast("long"))).first()[0]
    lookup = spark.createDataFrame([(-1, 7), (3, 8)], "k long, n int")
    plan = skew.salted_lookup(left, lookup, "k", ["n"], rows_per_task=1000)
    assert {r.n: r["count"] for r in plan.groupBy("n").count().collect()} == {7: 10_000, 8: 1, None: 9_999}


def test_salted_lookup_on_two_keys(spark):
    left = spark.createDataFrame([(i, "m", 0.0 if i < 90 else 1.0) for i in range(100)], "i int, a string, b double")
    lookup = spark.createDataFrame([("m", 0.0, 7), ("m", 1.0, 8)], "a string, b double, x int")
    got = skew.salted_lookup(left, lookup, ["a", "b"], ["x"], rows_per_task=20).groupBy("x").count().collect()
    assert {r["x"]: r["count"] for r in got} == {7: 90, 8: 10}
    assert skew.heavy_hitters(left.limit(0), ["a", "b"], 20) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=30))
def test_quantile_ways_agree(spark, numbers):
    df = spark.createDataFrame([(float(n),) for n in numbers], "v double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.9, "d": 1.0}
    plain = quantiles.grouped_quantiles(df, [], "v", probs).first()
    split = quantiles.grouped_quantiles(df, [], "v", probs, 0, 3).first()
    assert list(split) == pytest.approx(list(plain))
    assert list(plain) == pytest.approx([float(np.quantile(numbers, p)) for p in probs.values()])


def test_quantile_bins_drop_equal_edges(spark):
    df = spark.createDataFrame([(0.0,)] * 8 + [(1.0,), (2.0,)], "v double")
    edges = binning.quantile_edges(df, "v", 4)
    assert edges == [0.0, 2.0]
    table = binning.binned(df, F.col("v"), edges, [F.count(F.lit(1)).alias("n")])
    assert [r.n for r in table.collect()] == [10]


def test_fixed_bins_are_right_closed_and_keep_empty_bins(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (10,)], "v int")
    stats = [F.count(F.lit(1)).alias("n")]
    table = binning.binned(df, F.col("v"), [0, 1, 3, 5, 10], stats, include_lowest=False, zero_filled=["n"])
    assert [r.n for r in table.orderBy("bin_no").collect()] == [1, 1, 0, 1]
    closed = binning.binned(df, F.col("v"), [0, 1, 3, 5, 10], stats, include_lowest=True, zero_filled=["n"])
    assert [r.n for r in closed.orderBy("bin_no").collect()] == [2, 1, 0, 1]


def test_histogram_matches_numpy(spark):
    numbers = [0.0, 1.0, 1.5, 2.0, 7.5, 10.0, 10.0]
    df = spark.createDataFrame([(n,) for n in numbers], "v double")
    got = [r.n for r in binning.histogram(df, F.col("v"), 4).orderBy("bin_no").collect()]
    assert got == np.histogram(numbers, 4)[0].tolist()
    clipped = [r.n for r in binning.histogram(df, F.col("v"), 2, 2.0).orderBy("bin_no").collect()]
    assert clipped == np.histogram(np.minimum(numbers, 2.0), 2)[0].tolist()
