"""Descriptions read what they describe once."""

import uuid

import pytest

from ledgerline.operators import profile


def test_describe_reads_its_input_once(spark, tmp_path):
    folder = str(tmp_path)

    def read(batches):
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        yield from batches

    df = spark.range(8, numPartitions=2).selectExpr("id", "cast(id as double) as x").mapInArrow(read, "id long, x double")
    got = {r.feature: r for r in profile.describe(df, ["x"]).collect()}
    assert (got["x"].n, got["x"].q25, got["x"].q50, got["x"].q75) == (8, 1.75, 3.5, 5.25)
    assert got["x"]["mean"] == pytest.approx(3.5)
    assert len(list(tmp_path.iterdir())) == 2
