import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import SMALL
from tools.check_oracles import TABLES, keyed

QUICK = [
    "w1_tier01_core", "w1_tier05_time", "w1_tier08_brands", "w1_target_summary", "w1_error_tail", "w1_zero_sweep", "w1_split_80_20",
    "w2_label_report", "w2_resample", "w3_documents", "w3_rerank", "w4_collapse", "w4_components",
]


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.queries()) > 100


def test_names_can_be_listed_without_a_session():
    code = "import __spark_entry__ as d; assert len(d.queries()) > 100 and len(d.oracle_sql()) > 90"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(driver.__file__))


def test_entry_runs(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and "cust_id" in df.columns


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql_twin(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df = driver.queries()[name](spark, SMALL)
    cursor = db.execute(driver.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert keyed(df.columns, df.collect()) == keyed(names, cursor.fetchall())
