import pytest
from pyspark.sql import functions as F

from ledgerline.session import materialise, shared_folder
from ledgerline.sources import files, schemas


def test_csv_round_trip(spark, shop, tmp_path):
    train, test, tx = shop
    paths = [str(tmp_path / n) for n in ("train", "test", "tx")]
    for df, path in zip((train, test, tx), paths):
        files.write_csv(df, path)
    got_train, got_test, got_tx = files.read_datasets(spark, *paths)
    assert got_train.count() == 5 and got_test.count() == 2 and got_tx.count() == 11
    kinds = dict(got_tx.dtypes)
    assert kinds["order_date"] == "timestamp" and kinds["sale_revenue"] == "double" and kinds["prod_size"] == "string"
    assert "prod_print" not in kinds  # absent in the file, added by the contract


def test_missing_files_are_all_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError) as error:
        files.read_datasets(spark, str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path))
    assert "train" in str(error.value) and "test" in str(error.value) and "transactions" not in str(error.value)


def test_submission_is_clipped(spark, tmp_path):
    df = spark.createDataFrame([(1, -5.0), (2, 3.0)], "cust_id bigint, prediction double")
    path = files.write_csv(files.submission(df), str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(path)
    assert {(r.cust_id, r.prediction) for r in back.collect()} == {("1", "0.0"), ("2", "3.0")}


def test_parquet_rebuild_replaces(spark, tmp_path):
    path = str(tmp_path / "store")
    files.rebuild(spark.range(5), path)
    assert files.rebuild(spark.range(2), path).count() == 2


def test_upsert_latest_wins(spark):
    stored = spark.createDataFrame([(1, "old"), (2, "stay")], "k int, v string")
    changes = spark.createDataFrame([(1, "first", 1), (1, "second", 2), (3, "new", 1)], "k int, v string, _version int")
    assert {tuple(r) for r in files.upsert_latest(stored, changes, "k").collect()} == {(1, "second"), (2, "stay"), (3, "new")}


def test_json_records(spark, tmp_path):
    path = tmp_path / "figures.json"
    path.write_text('[{"id": 1, "themes": ["a"], "img_local_path": "x.jpg", "extra": 1}, {"id": 2, "themes": null}]')
    rows = files.read_figures(spark, str(path)).orderBy("id").collect()
    assert rows[0].themes == ["a"] and rows[1].themes is None and rows[1].img_local_path is None


def test_edges_keep_file_positions(spark, tmp_path):
    (tmp_path / "e.csv").write_text("source,target,action\na,b,x\nb,c,y\na,b,z\n")
    got = {(r.source, r.action): r.pos for r in files.read_edges(spark, str(tmp_path / "e.csv")).collect()}
    assert got == {("a", "x"): 0, ("b", "y"): 1, ("a", "z"): 2}


def test_node_metrics_with_blank_in_names(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Id,Label,Degree,weighted indegree\nn1,N,3,2\n")
    row = files.read_node_metrics(spark, str(tmp_path / "m.csv")).first()
    assert row["weighted indegree"] == 2.0 and row.Degree == 3


def test_named_and_first_items(spark):
    rows = [(3, "c"), (1, " "), (2, None), (4, "d")]
    df = spark.createDataFrame(rows, "appid bigint, name string")
    assert [r.appid for r in files.first_items(df, 1).collect()] == [3]


def test_sample_is_repeatable(spark):
    df = spark.range(50)
    first = {r.id for r in files.uniform_sample(df, 10, 1, "id").collect()}
    assert len(first) == 10 and first == {r.id for r in files.uniform_sample(df.repartition(7), 10, 1, "id").collect()}


def test_written_steps_go_to_the_shared_folder(spark):
    df = materialise(spark.range(3).withColumn("x", F.lit("a")), "probe")
    assert df.count() == 3
    assert df.inputFiles()[0].split("//")[-1].startswith(shared_folder(spark).rstrip("/"))


def test_schemas_parse(spark):
    for name in ("TRAIN", "TEST", "TRANSACTIONS", "FIGURES", "ITEMS", "REVIEWS", "NODES", "EDGES", "NODE_METRICS", "EDGE_WEIGHTS"):
        assert spark.createDataFrame([], getattr(schemas, name)).columns


def test_figures_one_record_per_line(spark, tmp_path):
    from ledgerline.sources import schemas

    first = schemas.FIGURES.fieldNames()[0] if hasattr(schemas.FIGURES, "fieldNames") else schemas.FIGURES.split()[0]
    path = tmp_path / "figures.jsonl"
    path.write_text("".join('{"%s": null}\n' % first for _ in range(5)))
    assert files.read_figures(spark, str(path), layout="lines").count() == 5
    with pytest.raises(ValueError):
        files.read_figures(spark, str(path), layout="rows")
