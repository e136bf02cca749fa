import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.llm.common import in_filter, key_filter
from creditloom.operators import registry
from creditloom.sources import readers, staging, writers

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def panel(spark, *rows):
    return spark.createDataFrame(rows, "k string, snapshot_date date, x int")


def test_csv_with_declared_schema_matches_names_not_places(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("Age,Customer_ID,extra,snapshot_date\n28_,c1,e,2024-01-01\n,c2,,not a date\n")
    df = readers.read_csv(spark, str(path), K.ATTRIBUTES_SCHEMA)
    assert df.columns == ["Customer_ID", "snapshot_date", "Age", "extra"]
    assert [tuple(r) for r in df.collect()] == [("c1", D1, "28_", "e"), ("c2", None, None, None)]
    inferred = dict(readers.read_csv(spark, str(path)).dtypes)
    assert inferred["Customer_ID"] == "string"


def test_partitioned_write_replaces_only_its_months(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_parquet(panel(spark, ("a", D1, 1), ("b", D2, 2)), path, "snapshot_date")
    writers.write_parquet(panel(spark, ("c", D2, 3)), path, "snapshot_date")
    table = spark.read.parquet(path)
    assert sorted(map(tuple, table.select("k", "snapshot_date", "x").collect())) == [("a", D1, 1), ("c", D2, 3)]
    snapshot = readers.read_snapshot(table, "2024-02-01")
    assert snapshot.count() == 1
    plan = snapshot._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert len(snapshot.inputFiles()) <= len(table.inputFiles())


def test_snapshot_filter_reaches_the_scan(spark, tmp_path):
    path = writers.write_parquet(panel(spark, ("a", D1, 1)), str(tmp_path / "t"))
    df = readers.read_snapshot(spark.read.parquet(path), dt.datetime(2024, 1, 1)).select("x")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(snapshot_date,2024-01-01)" in plan
    assert "ReadSchema: struct<snapshot_date:date,x:int>" in plan


def test_layers_and_file_lists(spark, tmp_path):
    root = str(tmp_path)
    a = writers.write_table(panel(spark, ("a", D1, 1)), root, "bronze", "a")
    b = writers.write_table(panel(spark, ("b", D1, 2)), root, "bronze", "b")
    assert readers.read_table(spark, root, "bronze", "a").count() == 1
    assert readers.read_files(spark, [a, b]).count() == 2
    assert readers.read_files(spark, f"{root}/bronze/*").count() == 2
    assert readers.read_files(spark, a, pattern="part-*.parquet").count() == 1


def test_baseline_by_extension(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "fe_1 int, fe_2 int")
    csv = writers.write_csv(df, str(tmp_path / "b.csv"))
    parquet = writers.write_parquet(df, str(tmp_path / "b.parq"))
    assert [tuple(r) for r in readers.read_baseline(spark, csv, ["fe_2"]).collect()] == [(2,)]
    assert [tuple(r) for r in readers.read_baseline(spark, parquet, ["fe_1"]).collect()] == [(1,)]
    with pytest.raises(ValueError):
        readers.read_baseline(spark, str(tmp_path / "b.json"))


def test_metrics_round_trip_and_dates_as_text(spark, tmp_path):
    rows = [("r1", "2024-01-01", "auc", 0.5), ("r2", "", "auc", 0.6)]
    metrics = spark.createDataFrame(rows, K.METRICS_SCHEMA)
    parquet, csv = writers.export_metrics(metrics, str(tmp_path))
    assert sorted(map(tuple, readers.read_metrics(spark, parquet).collect())) == rows
    from_csv = sorted((r.run_id, r.snapshot_date or "", r.value) for r in readers.read_metrics(spark, csv).collect())
    assert from_csv == [("r1", "2024-01-01", 0.5), ("r2", "", 0.6)]
    dated = metrics.withColumn("snapshot_date", F.col("snapshot_date").try_cast("date"))
    path = writers.write_parquet(dated, str(tmp_path / "dated"))
    assert {r.snapshot_date for r in readers.read_metrics(spark, path).collect()} == {"2024-01-01", None}


def test_optional_file(spark, tmp_path):
    assert readers.read_optional(spark, str(tmp_path / "none.csv"), K.DATA_QUALITY_SCHEMA).columns == [
        "snapshot_date",
        "null_pct",
    ]
    (tmp_path / "q.csv").write_text("snapshot_date,null_pct\n2024-01-01,1.5\n")
    assert readers.read_optional(spark, str(tmp_path / "q.csv"), K.DATA_QUALITY_SCHEMA).first().null_pct == 1.5


def test_runs_are_read_whole_and_newest_first(spark, tmp_path):
    rows = [(f"r{i}", dt.datetime(2024, 1, 1 + i), {}, {}, {"auc": 0.5}) for i in range(5)]
    path = writers.write_parquet(spark.createDataFrame(rows, K.RUNS_SCHEMA), str(tmp_path / "runs"))
    assert readers.read_runs(spark, path, newest_first=True).first().run_id == "r4"
    assert registry.run_table(readers.read_runs(spark, path)).count() == 5


def test_predictions_by_model_and_snapshot(spark, tmp_path):
    rows = [("c1", D1, "m1", 0.5), ("c2", D2, "m1", 0.6)]
    df = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, model_name string, prediction double")
    path = writers.write_predictions(df, str(tmp_path))
    assert (tmp_path / "gold/model_predictions/model_name=m1/snapshot_date=2024-01-01").is_dir()
    assert sorted(map(tuple, spark.read.parquet(path).select(*df.columns).collect())) == rows


def test_staged_tables_live_in_the_session_folder(spark):
    df = staging.stage(panel(spark, ("a", D1, 1)), "t")
    assert df.inputFiles()[0].split("creditloom-")[0].endswith("/")
    assert staging.staging_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert "LogicalRDD" not in df._jdf.queryExecution().logical().toString()


def test_temporary_tables_are_deleted_after_the_block(spark):
    kept = staging.stage(panel(spark, ("a", D1, 1)), "kept")
    with staging.temporary_tables(spark):
        path = staging.stage(panel(spark, ("a", D1, 1)), "gone").inputFiles()[0]
        assert readers.path_exists(spark, path)
    assert not readers.path_exists(spark, path)
    assert kept.count() == 1


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v,w\nx,1,2.5\n")
    (tmp_path / "b.csv").write_text("w,k\n0.5,y\n")
    (tmp_path / "c.csv").write_text("k,v,w\nz,bad,1\n")
    (tmp_path / "d.csv").write_text("")
    schema = "k string, v int, w double"
    from pyspark.sql.types import StructType

    df = readers.read_csv(spark, str(tmp_path), StructType.fromDDL(schema))
    assert df.columns == ["k", "v", "w"]
    assert sorted(map(tuple, df.collect())) == [("x", 1, 2.5), ("y", None, 0.5), ("z", None, 1.0)]


def test_compressed_csv_files_are_grouped_by_their_headers(spark, tmp_path):
    rows = spark.range(30).select(F.col("id").cast("string").alias("a"), (F.col("id") * 2).cast("string").alias("b")).repartition(3)
    for part, columns in (("x", ["a", "b"]), ("y", ["b", "a"])):
        writers.write_csv(rows.select(*columns), f"{tmp_path}/{part}", "gzip")
    assert sorted(len(files) for files in readers._by_header(spark, f"{tmp_path}/*")) == [3, 3]
    schema = "a int, b int"
    got = readers.read_csv(spark, f"{tmp_path}/*", spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, got.collect())) == sorted((i, 2 * i) for i in range(30) for _ in range(2))


def test_run_log_is_compacted_by_day(spark, tmp_path):
    path, when = str(tmp_path / "runs"), dt.datetime
    from creditloom.operators import modeling as M

    for i in range(6):
        M.log_run(spark, path, M.RunRecord(f"r{i}", when(2024, 1, 1 + i // 4, i), {"model_type": "gbt"}, {"auc": i / 10}, {}))
    assert {str(r.day): r.n_files for r in readers.run_files(spark, path).collect()} == {"2024-01-01": 4, "2024-01-02": 2}
    before = sorted(readers.read_runs(spark, path).select("run_id", "start_time").collect())
    assert writers.compact_runs(spark, path, before="2024-01-02") == 1
    assert {str(r.day): r.n_files for r in readers.run_files(spark, path).collect()} == {"2024-01-01": 1, "2024-01-02": 2}
    assert writers.compact_runs(spark, path) == 1 and writers.compact_runs(spark, path) == 0
    after = readers.read_runs(spark, path)
    assert sorted(after.select("run_id", "start_time").collect()) == before and after.columns == K.RUNS_SCHEMA.names


def test_rows_fetched_lazily_need_no_shuffle(spark, monkeypatch):
    """A query's shuffle files go when it returns, which may be before the rows that it hands out are read."""
    plans, kind = [], type(spark.range(1))
    monkeypatch.setattr(kind, "toLocalIterator", lambda df, *a, f=kind.toLocalIterator, **k: (plans.append(df._jdf.queryExecution().toString()), f(df, *a, **k))[1])
    bits = key_filter(spark.range(0, 500, 1, 8), 1 << 10)
    assert in_filter(np.frombuffer(bits, np.uint8), np.arange(1024, dtype=np.uint64)).sum() == 500
    found = staging.rows_one_by_one(spark.range(0, 20_000, 1, 8).groupBy((F.col("id") % 997).alias("k")).agg(F.count("*").alias("n")))
    assert sorted(r.k for r in found) == list(range(997))
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
