import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.functions import records as R
from creditloom.operators import registry, report

NAN = float("nan")
RUN_COLUMNS = "run_id string, start_time timestamp, snapshot_date string, model_type string, auc double"


def t(hour):
    return dt.datetime(2024, 5, 1, hour)


@pytest.fixture
def runs(spark):
    rows = [
        ("a", t(1), "2021-01-01", "lr", 0.7),
        ("b", t(2), "2021-01-01", "gbt", 0.8),
        ("c", t(3), "2021-01-01", "gbt", NAN),
        ("d", t(1), "2021-02-01", "lr", 0.6),
        ("e", t(2), "2021-02-01", "gbt", 0.6),  # tie: the newer run wins
        ("f", t(2), "2021-02-01", "lr", 0.6),  # same time: the lower id wins
        ("g", t(1), "2024-02-01", "gbt", 0.5),
        ("h", t(1), "2024-03-01", "lr", 0.9),
        ("i", t(1), None, "lr", 0.9),
        ("j", t(1), "2024-04-01", "lr", None),
        ("k", t(1), "2030-01-01", "gbt", 0.9),
    ]
    return spark.createDataFrame(rows, RUN_COLUMNS)


def test_best_run_and_ranking_agree(runs):
    best = {r.snapshot_date: r.run_id for r in registry.best_per_snapshot(runs).collect()}
    assert best == {"2021-01-01": "b", "2021-02-01": "e", "2024-02-01": "g", "2024-03-01": "h", "2030-01-01": "k"}
    ranked = registry.rank_runs(runs).collect()
    assert {r.snapshot_date: r.run_id for r in ranked if r["rank"] == 1} == best
    february = sorted((r["rank"], r.run_id) for r in ranked if r.snapshot_date == "2021-02-01")
    assert february == [(1, "e"), (2, "f"), (3, "d")]
    in_range = registry.best_per_snapshot(runs, "2021-02-01", "2024-02-01")
    assert sorted(r.snapshot_date for r in in_range.collect()) == ["2021-02-01", "2024-02-01"]


def test_latest_run(runs):
    assert registry.latest_run(runs).first().run_id == "c"


def artifacts(spark, *names):
    return registry.parse_artifacts(spark.createDataFrame([(n,) for n in names], "name string")).withColumn(
        "snapshot_date", F.col("snapshot_date").cast("string")
    )


def test_promotion_statuses(spark, runs):
    stored = artifacts(spark, "gbt_2021-01-01.pkl", "gbt_2021-02-01", "gbt_2024-01-01", "readme.txt")
    out = {r.snapshot_date: r for r in registry.promotions(runs, stored).collect()}
    assert {d: r.status for d, r in out.items()} == {
        "2021-01-01": "promoted",
        "2021-02-01": "promoted",
        "2024-02-01": "fallback",  # exactly three years back is still eligible
        "2024-03-01": "fallback_missing",  # the fallback month has no artefact of the same type
        "2030-01-01": "no_fallback",
    }
    assert out["2024-02-01"].source_snapshot == "2021-02-01"
    assert out["2024-03-01"].source_snapshot is None
    unlimited = {r.snapshot_date: r.fallback_snapshot for r in registry.promotions(runs, stored, years=None).collect()}
    assert unlimited["2030-01-01"] == "2024-03-01" and unlimited["2021-01-01"] is None
    two_years = {r.snapshot_date: r.status for r in registry.promotions(runs, stored, years=2).collect()}
    assert two_years["2024-02-01"] == "no_fallback"


def test_artifact_names_and_lookup(spark):
    rows = artifacts(spark, "lr_2024-01-01.pkl", "gbt_2024-01-01.pkl", "my_type_2024-02-01", "other.pkl")
    assert sorted((r.model_type, r.snapshot_date) for r in rows.collect()) == [
        ("gbt", "2024-01-01"),
        ("lr", "2024-01-01"),
        ("my_type", "2024-02-01"),
    ]
    assert registry.model_for_snapshot(rows, "2024-01-01").first().name == "gbt_2024-01-01.pkl"
    assert registry.model_for_snapshot(rows, "2025-01-01").count() == 0


def test_semi_and_anti_join_split_the_runs(spark, runs):
    stored = artifacts(spark, "gbt_2021-01-01.pkl", "lr_2024-03-01.pkl")
    assert sorted(r.run_id for r in registry.with_artifact(runs, stored).collect()) == ["b", "c", "h"]
    assert registry.without_artifact(runs, stored).count() == runs.count() - 3


def records(spark):
    rows = [
        ("r1", t(1), {"snapshot_date": "2024-01-01", "model_type": ""}, {"model_type": "lr"}, {"auc": 0.5, "psi_a": 0.1}),
        ("r2", t(2), {}, {}, {"psi_a": 0.3}),
    ]
    return spark.createDataFrame(rows, K.RUNS_SCHEMA)


def test_tags_and_long_metrics(spark):
    runs = records(spark)
    assert [r.model_type for r in registry.tag(runs, "model_type", "none").orderBy("run_id").collect()] == ["lr", "none"]
    assert sorted(map(tuple, registry.metrics_long(runs).collect())) == [
        ("r1", "2024-01-01", "auc", 0.5),
        ("r1", "2024-01-01", "psi_a", 0.1),
        ("r2", "", "psi_a", 0.3),
    ]
    table = registry.run_table(runs).orderBy("run_id").collect()
    assert [(r.model_type, r.auc, r.snapshot_date) for r in table] == [("lr", 0.5, "2024-01-01"), (None, None, None)]
    assert runs.select(R.strip_prefix(F.lit("psi_fe_1"), "psi_")).first()[0] == "fe_1"


METRICS = [
    ("r1", "2024-02-01", "psi_b", 0.2),
    ("r1", "2024-01-01", "psi_a", 0.1),
    ("r1", "2024-01-01", "psi_max", 0.1),
    ("r1", "2024-02-01", "auc", 0.7),
    ("r1", "2024-01-01", "auc", 0.6),
]


def test_pivot(spark):
    metrics = spark.createDataFrame(METRICS, K.METRICS_SCHEMA)
    table = report.metric_pivot(metrics, exclude=["psi_max"], short_names=True)
    assert table.columns == ["metric_name", "2024-01-01", "2024-02-01"]
    assert [tuple(r) for r in table.collect()] == [("a", 0.1, None), ("b", None, 0.2)]
    assert report.metric_pivot(metrics, snapshots=["2024-01-01"]).columns == ["metric_name", "2024-01-01"]
    with pytest.raises(PySparkException, match="more than one value for psi_a"):
        report.metric_pivot(metrics.union(metrics.limit(2))).collect()


def test_series_and_null_profile(spark):
    metrics = spark.createDataFrame(METRICS, K.METRICS_SCHEMA)
    assert [r.value for r in report.auc_series(metrics).collect()] == [0.6, 0.7]
    data = spark.createDataFrame([("d2", 1, None), ("d1", None, None), ("d2", 2, 3)], "snapshot_date string, a int, b int")
    assert [tuple(r) for r in report.null_profile(data).collect()] == [("d1", 100.0), ("d2", 25.0)]
    tables = report.report_tables(metrics, data)
    assert sorted(tables) == ["auc", "nulls", "psi"]
