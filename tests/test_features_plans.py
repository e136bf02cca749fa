import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditloom import __main__ as cli, constants as K
from creditloom.operators import drift, features, modeling as M, registry, snapshots as S
from creditloom.plans import etl, monitoring, training
from creditloom.sources import readers, writers
from creditloom.sources.staging import stage
from workload import queries as W, views as V


@pytest.fixture(scope="module")
def sources(spark):
    """The four cleaned tables at sf0.001."""
    sf = "/root/testdata/sf0.001"
    return [f(spark, sf) for f in (W.silver_financials, W.silver_attributes, W.silver_clickstream, W.silver_loans)]


def test_financial_features(spark):
    columns = ["Credit_Mix", "Monthly_Balance", "Outstanding_Debt", "Changed_Credit_Limit", "Num_Credit_Inquiries"]
    rows = [(None, 1.0, 10.0, None, 4), ("Good", 2.0, None, 2.0, 1), ("Bad", None, 500.0, 0.0, 2), ("Bad", 3.0, 30.0, 0.0, 9)]
    df = spark.createDataFrame(rows, "Credit_Mix string, Monthly_Balance double, Outstanding_Debt double, Changed_Credit_Limit double, Num_Credit_Inquiries int")
    others = {c: F.lit(1) for c in K.FINANCIAL_CAPPED if c not in columns}
    df = df.withColumns(
        {
            **others,
            "Annual_Income": F.lit(99.0),
            "Monthly_Inhand_Salary": F.lit(9.0),
            "Total_EMI_per_month": F.lit(5.0),
            "Amount_invested_monthly": F.lit(2.0),
            "Num_of_Loan": F.lit(1),
            "Payment_Behaviour": F.lit(None).cast("string"),
            "Payment_of_Min_Amount": F.lit("Yes"),
            "Credit_History_Age": F.lit("2 Years and 1 Months"),
            "Loan_Types_Array": F.array(F.lit("a"), F.lit("b")),
        }
    )
    out = features.financial_features(df, encode=False).orderBy("Monthly_Balance").collect()
    assert [r.Monthly_Balance for r in out] == [1.0, 2.0, 3.0]  # rows without a balance are left out
    assert [r.Outstanding_Debt for r in out] == [10.0, 10.0, 30.0]  # median of the kept rows
    assert [r.Credit_Mix for r in out] == ["Unknown", "Good", "Bad"]
    assert [r.has_credit_limit_change for r in out] == [0, 1, 0]
    first = out[0]
    assert (first.credit_history_months, first.num_loan_types, first.Payment_Behaviour) == (25, 2, "Unknown")
    assert first.debt_to_income == pytest.approx(0.1) and first.emi_to_salary == pytest.approx(0.5)
    assert first.investment_rate == pytest.approx(0.2) and first.balance_to_debt == pytest.approx(2 / 11)
    assert first.inq_per_loan == pytest.approx(2.0)
    encoded = features.financial_features(df)
    assert {"Credit_Mix_vec", "Payment_Behaviour_vec", "Payment_of_Min_Amount_vec"} <= set(encoded.columns)
    assert "Credit_Mix" not in encoded.columns and "Credit_History_Age" not in encoded.columns


def test_feature_store_columns_and_plan(spark, sources):
    store = features.feature_store(*sources)
    assert not set(store.columns) & set(K.FEATURE_STORE_DROPS)
    assert {c for c in store.columns if c.endswith("_vec")} == {
        f"{c}_vec" for c in K.FINANCIAL_CATEGORIES + K.ATTRIBUTE_CATEGORIES
    }
    assert set(K.CLICKSTREAM_FEATURES) < set(store.columns)
    plan = store._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
    kept = features.feature_store(*sources, encode=False, keep=("label",))
    assert "label" in kept.columns and kept.count() == store.count()


def plain_store(spark, sources):
    """The store from plain outcome joins, every copy of a row going through every step."""
    fin, att, clk, loans = sources
    labelled = [S.multi_snapshot_join(df, loans) for df in (fin, att, clk)]
    parts = [
        features.financial_features(labelled[0]),
        features.attribute_features(labelled[1]),
        features.clickstream_features(labelled[2]),
    ]
    return S.join_sources(parts).drop(*K.FEATURE_STORE_DROPS)


def test_counted_copies_give_the_store_of_plain_joins(spark, sources):
    fin, att, clk, loans = sources
    # one customer month with many loans, so that copies weigh on statistics and categories
    repeated = S.repeat_rows(loans, F.when((F.col("mob") == 6) & (F.crc32("Customer_ID") % 5 == 0), 4).otherwise(1).cast("bigint"))
    sources = [fin, att, clk, stage(repeated)]
    store = features.feature_store(*sources)
    assert store.count() < store.agg(F.sum("copies")).first()[0]
    counted = S.repeat_rows(store, F.col("copies")).drop("copies")
    plain = plain_store(spark, sources).select(counted.columns)
    vectors = {c: M.vector_to_array(c) for c in counted.columns if c.endswith("_vec")}
    counted, plain = counted.withColumns(vectors), plain.withColumns(vectors)
    assert counted.count() > 64
    assert counted.exceptAll(plain).count() == plain.exceptAll(counted).count() == 0


def test_repeat_rows_in_chunks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 3)], "k string, n long")
    out = S.repeat_rows(df, F.col("n"), chunk=3)
    assert out.columns == ["k", "n"]
    assert {r.k: r["count"] for r in out.groupBy("k").count().collect()} == {"a": 1, "b": 7, "c": 3}


def test_copies_of_one_row_are_made_by_many_tasks(spark):
    df = spark.createDataFrame([("a", 200_000)], "k string, n long").coalesce(1)
    out = S.repeat_rows(df, F.col("n")).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in out) == 200_000 and len(out) > 1


def test_baselines_count_by_copies(spark):
    rows = [(1, 3), (2, 1), (9, 2)]
    counted = spark.createDataFrame(rows, "fe_1 int, copies long")
    plain = spark.createDataFrame([(v,) for v, n in rows for _ in range(n)], "fe_1 int")
    current = spark.createDataFrame([(1,), (2,), (2,)], "fe_1 int")
    assert drift.baseline(counted).columns == ["fe_1", "copies"]
    values = [drift.psi(base, current, ["fe_1"]).first().psi for base in (counted, plain)]
    assert values[0] == pytest.approx(values[1]) and values[0] > 0


def test_one_snapshot_features_can_reuse_a_fit(spark, sources):
    labelled = S.multi_snapshot_join(sources[0], sources[3])
    one = labelled.where(F.col("feature_snapshot_date") == dt.date(1997, 3, 1))
    apart = features.financial_features(one, encode=False)
    fitted = features.financial_features(one, encode=False, fit_df=labelled)
    whole = features.financial_features(labelled, encode=False)
    assert fitted.count() == apart.count()
    assert fitted.exceptAll(whole).count() == 0


def test_csv_to_gold(spark, sf, tmp_path):
    """Files in, feature store, model, predictions, metrics and report out."""
    data, root = tmp_path / "data", str(tmp_path / "lake")
    views = {"financials": V.financials, "attributes": V.attributes, "clickstream": V.clickstream, "loans": V.loans}
    for name, view in views.items():
        view(spark, sf).write.option("header", True).csv(str(data / etl.SOURCE_FILES[name]))
    gold = etl.run(spark, str(data), root, encode=False)
    direct = W.feature_store(spark, sf)
    assert W.rounded(gold["feature_store"], 9, "log_Annual_Income").select(direct.columns).exceptAll(direct).count() == 0
    assert gold["feature_store"].count() == direct.count()

    base = etl.extract_baseline(spark, root, str(tmp_path / "baseline.csv"))
    clk = readers.read_table(spark, root, "silver", "clickstream_clean")
    models, runs = str(tmp_path / "models"), str(tmp_path / "runs")
    for day in ("1997-01-01", "1998-01-01"):
        record = training.train_snapshot(spark, clk, gold["label_store"], "logistic_regression", day, models, runs)
        assert 0.3 < record.metrics["auc"] < 0.7
    assert training.train_snapshot(spark, clk, gold["label_store"], "gbt", "1980-01-01", models) is None

    chosen = training.select_models(spark, runs, models, str(tmp_path / "chosen"), "1997-01-01", "1998-01-01")
    assert {r.status for r in chosen.collect()} == {"promoted"}

    months = S.month_spine(spark, "1997-01-01", "1998-12-01")
    summary = monitoring.infer(
        spark, clk, readers.read_baseline(spark, base), training.list_artifacts(spark, models), models, months, root, runs
    ).collect()
    assert {str(r.snapshot_date) for r in summary} == {"1997-01-01", "1998-01-01"}
    assert all(r.decision and 0 < r.pred_mean < 1 for r in summary)
    predictions = readers.read_table(spark, root, "gold", "model_predictions")
    assert predictions.count() == clk.where(F.col("snapshot_date").isin([r.snapshot_date for r in summary])).count()

    logged = readers.read_runs(spark, runs)
    assert logged.count() == 4
    alert = monitoring.alert(logged).first()
    assert alert.psi_max == pytest.approx(max(r.psi_max for r in summary if r.psi_max == alert.psi_max))
    parquet, _ = monitoring.export_run_metrics(spark, runs, str(tmp_path / "export"))
    report = monitoring.build_report(spark, parquet, str(tmp_path / "report"), str(tmp_path / "absent.csv"))
    assert report["auc"].count() == 2 and report["psi"].count() == 22 and report["nulls"].count() == 0


def test_silver_is_shuffled_only_where_bronze_is_not_by_snapshot(spark, sf, tmp_path, monkeypatch):
    """The clickstream comes from folders by snapshot, the loans do not; both are the same rows by folder."""
    data, root = f"{tmp_path}/data", f"{tmp_path}/lake"
    views = {"financials": V.financials, "attributes": V.attributes, "clickstream": V.clickstream, "loans": V.loans}
    for name, view in views.items():
        writers.write_csv(view(spark, sf), f"{data}/{etl.SOURCE_FILES[name]}", "gzip")
    etl.build_bronze(spark, data, root)
    hints = []
    kind, hint = type(spark.range(1)), type(spark.range(1)).hint
    monkeypatch.setattr(kind, "hint", lambda df, *args: (hints.append((args, "loan_id" in df.columns, "dpd" in df.columns)), hint(df, *args))[1])
    silver = etl.build_silver(spark, root)
    assert hints == [(("rebalance", "snapshot_date"), True, False)]
    for name in ("clickstream", "loans"):
        want = etl.CLEANERS[name](readers.read_csv(spark, f"{data}/{etl.SOURCE_FILES[name]}", K.SOURCE_SCHEMAS[name]))
        got = silver[name].select(*want.columns)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() > 0
        assert len(silver[name].inputFiles()) <= 8 * silver[name].select("snapshot_date").distinct().count()


def test_training_history_holds_the_rows_of_every_snapshot(spark):
    """One join and one written table for all snapshots, with nulls, repeated rows and customers without early labels."""
    d = lambda m: dt.date(2023, m, 1)
    feat = [("a", d(1), 1), ("a", d(1), 1), ("a", d(4), 2), ("b", d(2), 3), (None, d(1), 4), ("c", d(3), None), ("a", None, 5), ("z", d(1), 6)]
    labels = [("a", d(1), 1), ("a", d(2), 0), ("a", d(2), 0), ("b", d(5), 1), ("b", None, 1), (None, d(1), 1), ("c", d(3), 0), ("c", d(2), None)]
    feat = spark.createDataFrame(feat, "Customer_ID string, snapshot_date date, fe_1 int")
    labels = spark.createDataFrame(labels, "Customer_ID string, snapshot_date date, label int")
    days = [d(1), d(2), d(3), d(6)]
    history = training.training_history(feat, labels, days)
    found = []
    for day in days:
        want = training.training_rows(feat, labels, day)
        got = training.history_rows(history, day)
        assert dict(got.dtypes) == dict(want.dtypes)
        found.append(sorted(map(str, got.select(*want.columns).collect())))
        assert found[-1] == sorted(map(str, want.collect()))
    assert len(found[0]) == 2 and len(found[-1]) > len(found[1]) > len(found[0])


def test_snapshots_of_one_query_share_their_history(spark, sf, monkeypatch):
    shared = []
    monkeypatch.setattr(W.training, "train_snapshot", lambda *args, **more: shared.append(more.get("history")))
    monkeypatch.setattr(W.training, "list_artifacts", lambda *_: None)
    monkeypatch.setattr(W.monitoring, "infer", lambda spark, clk, base, artifacts, models, months, *_: clk)
    clk = W.score_and_monitor(spark, sf)
    assert len(shared) == 12 and len({id(h) for h in shared}) == 1 and shared[0] is not None
    assert all("creditloom-" in f for df in (clk, shared[0]) for f in df.inputFiles())


def test_scoring_follows_each_snapshots_model(spark, sf, tmp_path):
    clk = W.silver_clickstream(spark, sf)
    rows = clk.withColumn("label", (F.col("fe_1") > 0).cast("int"))
    days = ["1996-01-01", "1996-02-01"]
    for i, day in enumerate(days):
        train = rows if i == 0 else rows.withColumn("label", 1 - F.col("label"))
        M.save_model(M.train_lr(train, ["fe_1"], maxIter=20), str(tmp_path / f"lr_{day}"))
    served = {day: f"lr_{day}" for day in days}
    out = monitoring.score_snapshots(clk, served, str(tmp_path)).join(rows, ["Customer_ID", "snapshot_date"])
    for day, name in served.items():
        mine = out.where(F.col("snapshot_date") == day)
        assert {r.model_name for r in mine.select("model_name").distinct().collect()} == {name}
    ranks = {str(r.snapshot_date): r.auc for r in M.auc(out, by=["snapshot_date"]).collect()}
    assert ranks == {days[0]: 1.0, days[1]: 0.0}


def test_monitor_measures_every_month(spark, sf):
    clk = W.silver_clickstream(spark, sf)
    months = S.month_spine(spark, "1998-01-01", "1998-03-01")
    psi, summary = monitoring.monitor(drift.baseline(clk), clk, months)
    assert psi.select("snapshot_date").distinct().count() == summary.count() == 3
    one = readers.read_snapshot(clk, "1998-02-01")
    alone = {r.feature: r.psi for r in drift.psi(drift.baseline(clk), one).collect()}
    together = {r.feature: r.psi for r in psi.where("snapshot_date = date '1998-02-01'").collect()}
    assert together == pytest.approx(alone)


def test_command_line(spark, sf, tmp_path, capsys):
    args = cli.parser().parse_args(
        ["train", "--featurepath", "f.csv", "--labeldir", "l", "--modeldir", "m", "--snapshotdate", "2024-01-01", "--modeltype", "gbt"]
    )
    assert args.modeltype == "gbt" and args.runs is None
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["train"])
    runs = str(tmp_path / "runs")
    V.run_log(spark, sf).withColumn("start_time", F.col("start_time").cast("timestamp")).write.parquet(runs)
    cli.main(["alert", "--runs", runs])
    assert "run_" in capsys.readouterr().out
    cli.main(["export-metrics", "--runs", runs, "--outdir", str(tmp_path / "out")])
    expected = registry.metrics_long(V.run_log(spark, sf)).count()
    assert readers.read_metrics(spark, str(tmp_path / "out/metrics.parquet")).count() == expected
