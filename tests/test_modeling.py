import datetime as dt
import random
import threading

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.operators import features, modeling as M, snapshots as S


def scores(spark, rows):
    return spark.createDataFrame(rows, "g string, prediction double, label int")


def naive_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg)) if pos and neg else None


def random_scores(n=400, seed=5):
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "b"]), rng.randrange(30) / 10, rng.randrange(2)) for _ in range(n)]


def test_auc_equals_pair_counting_and_the_evaluator(spark):
    rows = random_scores()
    df = scores(spark, rows)
    whole = M.auc(df).first().auc
    assert whole == pytest.approx(naive_auc([(s, y) for _, s, y in rows]), rel=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="prediction", numBins=0)
    assert whole == pytest.approx(evaluator.evaluate(df), rel=1e-9)
    for g, value in M.auc(df, by=["g"]).collect():
        assert value == pytest.approx(naive_auc([(s, y) for k, s, y in rows if k == g]), rel=1e-12)


def test_auc_symmetry_and_extremes(spark):
    df = scores(spark, random_scores())
    whole = M.auc(df).first().auc
    assert M.auc(df.withColumn("prediction", F.exp("prediction"))).first().auc == pytest.approx(whole)
    assert M.auc(df.withColumn("prediction", -F.col("prediction"))).first().auc == pytest.approx(1 - whole)
    assert M.auc(scores(spark, [("a", 0.1, 0), ("a", 0.9, 1)])).first().auc == 1.0
    assert M.auc(scores(spark, [("a", 0.9, 0), ("a", 0.1, 1)])).first().auc == 0.0
    assert M.auc(scores(spark, [("a", 0.9, 1), ("a", 0.1, 1)])).first().auc is None


def test_weighted_auc_equals_repeated_rows(spark):
    rows = random_scores(60)
    weighted = scores(spark, rows).withColumn("w", F.col("label") * 2 + 1)
    repeated = scores(spark, [r for r in rows for _ in range(r[2] * 2 + 1)])
    assert M.auc(weighted, weight="w").first().auc == pytest.approx(M.auc(repeated).first().auc, rel=1e-12)


def test_gini(spark):
    row = M.evaluate(scores(spark, random_scores()), by="g").first()
    assert row.gini == round(2 * row.auc - 1, 3)


def test_hash_split_is_complete_disjoint_and_stable(spark):
    df = spark.range(5000).withColumn("label", (F.col("id") % 50 == 0).cast("int"))
    split = M.stratified_split(df, "id")
    counts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(counts.values()) == 5000 and counts["test"] == pytest.approx(1000, abs=100)
    again = M.stratified_split(df.repartition(7), "id")
    assert split.exceptAll(again).count() == 0
    assert M.stratified_split(df, "id", frac=1.0).where("split = 'train'").count() == 0
    assert M.stratified_split(df, "id", frac=0.0).where("split = 'test'").count() == 0
    assert M.label_classes(df).first().n_classes == 2
    assert {r.split for r in M.split_stats(split).collect()} == {"train", "test"}


def test_exact_split_counts_per_class(spark):
    df = spark.range(3000).withColumn("label", (F.col("id") % 50 == 0).cast("int"))
    split = M.exact_stratified_split(df, "id")
    counts = {(r.label, r.split): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert counts == {(0, "test"): 588, (0, "train"): 2352, (1, "test"): 12, (1, "train"): 48}


def test_time_split(spark):
    df = spark.createDataFrame([(dt.date(2024, m, 1),) for m in (1, 6, 7, 8, 9)], "snapshot_date date")
    windows = S.split_windows(F.lit(dt.date(2024, 9, 1)), train_test_months=3)
    periods = [r.period for r in M.time_split(df, windows).orderBy("snapshot_date").collect()]
    assert periods == [None, "train_test", "oot", "oot", None]


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1), (2.0, 5.0, 2), (None, 5.0, 3), (6.0, 5.0, 4)], "a double, b double, w int")
    params = M.fit_scaler(df, ["a", "b"]).first()
    assert params.a.mean == 3.0 and params.a.std == pytest.approx(np.std([1, 2, 6]))
    assert (params.b.mean, params.b.std) == (5.0, 1.0)
    scaled = M.apply_scaler(df, M.fit_scaler(df, ["a", "b"])).collect()
    assert [r.b for r in scaled] == [0.0] * 4 and scaled[2].a is None
    weighted = M.fit_scaler(df, ["a", "b"], weight="w").first()
    repeated = [1] + [2] * 2 + [6] * 4
    assert weighted.a.mean == pytest.approx(np.mean(repeated)) and weighted.a.std == pytest.approx(np.std(repeated))
    assert weighted.b.std == 1.0


def training_frame(spark, n=300, seed=9):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, z = rng.gauss(3, 2), rng.gauss(0, 1)
        rows.append((i, x, z, int(rng.random() < 1 / (1 + np.exp(-(0.8 * (x - 3) - z))))))
    return spark.createDataFrame(rows, "id int, fe_1 double, fe_2 double, label int")


def newton_logistic(x, y, weights=None, C=1.0):
    """Minimise C * sum of log losses + |w|^2 / 2, intercept free."""
    x = np.c_[x, np.ones(len(x))]
    weights = np.ones(len(x)) if weights is None else weights
    penalty = np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = C * x.T @ (weights * (p - y)) + penalty @ beta
        hessian = C * (x.T * (weights * p * (1 - p))) @ x + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta


def test_logistic_regression_solves_the_summed_objective(spark):
    df = training_frame(spark)
    data = np.array([(r.fe_1, r.fe_2, r.label) for r in df.collect()])
    x, y = data[:, :2], data[:, 2]
    beta = newton_logistic((x - x.mean(0)) / x.std(0), y)
    model = M.train_lr(df, ["fe_1", "fe_2"], tol=1e-10).stages[-1]
    assert [*model.coefficients, model.intercept] == pytest.approx(beta, abs=1e-4)


def test_weighted_training_equals_training_on_every_pair(spark):
    customers = training_frame(spark, 120).withColumn("Customer_ID", (F.col("id") % 40).cast("string"))
    feat = customers.select("Customer_ID", F.lit(dt.date(2023, 1, 1)).alias("snapshot_date"), "fe_1", "fe_2")
    labels = customers.select("Customer_ID", "label", F.lit(dt.date(2023, 7, 1)).alias("snapshot_date"))
    cols = ["fe_1", "fe_2"]
    pairs = M.train_lr(S.attach_labels(feat, labels), cols, tol=1e-10).stages[-1]
    counted = M.train_lr(S.attach_label_counts(feat, labels), cols, weight="weight", tol=1e-10).stages[-1]
    assert [*counted.coefficients, counted.intercept] == pytest.approx([*pairs.coefficients, pairs.intercept], abs=1e-5)


def test_models_score_save_and_load(spark, tmp_path):
    df = training_frame(spark).withColumn("Customer_ID", F.col("id").cast("string")).withColumn(
        "snapshot_date", F.lit(dt.date(2024, 1, 1))
    )
    for trainer, options in ((M.train_lr, {}), (M.train_gbt, {"maxIter": 3, "maxDepth": 2})):
        model = trainer(df, ["fe_1", "fe_2"], **options)
        out = M.score(df, model, "m")
        assert out.columns == ["Customer_ID", "snapshot_date", "model_name", "prediction"]
        loaded = M.load_model(M.save_model(model, str(tmp_path / trainer.__name__)))
        assert M.score(df, loaded, "m").exceptAll(out).count() == 0
        labelled = M.score(df, model, "m", ("label",))
        assert M.auc(labelled).first().auc > 0.7
    stats = M.prediction_stats(out).first()
    values = [r.prediction for r in out.collect()]
    assert (stats.pred_mean, stats.pred_std) == (pytest.approx(np.mean(values)), pytest.approx(np.std(values)))


def test_search(spark):
    candidates = M.search_candidates()
    assert len(candidates) == 100 and len({str(c) for c in candidates}) == 100
    assert candidates == M.search_candidates() != M.search_candidates(seed=1)
    assert len(M.search_candidates({"maxIter": [1, 2]}, n=9)) == 2
    rows = M.assemble(training_frame(spark, 80), ["fe_1", "fe_2"])
    space = {"maxIter": [1, 2], "maxDepth": [1], "stepSize": [0.1], "featureSubsetStrategy": ["0.6"]}
    results = M.search_results(M.random_search(rows, space, n=2, folds=2)).collect()
    assert len(results) == 2 and all(0 <= r.mean_auc <= 1 for r in results)


def test_run_log_and_model_card(spark, tmp_path):
    path = str(tmp_path / "runs")
    record = M.RunRecord("r1", dt.datetime(2024, 1, 1), {"snapshot_date": "2024-01-01"}, {"auc": 0.7, "none": None}, {})
    M.log_run(spark, path, record)
    M.log_run(spark, path, M.RunRecord("r2", dt.datetime(2024, 1, 2), {}, {"auc": 1}, {"p": "1"}))
    logged = spark.read.schema(K.RUNS_SCHEMA).parquet(path).orderBy("run_id").collect()
    assert [r.metrics for r in logged] == [{"auc": 0.7}, {"auc": 1.0}]

    split = M.stratified_split(training_frame(spark).withColumn("prediction", F.col("fe_1")), "id")
    windows = S.split_windows(F.lit(dt.date(2024, 9, 1)))
    card = M.model_card("v1", windows, M.split_stats(split), M.evaluate(split), {"maxDepth": "2"}).first()
    assert card.model_version == "v1" and card.hp_params == {"maxDepth": "2"}
    assert card.data_dates.oot_end_date == dt.date(2024, 8, 31)
    assert sorted(card.splits) == ["test", "train"] and card.splits["train"].n_rows == 300 - card.splits["test"].n_rows


def test_one_hot_and_category_index(spark):
    rows = [("b", "x"), ("b", None), ("a", "y"), ("c", "y"), (None, "y")]
    df = spark.createDataFrame(rows, "k string, l string")
    index = {(r.feature, r.category): r["index"] for r in features.category_index(df, ["k", "l"]).collect()}
    assert index == {("k", "b"): 0, ("k", "a"): 1, ("k", "c"): 2, ("l", "y"): 0, ("l", "x"): 1}
    out = features.one_hot(df, ["k", "l"])
    assert out.columns == ["k_vec", "l_vec"]
    vectors = [tuple(r.k_vec.toArray()) for r in out.collect()]
    assert vectors == [(1, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0)]
    unseen = features.one_hot(spark.createDataFrame([("z", "x")], "k string, l string"), ["k", "l"], fit_df=df)
    assert list(unseen.first().k_vec.toArray()) == [0, 0, 0]


def test_first_rounds_are_the_shorter_fit(spark):
    rows = M.assemble(training_frame(spark, 120), ["fe_1", "fe_2"])
    options = {"maxDepth": 2, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": 1}
    long, short = (M.boosted_trees(maxIter=n, **options).fit(rows) for n in (5, 2))
    cut = M.first_rounds(long, 2)
    assert [t.toDebugString.split("\n", 1)[1] for t in cut.trees] == [t.toDebugString.split("\n", 1)[1] for t in short.trees]
    got, want = ([list(r.probability) for r in m.transform(rows).select("probability").collect()] for m in (cut, short))
    assert got == want and M.first_rounds(long, 9) is long


def test_search_fits_nested_points_once(spark):
    rows = M.assemble(training_frame(spark, 80), ["fe_1", "fe_2"])
    space = {"maxIter": [1, 2, 3], "maxDepth": [1, 2]}
    search = M.random_search(rows, space, n=6, folds=2)
    assert search.n_fits == 4 and len(search.scores) == 6 and search.best in search.points
    assert search.best_model.getNumTrees == search.best["maxIter"]


def test_work_side_by_side_keeps_its_own_properties(spark):
    """Calls that shared one set of properties lost the number of their running query to each other."""
    sc, all_set, all_run = spark.sparkContext, threading.Barrier(3), threading.Barrier(3)

    def work(i):
        sc.setLocalProperty("creditloom.test", str(i))
        all_set.wait(60)
        found = sc.getLocalProperty("creditloom.test"), spark.range(i).count()
        all_run.wait(60)
        return found

    assert list(M.side_by_side(spark, work, range(3), 3)) == [("0", 0), ("1", 1), ("2", 2)]
    assert sc.getLocalProperty("creditloom.test") is None


def test_native_trees_and_their_leaves(spark):
    rows = training_frame(spark, 200)
    model = M.train_gbt(rows, ["fe_1", "fe_2"], maxIter=4, maxDepth=3)
    holed = rows.withColumn("fe_2", F.when(F.col("id") % 7 != 0, F.col("fe_2")))  # missing values go to the right
    native = {r.id: r.prediction for r in M.tree_score(holed, model, "m", ("id",)).collect()}
    fitted = {r.id: r.prediction for r in M.score(holed, model, "m", ("id",)).collect()}
    assert native == pytest.approx(fitted, rel=1e-12)
    for r in M.leaf_statistics(rows, model).collect():
        assert r.n == r.n_rows and r.prediction == pytest.approx(r.mean_residual, abs=1e-9)
