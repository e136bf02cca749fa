import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from creditloom.operators import boosting as B, modeling as M
from creditloom.plans import training

SPACE = {
    "maxIter": [2, 4],
    "maxDepth": [2, 3],
    "stepSize": [0.1, 0.3],
    "subsamplingRate": [0.7, 1.0],
    "featureSubsetStrategy": ["0.6", "all"],
    "minInfoGain": [0.0, 0.02],
    "minInstancesPerNode": [1, 9],
}


def frame(spark, n=240, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [rng.gauss(0, 1), rng.gauss(0, 1), float(rng.randrange(4)), 1.0, rng.random()]
        rows.append((*x, int(rng.random() < 1 / (1 + np.exp(-x[0] * x[1] - x[2] + 1)))))
    return spark.createDataFrame(rows, "a double, b double, c double, d double, e double, label int")


def vectors(spark, **options):
    # one partition, so that two searches deal out the rows in the same order
    return M.assemble(frame(spark, **options).coalesce(1), ["a", "b", "c", "d", "e"])


def test_random_numbers_are_sparks(spark):
    jvm = spark._jvm
    for seed in (43, -7, 1 << 40):
        theirs = jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        want = [theirs.nextDouble() for _ in range(400)]
        assert list(itertools.islice(B.xorshift_doubles(seed), 20)) == want[:20]
        assert list(B.uniforms(seed, 0, 400)) == want and list(B.uniforms(seed, 133, 90)) == want[133:223]
        mine, java = B.JavaRandom(seed), jvm.java.util.Random(seed)
        assert [mine.next_long() for _ in range(5)] == [java.nextLong() for _ in range(5)]


@pytest.mark.parametrize("rows_per_task", [1000, 90])
def test_shared_fits_are_the_single_ones(spark, monkeypatch, rows_per_task):
    """Every point's score is what Spark ML's own fits give, also where rows are drawn in several partitions and blocks."""
    monkeypatch.setattr(M, "ROWS_PER_TASK", rows_per_task)
    monkeypatch.setattr(B, "BLOCK_ROWS", 50)
    folds, write = [], M.stage

    def stage_once(df, name="table"):
        """Both searches read the same files: their order, and so the draws, is that of the folder."""
        if name != "folds":
            return write(df, name)
        folds[:] = folds or [write(df, name)]
        return folds[0]

    monkeypatch.setattr(M, "stage", stage_once)
    rows = vectors(spark)
    shared = M.random_search(rows, SPACE, n=6, folds=2)
    monkeypatch.setattr(B, "can_share", lambda *_: False)
    single = M.random_search(rows, SPACE, n=6, folds=2)
    assert shared.points == single.points and shared.n_fits == single.n_fits
    assert shared.scores == pytest.approx(single.scores, abs=1e-12)
    assert len({round(s, 9) for s in shared.scores}) > 1


def test_jobs_do_not_grow_with_the_points(spark):
    """The search ran some hundred jobs a fit before, so its time was that of its fits, whatever the rows."""
    sc, rows, jobs = spark.sparkContext, vectors(spark).cache(), {}
    space = {**SPACE, "maxIter": [2], "maxDepth": [2]}
    for n in (1, 12):
        sc.setLocalProperty("spark.jobGroup.id", f"search-{n}")
        M.random_search(rows, space, n=n, folds=2)
        jobs[n] = len(sc.statusTracker().getJobIdsForGroup(f"search-{n}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    rows.unpersist()
    assert jobs[1] > 0 and jobs[12] < jobs[1] + 12


def test_fits_part_where_their_trees_do(spark):
    """Fits that differ in a bound that never holds are one line of trees; the number of scores shows it."""
    rows = M.stage(vectors(spark).select("features", "label").repartition(1).withColumn("fold", F.floor(F.rand(1) * 2).cast("int"))).coalesce(1)
    points = [{"maxIter": 3, "maxDepth": 2, "minInfoGain": gain} for gain in (0.0, 1e-9, 0.9)]
    scores, of = B.held_out_scores(rows, M.boosted_trees(), points, 2)
    for fold in range(2):
        assert of[0, fold] == of[1, fold] != of[2, fold]
    held = {r.fold: r["count"] for r in rows.groupBy("fold").count().collect()}
    counts = {r.score_id: r.n for r in scores.groupBy("score_id").agg(F.sum("n").alias("n")).collect()}
    assert counts == {number: held[fold] for (_, fold), number in of.items()}


def test_folds_of_one_class_score_like_the_evaluator(spark):
    rows = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 0)], "fold int, label int")
    scores = spark.createDataFrame([(5, 0.1, 1, 3), (6, 0.1, 0, 3), (7, 0.2, 1, 2), (7, 0.1, 0, 1), (7, 0.3, 0, 1)], B.SCORES.replace("long", "bigint"))
    assert M._areas(rows, scores, {5: 0, 6: 1, 7: 2, 8: 3}) == {5: 1.0, 6: 0.0, 7: 0.5, 8: 0.5}


def test_rows_that_a_fit_refuses_are_refused(spark):
    rows = frame(spark, n=40)
    space = {"maxIter": [1], "maxDepth": [1]}
    for bad in (rows.withColumn("label", F.lit(2)), rows.withColumn("a", F.lit(float("nan")))):
        with pytest.raises(Exception, match="(?i)label|nan"):
            M.random_search(M.assemble(bad, ["a", "b"]), space, n=1, folds=2)


def test_other_fits_are_left_to_their_estimator(spark):
    rows = vectors(spark)
    points = [{"regParam": 0.1}, {"regParam": 1.0}]
    assert not B.can_share(LogisticRegression(), points) and not B.can_share(M.boosted_trees(), [{"maxBins": 8}])
    assert B.can_share(M.boosted_trees(seed=7, maxBins=8), [{"maxIter": 2}]) and not B.can_share(M.boosted_trees(minWeightFractionPerNode=0.1), [{}])
    estimator = LogisticRegression(featuresCol=M.FEATURES, labelCol="label")
    search = M.random_search(rows, {"regParam": [0.1, 1.0]}, n=2, folds=2, estimator=estimator)
    assert search.n_fits == 4 and all(0.5 < s <= 1 for s in search.scores)


def test_windowed_training_searches_in_shared_jobs(spark):
    """The windowed flow ran the jobs of every point's fits one after the other, too."""
    sc, jobs = spark.sparkContext, {}
    rng = random.Random(2)
    rows = [(str(i), dt.date(2024, 3 + i % 5, 1), rng.gauss(0, 1), rng.gauss(0, 1), i % 3 // 2) for i in range(200)]
    known = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, fe_1 double, fe_2 double, label int").coalesce(1).cache()
    space = {"maxIter": [2], "maxDepth": [2], "stepSize": [0.1, 0.3], "minInfoGain": [0.0, 0.1], "minInstancesPerNode": [1, 3, 5]}
    for n in (1, 12):
        sc.setLocalProperty("spark.jobGroup.id", f"windowed-{n}")
        scores, card = training.train_windowed(known.drop("label"), known.drop("fe_1", "fe_2"), "2024-08-01", "v", space=space, n=n, folds=2)
        jobs[n] = len(sc.statusTracker().getJobIdsForGroup(f"windowed-{n}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] > 0 and jobs[12] < jobs[1] + 12
    assert scores.count() == 200 and set(card.first().splits) == {"train", "test", "oot"}
    known.unpersist()
