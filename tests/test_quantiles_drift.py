import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from creditloom.operators import drift, ordering, quantiles as Q

D1, D2 = dt.date(2023, 1, 1), dt.date(2023, 2, 1)
QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)


def frame(spark, values, kind="int", name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def numpy_psi(base, cur, buckets=10):
    edges = np.percentile(base, np.linspace(0, 100, buckets + 1))
    shares = [np.histogram(v, bins=edges)[0] / len(v) for v in (base, cur)]
    b, c = (np.where(s == 0, 1e-8, s) for s in shares)
    return float(((b - c) * np.log(b / c)).sum())


def discrete(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(round(p * len(ordered), 9)) - 1, 0)]


@pytest.mark.parametrize("kind", ["int", "double"])
@pytest.mark.parametrize("size", [1, 2, 7, 5000])
def test_exact_quantiles(spark, kind, size):
    rng = random.Random(size)
    values = [rng.choice([0, 0, 0, rng.randrange(-900, 900)]) for _ in range(size)]
    values = values if kind == "int" else [v + rng.choice([0.0, 0.25, rng.random()]) for v in values]
    probs = [0.01, 0.07, 0.5, 0.95, 1.0]
    row = Q.quantile_row(frame(spark, values + [None], kind), ["x"], probs, accuracy=200).first()
    assert row.x == [discrete(values, p) for p in probs]
    tenths = [i / 10 for i in range(11)]
    edges = Q.quantile_row(frame(spark, values, kind), ["x"], tenths, interpolate=True, accuracy=200).first().x
    assert edges == list(np.percentile(np.array(values, dtype=float), np.linspace(0, 100, 11)))


def test_exact_quantiles_of_mixed_columns(spark):
    rng = random.Random(3)
    a, b = [rng.gauss(0, 50) for _ in range(4000)], [rng.randrange(10) for _ in range(4000)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b int")
    rows = {r.feature: r.quantiles for r in Q.quantile_table(df, ["a", "b"], [0.1, 0.5, 0.99]).collect()}
    assert rows == {"a": [discrete(a, p) for p in (0.1, 0.5, 0.99)], "b": [discrete(b, p) for p in (0.1, 0.5, 0.99)]}


def test_a_third_of_the_rows_share_one_value(spark):
    values = [7.5] * 4000 + [float(i) for i in range(8000)]
    assert Q.quantile_row(frame(spark, values, "double"), ["x"], [0.25, 0.5]).first().x == [
        discrete(values, 0.25),
        discrete(values, 0.5),
    ]


@pytest.mark.parametrize("kind", ["int", "double"])
def test_weighted_quantiles_equal_repeated_rows(spark, kind):
    rng = random.Random(11)
    rows = [(rng.randrange(-300, 300), rng.choice([1, 1, 2, 40])) for _ in range(900)]
    rows = rows if kind == "int" else [(v + rng.random(), w) for v, w in rows]
    df = spark.createDataFrame(rows, f"x {kind}, w long")
    repeated = [v for v, w in rows for _ in range(w)]
    probs = [0.01, 0.5, 0.95]
    got = Q.quantile_row(df, ["x"], probs, weight="w", accuracy=200).first().x
    assert got == [discrete(repeated, p) for p in probs]


def test_approx_quantiles_within_rank_error(spark):
    values = list(range(10000))
    for p, q in zip([0.05, 0.5, 0.9], Q.quantile_row(frame(spark, values), ["x"], [0.05, 0.5, 0.9], method="approx", accuracy=100).first().x):
        assert abs(q - p * 10000) <= 10000 / 100
    with pytest.raises(ValueError):
        Q.quantile_table(frame(spark, values), ["x"], [0.5], method="approx", interpolate=True)


def test_different_probabilities_per_column_and_empty_columns(spark):
    df = spark.createDataFrame([(1, 2.0, None), (3, 4.0, None)], "a int, b double, c int")
    row = Q.quantile_row(df, {"a": [0.5], "b": [0.01, 1.0], "c": [0.5]}).first()
    assert row.asDict() == {"a": [1.0], "b": [2.0, 4.0], "c": None}


def test_caps(spark):
    values = list(range(1, 101)) + [None]
    capped = Q.cap_by_quantile(frame(spark, values), "x", 0.05, 0.9)
    got = [r.x for r in capped.collect()]
    assert (min(v for v in got if v is not None), max(v for v in got if v is not None)) == (5.0, 90.0)
    assert got[-1] is None and got[49] == 50.0
    again = Q.cap_by_quantile(capped, "x", 0.05, 0.9)
    assert sorted(v for v in got if v) == sorted(r.x for r in again.collect() if r.x)
    assert [r.x for r in Q.cap_by_quantile(frame(spark, [4, 4, 4]), "x").collect()] == [4.0] * 3
    assert [r.x for r in Q.cap_by_quantile(frame(spark, [None, None]), "x").collect()] == [None] * 2


def test_caps_fitted_on_other_rows(spark):
    out = Q.cap_by_quantile(frame(spark, [-5, 50]), "x", 0.01, 0.95, fit_df=frame(spark, [0, 10]))
    assert [r.x for r in out.collect()] == [0.0, 10.0]


def test_impute_median(spark):
    out = Q.impute_median(frame(spark, [1.0, None, 9.0, 5.0], "double"), "x")
    assert [r.x for r in out.collect()] == [1.0, 5.0, 9.0, 5.0]


def two(spark, base, cur):
    return frame(spark, base, "double", "fe_1"), frame(spark, cur, "double", "fe_1")


@pytest.mark.parametrize(
    "base, cur",
    [
        ([1.0, 2.0, 3.0, 4.0] * 5, [1.0, 2.0, 3.0, 4.0] * 5),
        ([5.0] * 20, [5.0] * 7 + [6.0] * 3),
        ([0.0] * 50 + [1.0] * 3, [0.0] * 5 + [1.0] * 30),
        ([float(i) for i in range(100)], [float(i) for i in range(-50, 150)]),
    ],
)
def test_psi_equals_numpy(spark, base, cur):
    got = drift.psi(*two(spark, base, cur)).first()
    assert got.feature == "fe_1"
    assert got.psi == pytest.approx(numpy_psi(np.array(base), np.array(cur)), rel=1e-12, abs=1e-15)


@QUICK
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=80), st.lists(st.integers(-8, 8), min_size=1, max_size=80))
def test_psi_equals_numpy_on_any_ties(spark, base, cur):
    base, cur = [float(v) for v in base], [float(v) for v in cur]
    got = drift.psi(*two(spark, base, cur)).first().psi
    assert got == pytest.approx(numpy_psi(np.array(base), np.array(cur)), rel=1e-9, abs=1e-12)


def test_psi_leaves_out_empty_sides_and_nulls(spark):
    assert drift.psi(*two(spark, [1.0, 2.0], [None])).count() == 0
    assert drift.psi(*two(spark, [None], [1.0])).count() == 0
    assert drift.psi(*two(spark, [1.0, 2.0, None], [1.0, None, 2.0])).first().psi == 0.0


def test_psi_per_snapshot_and_decision(spark):
    base = frame(spark, [float(i) for i in range(50)], "double", "fe_1")
    rows = [(D1, float(i)) for i in range(50)] + [(D2, 49.0)] * 20
    cur = spark.createDataFrame(rows, "snapshot_date date, fe_1 double")
    psi = drift.psi_by_snapshot(base, cur)
    got = {r.snapshot_date: r.psi for r in psi.collect()}
    assert got[D1] == 0.0
    assert got[D2] == pytest.approx(numpy_psi(np.arange(50.0), np.array([49.0] * 20)))
    summary = drift.psi_summary(psi, ["snapshot_date"])
    decisions = {r.snapshot_date: r.decision for r in drift.drift_decision(summary).collect()}
    assert decisions == {D1: "continue_pipeline", D2: "trigger_retrain"}
    assert drift.psi_global(psi).first().psi_max == round(got[D2], 6)
    assert drift.psi_global(psi.limit(0)).first().psi_max == 0.0


def test_decision_thresholds(spark):
    df = spark.createDataFrame([(1, 0.1999), (2, 0.20), (3, None)], "i int, psi_max double")
    assert [r.decision for r in drift.drift_decision(df).orderBy("i").collect()] == [
        "continue_pipeline",
        "trigger_retrain",
        "trigger_retrain",
    ]
    assert drift.drift_decision(df, missing=0.0).orderBy("i").collect()[2].decision == "continue_pipeline"


def test_baseline_modes(spark):
    df = spark.createDataFrame([(D1, 1, 2), (D2, 3, 4)], "feature_snapshot_date date, fe_1 int, other int")
    assert [r.fe_1 for r in drift.baseline(df, "latest").collect()] == [3]
    assert drift.baseline(df).columns == ["fe_1"] and drift.baseline(df).count() == 2
    with pytest.raises(ValueError):
        drift.baseline(df, "first")


def test_total_before_with_a_hot_group_and_null_keys(spark):
    rng = random.Random(1)
    keys = ["hot"] * 2000 + ["b"] * 50 + [None] * 30
    rows = [(k, rng.randrange(40), i, rng.randrange(3)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, v int, i int, n int")
    out = ordering.with_total_before(df, ["k"], [F.desc("v"), F.col("i")], F.col("n"), "before").collect()
    expected = {}
    for key in ("hot", "b", None):
        total = 0
        for k, v, i, n in sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2])):
            expected[i] = total
            total += n
    assert {r.i: r.before for r in out} == expected


def test_bigints_are_not_rounded(spark):
    big = 2**53 + 1
    df = frame(spark, [big - 2, big, big + 2], "long")
    assert Q.quantile_row(df, ["x"], [0.5, 1.0]).first().x == [big, big + 2]


@pytest.mark.parametrize("kind", ["long", "double"])
def test_many_passes(spark, monkeypatch, kind):
    """Few bins a pass, values of very different size, infinities, and whole numbers a double cannot hold."""
    monkeypatch.setattr(Q, "GROUPS", 16)
    rng = random.Random(4)
    if kind == "long":
        values = [rng.choice([-1, 1]) * rng.randrange(2 ** rng.choice([3, 20, 62])) for _ in range(500)] + [2**62, 2**62 + 1, 2**62 + 3] * 90
        values += [-(2**63), 2**63 - 1]
    else:
        values = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(500)] + [float("inf")] * 40 + [float("-inf")] * 3
        values += [5e-324, 1e-323, 0.0, 1.7e308, -1.7e308] * 30
    probs = [0.001, 0.01, 0.3, 0.5, 0.52, 0.77, 0.9, 0.999, 1.0]
    got = Q.quantile_row(frame(spark, values, kind), ["x"], probs).first().x
    assert got == [discrete(values, p) for p in probs]


@QUICK
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=200), st.floats(0.01, 1.0))
def test_any_doubles(spark, values, p):
    p = round(p, 2)
    got = Q.quantile_row(frame(spark, values, "double"), ["x"], [p]).first().x
    assert got == [discrete(values, p)]


def test_nan_is_missing(spark):
    nan = float("nan")
    same = [float(i) for i in range(100)]
    cols = ["fe_1"]
    plain, dirty = (spark.createDataFrame([(v,) for v in vs], "fe_1 double") for vs in (same, same + [nan] * 50))
    for base, current in ((plain, dirty), (dirty, plain)):
        assert drift.psi(base, current, cols).first().psi == 0
    assert Q.quantile_row(dirty, cols, [0.95]).first().fe_1 == [94.0]
    assert Q.quantile_row(dirty, cols, [0.95], method="approx", accuracy=10000).first().fe_1 == [94.0]
    capped = [r.fe_1 for r in Q.cap_by_quantile(dirty, cols, 0.1, 0.9).collect()]
    assert max(v for v in capped if v == v) == 89.0 and sum(v != v for v in capped) == 50
    assert Q.impute_median(dirty, "fe_1").where("fe_1 = 49.0").count() == 51
    for weight in (None, "w"):
        from creditloom.operators import modeling as M

        rows = [M.fit_scaler(df.withColumn("w", F.lit(1)), cols, weight).first().fe_1 for df in (plain, dirty)]
        assert rows[0].mean == rows[1].mean == 49.5 and abs(rows[0]["std"] - rows[1]["std"]) < 1e-9


def test_edges_with_two_rows_for_a_feature_are_an_error(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "fe_1 double")
    edges = Q.decile_edges(df, ["fe_1"])
    with pytest.raises(Exception, match="more than one row of edges"):
        drift.histogram(df, edges.union(edges), ["fe_1"]).collect()
