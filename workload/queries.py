"""Spark queries: every operator of the library over the lending views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditloom import constants as K
from creditloom.functions import records as R, values as VF
from creditloom.operators import (
    clean,
    drift,
    features,
    labels as L,
    modeling as M,
    quantiles as Q,
    registry,
    report,
    snapshots as S,
)
from creditloom.plans import etl, monitoring, training
from creditloom.sources import readers, writers
from creditloom.sources.staging import fresh_path, stage
from workload import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PANEL = ["Customer_ID", "snapshot_date"]
FES = K.CLICKSTREAM_FEATURES
BASE_END = "1998-01-01"
WEIGHTS = {f"fe_{i}": round(0.05 * i, 2) for i in range(1, 21)}
INTERCEPT = 0.1


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def joined_types(df: DataFrame) -> DataFrame:
    return df.withColumn("Loan_Types_Array", F.array_join("Loan_Types_Array", "|"))


def silver_financials(spark, sf, months=None):
    return clean.clean_financials(V.financials(spark, sf, months))


def silver_attributes(spark, sf, months=None):
    return clean.clean_attributes(V.attributes(spark, sf, months))


def silver_clickstream(spark, sf, months=None):
    return clean.clean_clickstream(V.clickstream(spark, sf, months))


def silver_loans(spark, sf):
    return clean.clean_loans(V.loans(spark, sf))


def run_rows(spark, sf):
    return registry.run_table(V.run_log(spark, sf))


def artifact_rows(spark, sf):
    """Parsed artefacts, with the snapshot date as text like the run log's."""
    parsed = registry.parse_artifacts(V.artifacts(spark, sf))
    return parsed.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


# --- scans and snapshots ----------------------------------------------------------


@query
def scan_snapshot(spark, sf):
    return readers.read_snapshot(V.clickstream(spark, sf), "1997-06-01")


@query
def latest_rows(spark, sf):
    return S.at_latest(V.clickstream(spark, sf))


@query
def row_count(spark, sf):
    return S.row_count(V.loans(spark, sf))


@query
def snapshot_dates(spark, sf):
    return S.snapshots(V.clickstream(spark, sf)).orderBy("snapshot_date")


@query
def snapshot_counts(spark, sf):
    return V.clickstream(spark, sf).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def latest_snapshot(spark, sf):
    return S.latest_snapshot(V.clickstream(spark, sf))


@query
def month_spine(spark, sf):
    return S.month_spine_of(V.loans(spark, sf))


@query
def backfill_range(spark, sf):
    latest = S.latest_snapshot(V.clickstream(spark, sf))
    start, end = S.trailing_year(F.col("snapshot_date"))
    return latest.select(F.explode(S.month_starts(start, end)).alias("snapshot_date"))


@query
def split_windows(spark, sf):
    latest = S.latest_snapshot(V.clickstream(spark, sf))
    return latest.select(*[c.alias(n) for n, c in S.split_windows(F.col("snapshot_date")).items()])


@query
def as_of(spark, sf):
    return S.as_of(V.clickstream(spark, sf), "1997-06-01")


@query
def between_dates(spark, sf):
    return S.between_dates(V.clickstream(spark, sf), "1996-01-01", "1996-12-31")


# --- cleaning ---------------------------------------------------------------------


@query
def null_tokens(spark, sf):
    df = clean.null_tokens(V.financials(spark, sf))
    return df.select(*PANEL, *[c for c, t in df.dtypes if t == "string" and c not in PANEL])


@query
def clean_numbers(spark, sf):
    df = clean.null_tokens(V.financials(spark, sf))
    df = clean.clean_numbers(df, ["Annual_Income", "Amount_invested_monthly", "Outstanding_Debt"])
    df = clean.clean_numbers(df, K.FINANCIAL_COUNTS, decimal=False)
    return df.select(
        *PANEL, "Annual_Income", "Amount_invested_monthly", "Outstanding_Debt", *K.FINANCIAL_COUNTS
    )


@query
def cast_columns(spark, sf):
    types = {"Annual_Income": "double", "Num_of_Loan": "int", "Interest_Rate": "string"}
    return clean.cast_columns(V.financials(spark, sf).select(*PANEL, *types), types)


@query
def whitelist_behaviour(spark, sf):
    df = V.financials(spark, sf).select(*PANEL, "Payment_Behaviour")
    return clean.whitelist(df, "Payment_Behaviour", K.PAYMENT_BEHAVIOURS)


@query
def split_loan_types(spark, sf):
    types = F.col("Loan_Types_Array")
    return silver_financials(spark, sf).select(
        *PANEL, F.array_join(types, "|").alias("loan_types"), VF.array_length(types).alias("n_types")
    )


@query
def history_months(spark, sf):
    months = VF.history_months(F.col("Credit_History_Age"))
    return silver_financials(spark, sf).select(*PANEL, months.alias("history_months"))


@query
def fill_defaults(spark, sf):
    defaults = {"Credit_Mix": "Unknown", "Payment_Behaviour": "Unknown", "Changed_Credit_Limit": 0.0}
    return clean.fill_defaults(silver_financials(spark, sf), defaults).select(*PANEL, *defaults)


@query
def ratios_flags(spark, sf):
    debt, income = F.col("Outstanding_Debt"), F.col("Annual_Income")
    return silver_financials(spark, sf).select(
        *PANEL,
        F.round(F.log1p(income), 9).alias("log_income"),
        VF.smoothed_ratio(debt, income).alias("debt_to_income"),
        VF.smoothed_ratio(F.col("Monthly_Balance"), debt, num_add=1.0).alias("balance_to_debt"),
        VF.flag_nonzero(F.col("Changed_Credit_Limit")).alias("limit_changed"),
    )


@query
def require_keys(spark, sf):
    return clean.require_keys(silver_attributes(spark, sf), ["Customer_ID", "SSN"]).select(*PANEL, "SSN")


@query
def require_measure(spark, sf):
    df = silver_financials(spark, sf).select(*PANEL, "Monthly_Balance")
    return df.where(F.col("Monthly_Balance").isNotNull())


@query
def valid_age(spark, sf):
    df = clean.null_tokens(V.attributes(spark, sf).select(*PANEL, "Age"), K.ATTRIBUTE_NULL_TOKENS)
    return clean.null_outside(clean.clean_numbers(df, ["Age"], decimal=False), "Age", 0, 100)


@query
def valid_ssn(spark, sf):
    return clean.null_unless_match(V.attributes(spark, sf).select(*PANEL, "SSN"), "SSN", K.SSN_PATTERN)


@query
def clean_financials(spark, sf):
    return joined_types(silver_financials(spark, sf))


@query
def clean_attributes(spark, sf):
    return silver_attributes(spark, sf)


@query
def clean_clickstream(spark, sf):
    return silver_clickstream(spark, sf)


@query
def clean_loans(spark, sf):
    return silver_loans(spark, sf)


# --- attributes -------------------------------------------------------------------


@query
def age_bands(spark, sf):
    df = clean.null_outside(silver_attributes(spark, sf), "Age", 18, 75, inclusive=True)
    return df.select(*PANEL, F.col("Age").alias("age"), VF.age_band(F.col("Age")).alias("age_group"))


@query
def category_index(spark, sf):
    return features.category_index(silver_attributes(spark, sf), ["Occupation"])


@query
def one_hot(spark, sf):
    """The vectors shown as the position of their 1 (null for all zeros) and their length."""
    df = features.one_hot(silver_attributes(spark, sf), ["Occupation"], drop=False)
    return _shown(df, "Occupation").select(*PANEL, "Occupation", "occupation_position", "occupation_size")


def _shown(df, column):
    """A one-hot vector as the position of its 1 (null for all zeros) and its length."""
    vec = M.vector_to_array(f"{column}_vec")
    position = F.nullif(F.array_position(vec, 1.0), F.lit(0)) - 1
    name = column.lower()
    return df.withColumns({f"{name}_position": position, f"{name}_size": F.size(vec)})


@query
def one_hot_weighted(spark, sf):
    """Categories counted by rows' multiplicities (here: the length of the loan list), for three columns."""
    df = silver_financials(spark, sf).withColumn("w", (1 + F.coalesce(VF.array_length(F.col("Loan_Types_Array")), F.lit(0))).cast("bigint"))
    out = features.one_hot(df, K.FINANCIAL_CATEGORIES, drop=False, weight="w")
    for c in K.FINANCIAL_CATEGORIES:
        out = _shown(out, c)
    shown = [f"{c.lower()}_{part}" for c in K.FINANCIAL_CATEGORIES for part in ("position", "size")]
    return out.select(*PANEL, *shown)


# --- labels -----------------------------------------------------------------------


@query
def label_store(spark, sf):
    return L.label_store(silver_loans(spark, sf))


@query
def label_store_with_def(spark, sf):
    return L.label_store(silver_loans(spark, sf), dpd=60, mob=3, with_def=True)


@query
def bad_rate_by_mob(spark, sf):
    return rounded(L.bad_rate_by(silver_loans(spark, sf)), 10, "bad_rate")


@query
def cohort_filter(spark, sf):
    return L.started_before(silver_loans(spark, sf), "1996-01-01").select(
        "loan_id", "Customer_ID", "installment_num", "dpd"
    )


@query
def at_installment(spark, sf):
    return L.at_installment(silver_loans(spark, sf), 4).select(
        "loan_id", "Customer_ID", "loan_start_date", "dpd"
    )


@query
def fill_zero(spark, sf):
    cols = ["loan_id", "Customer_ID", "snapshot_date", "overdue_amt", "dpd", "installments_missed"]
    return clean.fill_numeric_zero(silver_loans(spark, sf).select(*cols, "first_missed_date"))


@query
def backfill_all_months(spark, sf):
    loans = silver_loans(spark, sf)
    return S.backfill(loans, S.month_spine_of(loans), L.label_store)


# --- joins ------------------------------------------------------------------------


@query
def multi_snapshot_join(spark, sf):
    fin = silver_financials(spark, sf).drop("Loan_Types_Array")
    return S.multi_snapshot_join(fin, silver_loans(spark, sf))


@query
def valid_slices(spark, sf):
    return S.valid_slices(V.clickstream(spark, sf), V.loans(spark, sf))


@query
def union_slices(spark, sf):
    """The panel cut into three stretches and put together again."""
    clk = V.clickstream(spark, sf)
    early, middle = S.as_of(clk, "1995-12-31"), S.between_dates(clk, "1996-01-01", "1997-12-31")
    late = clk.where(F.col("snapshot_date") > readers.as_date("1997-12-31"))
    return S.union_slices([late, early.select(*PANEL, *reversed(FES)), middle])


@query
def with_constants(spark, sf):
    clk = V.clickstream(spark, sf).select(*PANEL).withColumnRenamed("snapshot_date", "feature_snapshot_date")
    df = clean.with_constants(clk, model_name="credit_model")
    return df.withColumn("scored_on", readers.as_date("1998-01-01"))


@query
def join_sources(spark, sf):
    """Attributes and clickstream of the same labelled customer month, equal outcomes as ``copies``."""
    labelled = stage(S.outcome_counts(silver_loans(spark, sf)), "outcomes")
    sources = [silver_attributes(spark, sf), silver_clickstream(spark, sf)]
    joined = S.join_sources([S.join_outcomes(df, labelled) for df in sources], [*S.LABELLED_KEYS, "copies"])
    return joined.withColumn("copies", F.col("copies") * F.col("copies"))


@query
def attach_labels(spark, sf):
    """Features and labels of the same customer month; every month with every label is ``attach_label_counts``."""
    labels = L.label_store(silver_loans(spark, sf))
    return S.attach_labels(V.clickstream(spark, sf), labels, on=PANEL, columns=[*PANEL, "fe_1", "fe_2"])


@query
def attach_label_counts(spark, sf):
    labels = L.label_store(silver_loans(spark, sf))
    return S.attach_label_counts(V.clickstream(spark, sf).select(*PANEL, "fe_1"), labels)


@query
def attach_features(spark, sf):
    return S.attach_features(L.label_store(silver_loans(spark, sf)), V.clickstream(spark, sf))


@query
def time_split(spark, sf):
    clk = V.clickstream(spark, sf).select(*PANEL)
    train_date = S.latest_snapshot(clk).scalar()
    return M.time_split(clk, S.split_windows(train_date))


# --- quantiles --------------------------------------------------------------------


@query
def quantiles(spark, sf):
    return Q.quantiles(V.clickstream(spark, sf), FES, [0.01, 0.5, 0.95]).withColumn("value", F.col("value").cast("double"))


def components(spark, sf):
    """The embeddings' components as double columns e_0 .. e_63."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return vectors.select("vec_id", *[F.get("embedding", i).cast("double").alias(f"e_{i}") for i in range(64)])


COMPONENTS = [f"e_{i}" for i in range(64)]


def with_nan(df):
    """Every seventh row NaN."""
    hit = F.col("vec_id") % 7 == 0
    return df.withColumns({c: F.when(hit, F.lit(float("nan"))).otherwise(F.col(c)) for c in COMPONENTS})


@query
def quantiles_real(spark, sf):
    return Q.quantiles(components(spark, sf), COMPONENTS, [0.01, 0.5, 0.95])


@query
def quantiles_nan(spark, sf):
    return Q.quantiles(with_nan(components(spark, sf)), COMPONENTS, [0.01, 0.5, 0.95])


@query
def quantiles_bigint(spark, sf):
    """Keys beyond the whole numbers that doubles hold."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    items = spark.read.parquet(f"{sf}/lineitem.parquet")
    return Q.quantiles(items.select(*[(F.col(k).cast("bigint") + 2**53 + 1).alias(k) for k in keys]), keys, [0.1, 0.5, 0.999])


@query
def psi_real(spark, sf):
    """Drift between the even and the odd vectors, every seventh of them NaN."""
    rows = with_nan(components(spark, sf))
    base, current = rows.where("vec_id % 2 = 0"), rows.where("vec_id % 2 <> 0")
    return rounded(drift.psi(base, current, COMPONENTS), 9, "psi")


@query
def impute_median(spark, sf):
    df = silver_financials(spark, sf).select(*PANEL, "Outstanding_Debt")
    return Q.impute_median(df, "Outstanding_Debt")


@query
def cap_by_quantile(spark, sf):
    return Q.cap_by_quantile(stage(V.clickstream(spark, sf), "clickstream"), FES)


# --- features ---------------------------------------------------------------------


@query
def financial_features(spark, sf):
    df = stage(S.multi_snapshot_join(silver_financials(spark, sf), silver_loans(spark, sf)), "labelled")
    df = joined_types(features.financial_features(df, encode=False))
    return rounded(df, 9, "log_Annual_Income")


@query
def attribute_features(spark, sf):
    df = S.multi_snapshot_join(silver_attributes(spark, sf), silver_loans(spark, sf))
    return features.attribute_features(df, encode=False)


@query
def clickstream_features(spark, sf):
    df = S.multi_snapshot_join(silver_clickstream(spark, sf), silver_loans(spark, sf))
    return features.clickstream_features(stage(df, "labelled"))


def build_store(spark, sf, **options):
    """Feature store of the views; the customer months behind three of them are built once."""
    months = stage(V.customer_months(spark, sf), "months")
    return features.feature_store(
        silver_financials(spark, sf, months),
        silver_attributes(spark, sf, months),
        silver_clickstream(spark, sf, months),
        silver_loans(spark, sf),
        **options,
    )


@query
def feature_store(spark, sf):
    return rounded(build_store(spark, sf, encode=False), 9, "log_Annual_Income")


@query
def feature_store_encoded(spark, sf):
    """The store with its one-hot vectors, shown as arrays."""
    df = build_store(spark, sf)
    vectors = [c for c in df.columns if c.endswith("_vec")]
    return df.withColumns({c: M.vector_to_array(c) for c in vectors})


@query
def feature_store_approx(spark, sf):
    """The store with sketched statistics (rank error 1 %)."""
    return build_store(spark, sf, encode=False, method="approx", accuracy=100)


# --- drift ------------------------------------------------------------------------


def base_and_current(spark, sf):
    """Baseline and current months; staged, as drift reads them once to fit and once to count."""
    clk = stage(V.clickstream(spark, sf), "clickstream")
    cut = readers.as_date(BASE_END)
    return clk.where(F.col("snapshot_date") < cut), clk.where(F.col("snapshot_date") >= cut)


@query
def baseline_all(spark, sf):
    return drift.baseline(V.clickstream(spark, sf), "all", "snapshot_date")


@query
def baseline_latest(spark, sf):
    return drift.baseline(V.clickstream(spark, sf), "latest", "snapshot_date")


@query
def decile_edges(spark, sf):
    base, _ = base_and_current(spark, sf)
    edges = Q.decile_edges(base, FES)
    return rounded(edges.select("feature", F.posexplode("edges").alias("edge_no", "edge")), 9, "edge")


@query
def histogram(spark, sf):
    base, current = base_and_current(spark, sf)
    return drift.histogram_rows(drift.histogram(current, Q.decile_edges(base, FES), FES))


@query
def psi(spark, sf):
    return rounded(drift.psi(*base_and_current(spark, sf), FES), 10, "psi")


def snapshot_psi(spark, sf):
    return drift.psi_by_snapshot(*base_and_current(spark, sf), FES)


@query
def psi_by_snapshot(spark, sf):
    return rounded(snapshot_psi(spark, sf), 10, "psi")


def snapshot_summary(spark, sf):
    return drift.psi_summary(snapshot_psi(spark, sf), ["snapshot_date"])


@query
def psi_summary(spark, sf):
    return rounded(snapshot_summary(spark, sf), 10, "psi_mean", "psi_max")


@query
def psi_global(spark, sf):
    return drift.psi_global(snapshot_psi(spark, sf))


@query
def drift_decision(spark, sf):
    return rounded(drift.drift_decision(snapshot_summary(spark, sf)), 10, "psi_mean", "psi_max")


# --- registry ---------------------------------------------------------------------


@query
def best_per_snapshot(spark, sf):
    return registry.best_per_snapshot(run_rows(spark, sf))


@query
def rank_runs(spark, sf):
    return registry.rank_runs(run_rows(spark, sf))


@query
def latest_run(spark, sf):
    return registry.latest_run(run_rows(spark, sf))


@query
def run_tags(spark, sf):
    runs = registry.tag(V.run_log(spark, sf), "model_type")
    return registry.tag(runs, "stage", "none").select("run_id", "model_type", "stage")


@query
def artifact_semi(spark, sf):
    runs = run_rows(spark, sf).select("run_id", "snapshot_date", "model_type")
    return registry.with_artifact(runs, artifact_rows(spark, sf))


@query
def artifact_anti(spark, sf):
    runs = run_rows(spark, sf).select("run_id", "snapshot_date", "model_type")
    return registry.without_artifact(runs, artifact_rows(spark, sf))


@query
def asof_fallback(spark, sf):
    best = registry.best_per_snapshot(run_rows(spark, sf))
    return registry.asof_fallback(best, artifact_rows(spark, sf)).select(
        "snapshot_date", "run_id", "model_type", "fallback_snapshot"
    )


@query
def promotions(spark, sf):
    return registry.promotions(run_rows(spark, sf), artifact_rows(spark, sf))


@query
def promotions_bad_tags(spark, sf):
    """The run log with the tags of every third run's month spoilt."""
    runs = run_rows(spark, sf)
    spoilt = F.concat(F.lit("latest-"), F.substring("snapshot_date", 1, 7))
    third = F.substring("snapshot_date", 6, 2).cast("int") % 3 == 0
    runs = runs.withColumn("snapshot_date", F.when(third, spoilt).otherwise(F.col("snapshot_date")))
    return registry.promotions(runs, artifact_rows(spark, sf))


@query
def model_for_snapshot(spark, sf):
    return registry.model_for_snapshot(registry.parse_artifacts(V.artifacts(spark, sf)))


@query
def metrics_long(spark, sf):
    return registry.metrics_long(V.run_log(spark, sf))


# --- report -----------------------------------------------------------------------


@query
def auc_series(spark, sf):
    return report.auc_series(registry.metrics_long(V.run_log(spark, sf)))


@query
def metric_pivot(spark, sf):
    """PSI matrix, features by month, its cells as rows."""
    metrics = snapshot_psi(spark, sf).select(
        F.concat(F.lit("psi_"), "feature").alias("metric_name"),
        F.col("snapshot_date").cast("string").alias("snapshot_date"),
        F.round("psi", 10).alias("value"),
    )
    return report.pivot_cells(report.metric_pivot(metrics, short_names=True))


@query
def null_profile(spark, sf):
    df = silver_financials(spark, sf)
    return rounded(report.null_profile(df, K.FINANCIAL_DOUBLES), 9, "null_pct")


@query
def metric_prefix(spark, sf):
    metrics = report.metric_filter(registry.metrics_long(V.run_log(spark, sf)), prefix="psi_")
    return metrics.withColumn("metric_name", R.strip_prefix(F.col("metric_name"), "psi_"))


# --- evaluation -------------------------------------------------------------------


@query
def auc_by_model(spark, sf):
    return rounded(M.auc(V.scored(spark, sf), by=["model_name"]), 10, "auc")


@query
def auc_global(spark, sf):
    return rounded(M.auc(V.scored(spark, sf)), 10, "auc")


@query
def gini(spark, sf):
    return rounded(M.evaluate(V.scored(spark, sf), by="model_name"), 10, "auc")


@query
def split_stats(spark, sf):
    return M.split_stats(M.stratified_split(V.ml(spark, sf), "id"))


@query
def prediction_stats(spark, sf):
    stats = M.prediction_stats(V.scored(spark, sf), ["model_name"])
    return rounded(stats, 8, "pred_mean", "pred_std")


@query
def hash_split(spark, sf):
    return M.stratified_split(V.ml(spark, sf), "id").select("id", "label", "split")


@query
def exact_split(spark, sf):
    return M.exact_stratified_split(V.ml(spark, sf), "id").select("id", "label", "split")


@query
def label_classes(spark, sf):
    return M.label_classes(V.ml(spark, sf))


@query
def fit_scaler(spark, sf):
    return rounded(M.scaler_table(M.fit_scaler(V.ml(spark, sf), FES)), 10, "mean", "std")


@query
def apply_scaler(spark, sf):
    df = V.ml(spark, sf)
    return rounded(M.apply_scaler(df, M.fit_scaler(df, FES)), 8, *FES).select("id", *FES)


@query
def linear_score(spark, sf):
    df = M.linear_score(V.ml(spark, sf), WEIGHTS, INTERCEPT)
    return rounded(df, 10, "prediction").select("id", "prediction")


@query
def evaluate_splits(spark, sf):
    df = rounded(M.linear_score(V.ml(spark, sf), WEIGHTS, INTERCEPT), 10, "prediction")
    return rounded(M.evaluate(M.stratified_split(df, "id")), 10, "auc")


# --- models -----------------------------------------------------------------------


def panel_and_labels(spark, sf):
    """Clickstream and label store, written once for the plans that read them many times."""
    return stage(V.clickstream(spark, sf), "clickstream"), stage(L.label_store(silver_loans(spark, sf)), "labels")


@query
def train_and_select(spark, sf):
    """Train on the history up to two snapshots, log the runs and choose what to serve."""
    clk, labels = panel_and_labels(spark, sf)
    models, runs = fresh_path(spark, "models"), fresh_path(spark, "runs")
    days = ["1997-01-01", "1998-01-01"]
    history = training.training_history(clk, labels, days)
    for day in days:
        training.train_snapshot(spark, clk, labels, "logistic_regression", day, models, runs, history=history)
    out = fresh_path(spark, "promotions")
    return training.select_models(spark, runs, models, out, "1997-01-01", "1998-12-01").drop("run_id")


@query
def score_and_monitor(spark, sf):
    """Score and monitor the months of a year, each with the model trained on its history."""
    clk, labels = panel_and_labels(spark, sf)
    models, runs = fresh_path(spark, "models"), fresh_path(spark, "runs")
    months = S.month_spine(spark, "1998-01-01", "1998-12-01")
    # twelve rows
    days = [r["snapshot_date"] for r in months.orderBy("snapshot_date").collect()]
    history = training.training_history(clk, labels, days)
    for day in days:
        training.train_snapshot(spark, clk, labels, "logistic_regression", day, models, runs, history=history)
    return monitoring.infer(
        spark,
        clk,
        drift.baseline(S.as_of(clk, "1997-12-01")),
        training.list_artifacts(spark, models),
        models,
        months,
        fresh_path(spark, "lake"),
        runs,
    )


@query
def windowed_training(spark, sf):
    """The windowed flow as it is by default, boosted trees over 100 points of the search space; its card, splits as rows."""
    labels = L.label_store(silver_loans(spark, sf))
    _, card = training.train_windowed(V.clickstream(spark, sf), labels, "1998-01-01", "v1")
    return card.select("model_version", "data_dates", F.explode("splits").alias("split", "s"), "hp_params").select("*", "s.*").drop("s")


def held_out_scores(spark, sf, train) -> DataFrame:
    rows = M.stratified_split(V.ml(spark, sf), "id")
    model = train(rows.where(F.col("split") == "train"), FES)
    return M.score(rows, model, "model", ("id", "label", "split"))


@query
def lr_scores(spark, sf):
    return held_out_scores(spark, sf, M.train_lr)


@query
def gbt_scores(spark, sf):
    """Scores of boosted trees as one native expression."""
    rows = M.stratified_split(V.ml(spark, sf), "id")
    model = M.train_gbt(rows.where(F.col("split") == "train"), FES)
    return M.tree_score(rows, model, "model", ("id", "label", "split"))


@query
def gbt_native(spark, sf):
    """Boosted trees scored natively and by the fitted transformer: rows, and the largest difference to 12 places."""
    rows = M.stratified_split(V.ml(spark, sf), "id")
    model = M.train_gbt(rows.where(F.col("split") == "train"), FES, maxIter=20)
    native = M.tree_score(rows, model, "model", ("id",)).select("id", F.col("prediction").alias("native"))
    both = M.score(rows, model, "model", ("id",)).join(native, "id")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.round(F.abs(F.col("native") - F.col("prediction")), 12)).alias("difference"))


@query
def gbt_leaves(spark, sf):
    """Every tree's leaves recomputed from the training rows: rows that fall to them, and whether numbers and means agree."""
    rows = M.stratified_split(V.ml(spark, sf), "id")
    train = rows.where(F.col("split") == "train")
    leaves = M.leaf_statistics(train, M.train_gbt(train, FES, maxIter=20))
    agree = (F.col("n") == F.col("n_rows")) & (F.abs(F.col("prediction") - F.col("mean_residual")) < 1e-9)
    return leaves.groupBy("tree").agg(F.sum("n_rows").alias("n_rows"), F.min(F.coalesce(agree, F.lit(False))).alias("agree"))


@query
def lr_optimum(spark, sf):
    """Whether the fit meets the optimum condition: per feature, mean residual times value plus penalty is 0."""
    rows = V.ml(spark, sf)
    model = M.train_lr(rows, FES, C=0.01, tol=1e-10)
    fitted = model.stages[-1]
    scaled = M.apply_scaler(rows, M.fit_scaler(rows, FES)).select("id", *FES)
    residual = M.score(rows, model, "lr", ("id", "label")).withColumn("r", F.col("prediction") - F.col("label"))
    joined = scaled.join(residual, "id")
    penalty = fitted.getRegParam()
    slopes = [
        F.struct(F.lit(c).alias("feature"), (F.abs(F.avg(F.col("r") * F.col(c)) + penalty * float(w)) < 1e-6).alias("optimal"))
        for c, w in zip(FES, fitted.coefficients)
    ]
    return joined.agg(F.array(*slopes).alias("slopes")).select(F.inline("slopes"))


@query
def model_roundtrip(spark, sf):
    """Scores of a saved and loaded model: rows, and the largest difference."""
    rows = V.ml(spark, sf)
    model = M.train_lr(rows, FES)
    loaded = M.load_model(M.save_model(model, fresh_path(spark, "model")))
    before = M.score(rows, model, "lr", ("id",)).withColumnRenamed("prediction", "before")
    both = before.join(M.score(rows, loaded, "lr", ("id",)), "id")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("before") - F.col("prediction"))).alias("difference"))


@query
def model_card(spark, sf):
    """The card of the fixed weights, its splits as rows."""
    rows = rounded(M.linear_score(V.ml(spark, sf), WEIGHTS, INTERCEPT), 10, "prediction")
    rows = M.stratified_split(rows, "id")
    windows = S.split_windows(readers.as_date("1998-01-01"))
    card = M.model_card("fixed", windows, M.split_stats(rows), rounded(M.evaluate(rows), 10, "auc"), {"intercept": str(INTERCEPT)})
    shown = card.select("model_version", F.col("data_dates.oot_start_date").alias("oot_start"), F.explode("splits").alias("split", "s"), "hp_params")
    return shown.select("model_version", "oot_start", "split", "s.*", F.col("hp_params")["intercept"].alias("intercept"))


@query
def run_log(spark, sf):
    """Run records written and read back, as metrics."""
    when = dt.datetime(1998, 1, 1)
    path = fresh_path(spark, "runs")
    means = rounded(M.prediction_stats(V.scored(spark, sf), ["model_name"]), 8, "pred_mean", "pred_std").collect()  # one row per model
    for r in means:
        M.log_run(spark, path, M.RunRecord(r["model_name"], when, {"snapshot_date": "1998-01-01"}, {"pred_mean": r["pred_mean"], "none": None}, {}))
    return registry.metrics_long(readers.read_runs(spark, path))


@query
def alert_latest(spark, sf):
    return monitoring.alert(V.run_log(spark, sf).withColumn("start_time", F.col("start_time").cast("timestamp")))


@query
def global_decision(spark, sf):
    """Decision over all months and features together."""
    return drift.drift_decision(drift.psi_global(snapshot_psi(spark, sf)))


@query
def report_files(spark, sf):
    """The report of the best runs as files: its AUC table read back."""
    best = registry.best_per_snapshot(run_rows(spark, sf)).select("run_id")
    metrics, out = registry.metrics_long(V.run_log(spark, sf)).join(best, "run_id", "left_semi"), fresh_path(spark, "report")
    parquet, _ = writers.export_metrics(metrics, f"{out}/metrics")
    monitoring.build_report(spark, parquet, out)
    return readers.read_csv(spark, f"{out}/auc").select(F.col("snapshot_date").cast("string"), "run_id", F.round("value", 9).alias("value"))


@query
def salted_attach_labels(spark, sf):
    """Features joined to labels on customer and month, customers with many rows salted."""
    labels = L.label_store(silver_loans(spark, sf))
    return S.attach_labels(V.clickstream(spark, sf), labels, on=PANEL, columns=[*PANEL, "fe_1", "fe_2"], salt=True)


@query
def runs_compacted(spark, sf):
    """A run log written in three batches and compacted: files and runs by day."""
    log, path = V.run_log(spark, sf), fresh_path(spark, "runs")
    for part in range(3):
        writers.append_runs(log.where(F.crc32(F.col("run_id").cast("binary")) % 3 == part), path)
    writers.compact_runs(spark, path)
    return readers.run_files(spark, path).withColumn("day", F.col("day").cast("string"))


@query
def report_psi_file(spark, sf):
    """The PSI matrix of the same report, its file read back."""
    best = registry.best_per_snapshot(run_rows(spark, sf)).select("run_id")
    metrics, out = registry.metrics_long(V.run_log(spark, sf)).join(best, "run_id", "left_semi"), fresh_path(spark, "report")
    parquet, _ = writers.export_metrics(metrics, f"{out}/metrics")
    monitoring.build_report(spark, parquet, out)
    cells = report.pivot_cells(readers.read_csv(spark, f"{out}/psi"))
    return cells.select("metric_name", "snapshot_date", F.round("value", 9).alias("value"))


@query
def csv_reordered(spark, sf):
    """A folder of CSV files whose columns stand in different orders, one of them without a column."""
    clk, out = V.clickstream(spark, sf), fresh_path(spark, "csv")
    even = F.col("Customer_ID").cast("bigint") % 3
    writers.write_csv(clk.where(even == 0), f"{out}/a")
    writers.write_csv(clk.where(even == 1).select(*reversed(clk.columns)), f"{out}/b")
    writers.write_csv(clk.where(even == 2).drop("fe_7"), f"{out}/c")
    return readers.read_csv(spark, f"{out}/*", K.CLICKSTREAM_SCHEMA)


@query
def random_search(spark, sf):
    return M.search_results(M.random_search(M.assemble(V.ml(spark, sf), FES)))


# --- round trips ------------------------------------------------------------------


@query
def roundtrip_parquet(spark, sf):
    root = fresh_path(spark, "lake")
    writers.write_table(V.clickstream(spark, sf), root, "bronze", "clickstream")
    return readers.read_table(spark, root, "bronze", "clickstream")


@query
def roundtrip_partitioned(spark, sf):
    path = fresh_path(spark, "by-month")
    writers.write_parquet(V.clickstream(spark, sf), path, "snapshot_date")
    return spark.read.parquet(path)


@query
def roundtrip_csv(spark, sf):
    path = writers.write_csv(V.clickstream(spark, sf), fresh_path(spark, "csv"))
    return readers.read_csv(spark, path, K.CLICKSTREAM_SCHEMA)


@query
def csv_inferred(spark, sf):
    path = writers.write_csv(V.clickstream(spark, sf), fresh_path(spark, "csv"))
    df = readers.read_csv(spark, path)
    return df.withColumn("Customer_ID", F.col("Customer_ID").cast("bigint"))


@query
def multi_file_scan(spark, sf):
    path = writers.write_parquet(V.clickstream(spark, sf), fresh_path(spark, "files"))
    return readers.read_files(spark, [f"{path}/part-*.parquet"])


@query
def baseline_files(spark, sf):
    rows = drift.baseline(V.clickstream(spark, sf))
    csv = writers.write_csv(rows, fresh_path(spark, "baseline") + ".csv")
    parquet = writers.write_parquet(rows, fresh_path(spark, "baseline") + ".parquet")
    return readers.read_baseline(spark, csv, FES).union(readers.read_baseline(spark, parquet, FES))


@query
def runs_scan(spark, sf):
    path = fresh_path(spark, "runs")
    runs = V.run_log(spark, sf).withColumn("start_time", F.col("start_time").cast("timestamp"))
    writers.write_parquet(runs, path)
    return registry.run_table(readers.read_runs(spark, path)).drop("start_time")


@query
def metrics_scan(spark, sf):
    metrics = registry.metrics_long(V.run_log(spark, sf))
    _, csv = writers.export_metrics(metrics, fresh_path(spark, "export"))
    return rounded(readers.read_metrics(spark, csv), 9, "value")


@query
def optional_scan(spark, sf):
    profile = report.null_profile(silver_financials(spark, sf), K.FINANCIAL_DOUBLES)
    path = writers.write_csv(rounded(profile, 9, "null_pct"), fresh_path(spark, "quality"))
    present = readers.read_optional(spark, path, K.DATA_QUALITY_SCHEMA)
    absent = readers.read_optional(spark, f"{path}-absent", K.DATA_QUALITY_SCHEMA)
    return present.unionByName(absent)


@query
def predictions_sink(spark, sf):
    df = rounded(M.linear_score(V.clickstream(spark, sf), WEIGHTS, INTERCEPT), 10, "prediction")
    df = clean.with_constants(df.select(*PANEL, "prediction"), model_name="fixed_weights")
    return spark.read.parquet(writers.write_predictions(df, fresh_path(spark, "lake")))


def lake(spark, sf) -> str:
    """CSV sources written from the views, then bronze and silver built from them."""
    data, root = fresh_path(spark, "data"), fresh_path(spark, "lake")
    months = stage(V.customer_months(spark, sf), "months")
    sources = {
        "financials": V.financials(spark, sf, months),
        "attributes": V.attributes(spark, sf, months),
        "clickstream": V.clickstream(spark, sf, months),
        "loans": V.loans(spark, sf),
    }
    for name, df in sources.items():
        writers.write_csv(df, f"{data}/{etl.SOURCE_FILES[name]}", "gzip")
    etl.build_bronze(spark, data, root)
    etl.build_silver(spark, root)
    return root


@query
def etl_label_store(spark, sf):
    return etl.build_label_store(spark, lake(spark, sf))


@query
def etl_feature_store(spark, sf):
    store = etl.build_feature_store(spark, lake(spark, sf), encode=False)
    return rounded(store, 9, "log_Annual_Income")
