"""Score snapshots, measure drift against the baseline, decide on retraining, export metrics."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditloom import constants as K
from creditloom.operators import drift, modeling as M, registry, report
from creditloom.operators.clean import feature_columns
from creditloom.operators.snapshots import backfill
from creditloom.sources import readers, writers
from creditloom.sources.staging import fresh_path, stage


def monitor(
    base: DataFrame,
    feat: DataFrame,
    months: DataFrame,
    threshold: float = K.PSI_THRESHOLD,
    **quantile_options,
) -> tuple[DataFrame, DataFrame]:
    """PSI per (snapshot, feature), and per snapshot its mean, maximum and decision.

    Baseline edges are fitted once and every month is measured in the same job.
    """
    cols = feature_columns(feat)
    edges = drift.edge_values(drift.baseline_edges(base, cols, **quantile_options))
    psi = stage(drift.psi_by_snapshot(base, backfill(feat, months), cols, edges=edges), "psi")
    summary = drift.drift_decision(drift.psi_summary(psi, ["snapshot_date"]), threshold)
    return psi, summary


def score_snapshots(
    feat: DataFrame, served: dict[str, str], model_dir: str, keys=("Customer_ID", "snapshot_date")
) -> DataFrame:
    """Predictions of each snapshot by its own model: {snapshot: artefact name}.

    One scan per model, pruned to its snapshots; the parts are a plain union.
    """
    months: dict[str, list] = {}
    for snapshot, name in sorted(served.items()):
        months.setdefault(name, []).append(readers.as_date(snapshot))
    parts = [
        M.score(feat.where(F.col("snapshot_date").isin(days)), M.load_model(f"{model_dir.rstrip('/')}/{name}"), name, keys)
        for name, days in months.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def infer(
    spark: SparkSession,
    feat: DataFrame,
    base: DataFrame,
    artifacts: DataFrame,
    model_dir: str,
    months: DataFrame,
    root: str,
    runs_path: str | None = None,
    threshold: float = K.PSI_THRESHOLD,
) -> DataFrame:
    """Score and monitor all months that have features and an artefact; returns the summary.

    The features of these months are written by snapshot once, so a source that cannot be pruned (CSV) is read
    twice at most: for its months, and for their rows. Scoring goes on whatever the drift; the decision column
    says what should happen next, ``overall`` gives the one for all months. The columns are the same when no
    month is served.
    """
    served = registry.model_for_snapshot(artifacts).join(
        backfill(feat, months).select("snapshot_date").distinct(), "snapshot_date", "left_semi"
    )
    served = stage(served, "served")
    by_month = writers.write_parquet(backfill(feat, served), fresh_path(spark, "months"), "snapshot_date", whole=True)
    feat = spark.read.schema(feat.schema).parquet(by_month)
    psi, summary = monitor(base, feat, served.select("snapshot_date"), threshold)
    # one row per month served
    chosen = {str(r["snapshot_date"]): r["name"] for r in served.toLocalIterator()}
    if chosen:
        predictions = stage(score_snapshots(feat, chosen, model_dir), "predictions")
        writers.write_predictions(predictions, root)
        stats = M.prediction_stats(predictions, ["snapshot_date", "model_name"])
    else:
        none = {"model_name": "string", "pred_mean": "double", "pred_std": "double"}
        stats = summary.select("snapshot_date", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    summary = stage(stats.join(summary, "snapshot_date", "left"), "summary")
    if runs_path:
        log_inference(spark, runs_path, summary, psi)
    return summary


def overall(summary: DataFrame, threshold: float = K.PSI_THRESHOLD) -> DataFrame:
    """One decision from the largest PSI of all months and features."""
    return drift.drift_decision(drift.psi_global(summary.select(F.col("psi_max").alias("psi"))), threshold)


def log_inference(spark: SparkSession, runs_path: str, summary: DataFrame, psi: DataFrame) -> None:
    """Append one run per monitored snapshot, its metrics taken from the result tables."""
    per_feature = psi.groupBy("snapshot_date").agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.concat(F.lit("psi_"), "feature"), F.col("psi")))
        ).alias("features")
    )
    measured = ["psi_mean", "psi_max", "pred_mean", "pred_std"]
    totals = F.map_from_arrays(F.array(*[F.lit(c) for c in measured]), F.array(*[F.col(c) for c in measured]))
    now = dt.datetime.now()
    runs = summary.join(per_feature, "snapshot_date", "left").select(
        F.concat_ws("-", F.lit(uuid.uuid4().hex), F.col("snapshot_date").cast("string")).alias("run_id"),
        F.lit(now).alias("start_time"),
        F.create_map(
            F.lit("snapshot_date"), F.col("snapshot_date").cast("string"), F.lit("model_name"), F.col("model_name")
        ).alias("tags"),
        F.create_map().cast("map<string,string>").alias("params"),
        F.map_filter(
            F.map_concat(F.coalesce("features", F.create_map().cast("map<string,double>")), totals),
            lambda _, v: v.isNotNull(),
        ).alias("metrics"),
    )
    writers.append_runs(runs, runs_path)


def export_run_metrics(spark: SparkSession, runs_path: str, outdir: str) -> tuple[str, str]:
    return writers.export_metrics(registry.metrics_long(readers.read_runs(spark, runs_path)), outdir)


def build_report(
    spark: SparkSession, metrics_path: str, outdir: str, quality_path: str | None = None
) -> dict[str, DataFrame]:
    """Write the report tables as CSV; the null table comes from a quality file when there is one."""
    tables = report.report_tables(readers.read_metrics(spark, metrics_path))
    if quality_path:
        nulls = readers.read_optional(spark, quality_path, K.DATA_QUALITY_SCHEMA)
        tables["nulls"] = nulls.orderBy("snapshot_date")
    for name, table in tables.items():
        writers.write_csv(table, f"{outdir.rstrip('/')}/{name}")
    return tables


def alert(runs: DataFrame, threshold: float = K.PSI_THRESHOLD, missing: float = 0.0) -> DataFrame:
    """Decision for the latest run alone; a run without PSI does not trigger."""
    latest = registry.latest_run(runs).select(
        "run_id", F.try_element_at("metrics", F.lit("psi_max")).alias("psi_max")
    )
    return drift.drift_decision(latest, threshold, missing)
