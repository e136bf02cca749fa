"""Model runs and artefacts: ranking, best run per snapshot, fallback, promotion, metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from creditloom.functions import records as R
from creditloom.operators.ordering import with_total_before

ARTIFACT_KEYS = ["model_type", "snapshot_date"]


def run_table(runs: DataFrame) -> DataFrame:
    """Run records as (run_id, start_time, snapshot_date, model_type, auc)."""
    return runs.select(
        "run_id",
        "start_time",
        R.map_value(F.col("tags"), "snapshot_date").alias("snapshot_date"),
        R.first_of("model_type", F.col("tags"), F.col("params")).alias("model_type"),
        F.try_element_at("metrics", F.lit("auc")).alias("auc"),
    )


def tag(runs: DataFrame, key: str, default: str | None = None) -> DataFrame:
    """Runs with the tag ``key`` (or the parameter of that name) as a column."""
    value = R.first_of(key, F.col("tags"), F.col("params"))
    return runs.withColumn(key, value if default is None else F.coalesce(value, F.lit(default)))


def eligible(runs: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Runs with a snapshot and a real AUC, within the (inclusive) snapshot range."""
    snapshot = F.col("snapshot_date")
    keep = snapshot.isNotNull() & F.col("auc").isNotNull() & ~F.isnan("auc")
    if start is not None:
        keep = keep & (snapshot >= start)
    if end is not None:
        keep = keep & (snapshot <= end)
    return runs.where(keep)


def _micros(t: Column) -> Column:
    return F.unix_micros(t.cast("timestamp"))


def best_per_snapshot(runs: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Run with the highest AUC per snapshot; ties go to the newest run, then the lowest id.

    An aggregate rather than a window: each task sends one candidate per snapshot.
    """
    kept = [c for c in runs.columns if c != "snapshot_date"]
    place = F.struct(
        (-F.col("auc")).alias("worst_auc"), (-_micros(F.col("start_time"))).alias("age"), F.col("run_id")
    )
    best = (
        eligible(runs, start, end)
        .groupBy("snapshot_date")
        .agg(F.min_by(F.struct(*kept), place).alias("best"))
    )
    return best.select("snapshot_date", *[F.col(f"best.{c}").alias(c) for c in kept])


def rank_runs(runs: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """All eligible runs with their rank inside the snapshot (1 is the best run).

    A large table is ranked in range slices, so that a snapshot holding most runs is sorted by
    many tasks.
    """
    order = [F.desc("auc"), F.desc("start_time"), F.col("run_id")]
    counted = with_total_before(eligible(runs, start, end), ["snapshot_date"], order, F.lit(1), "__better")
    return counted.select(*runs.columns, (F.col("__better") + 1).cast("bigint").alias("rank"))


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("start_time"), "run_id").limit(1)


def with_artifact(df: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Rows whose (model type, snapshot) has a stored artefact."""
    return df.join(artifacts.select(*ARTIFACT_KEYS), ARTIFACT_KEYS, "left_semi")


def without_artifact(df: DataFrame, artifacts: DataFrame) -> DataFrame:
    return df.join(artifacts.select(*ARTIFACT_KEYS), ARTIFACT_KEYS, "left_anti")


def parse_artifacts(names: DataFrame, column: str = "name") -> DataFrame:
    """(name, model_type, snapshot_date) of artefact names like ``<type>_<date>.pkl``."""
    return names.select(
        F.col(column).alias("name"),
        R.model_type_of(F.col(column)).alias("model_type"),
        R.snapshot_of(F.col(column)).alias("snapshot_date"),
    ).where(F.col("snapshot_date").isNotNull())


def model_for_snapshot(artifacts: DataFrame, snapshot: dt.date | str | None = None) -> DataFrame:
    """(snapshot_date, name) with the alphabetically first artefact of each snapshot."""
    if snapshot is not None:
        artifacts = artifacts.where(F.col("snapshot_date") == str(snapshot))
    return artifacts.groupBy("snapshot_date").agg(F.min("name").alias("name"))


def previous_snapshot(best: DataFrame, years: int | None = 3) -> DataFrame:
    """Best runs with the latest earlier best snapshot, at most ``years`` back (inclusive).

    An equi-join on the calendar year: within a year the one before is a window over its dates, and each
    year also offers its last date to the years after it, up to ``years`` of them (all, when None: then every
    year's last date is carried on through the few rows of a table of years). A tag that is not a date has no
    fallback and is none.
    """
    day = F.col("snapshot_date").try_cast("date")
    rows = best.withColumn("__year", F.year(day))
    dated = rows.where(F.col("__year").isNotNull())
    in_year = W.partitionBy("__year").orderBy("snapshot_date")
    near = dated.withColumn("__near", F.lag("snapshot_date").over(in_year))
    last = dated.groupBy("__year").agg(F.max("snapshot_date").alias("__last"))
    if years is None:
        spans = dated.select(F.col("__year").alias("to")).distinct().agg(F.min("to").alias("low"), F.max("to").alias("high"))
        reach = F.sequence(F.col("__year") + 1, F.greatest(F.col("__year") + 1, spans.select("high").scalar()))
    else:
        reach = F.sequence(F.col("__year") + 1, F.col("__year") + years)
    offered = last.select(F.explode(reach).alias("__year"), "__last").groupBy("__year").agg(F.max("__last").alias("__last"))
    found = near.join(offered, "__year", "left").withColumn("fallback_snapshot", F.coalesce("__near", "__last"))
    if years is not None:
        recent = F.col("fallback_snapshot").cast("date") >= F.add_months(F.col("snapshot_date").cast("date"), -12 * years)
        found = found.withColumn("fallback_snapshot", F.when(recent, F.col("fallback_snapshot")))
    undated = rows.where(F.col("__year").isNull()).withColumn("fallback_snapshot", F.lit(None).cast("string"))
    out = [*best.columns, "fallback_snapshot"]
    return found.select(*out).unionByName(undated.select(*out))


def promotions(
    runs: DataFrame,
    artifacts: DataFrame,
    start: str | None = None,
    end: str | None = None,
    years: int | None = 3,
) -> DataFrame:
    """What to promote for each snapshot's best run.

    ``status`` is ``promoted`` when the run's own artefact exists, ``fallback`` when the artefact
    of the same model type for the latest earlier best snapshot stands in, otherwise
    ``fallback_missing`` or ``no_fallback``; ``bad_snapshot`` when the run's tag is no date.
    ``source_snapshot`` is the artefact to use.
    """
    best = previous_snapshot(best_per_snapshot(runs, start, end), years)
    stored = artifacts.select(*ARTIFACT_KEYS).distinct()
    own = stored.withColumn("own", F.lit(True))
    other = stored.select(
        "model_type", F.col("snapshot_date").alias("fallback_snapshot"), F.lit(True).alias("other")
    )
    found = best.join(own, ARTIFACT_KEYS, "left").join(other, ["model_type", "fallback_snapshot"], "left")
    status = (
        F.when(F.col("own"), "promoted")
        .when(F.col("snapshot_date").try_cast("date").isNull(), "bad_snapshot")
        .when(F.col("fallback_snapshot").isNull(), "no_fallback")
        .when(F.col("other"), "fallback")
        .otherwise("fallback_missing")
    )
    source = F.when(F.col("own"), F.col("snapshot_date")).when(F.col("other"), F.col("fallback_snapshot"))
    return found.select(
        "snapshot_date",
        "run_id",
        "model_type",
        "auc",
        "fallback_snapshot",
        status.alias("status"),
        source.alias("source_snapshot"),
    )


def asof_fallback(
    best: DataFrame, artifacts: DataFrame, years: int | None = 3
) -> DataFrame:
    """Snapshots without their own artefact and the earlier snapshot that replaces it."""
    candidates = previous_snapshot(best, years)
    return without_artifact(candidates, artifacts)


def metrics_long(runs: DataFrame) -> DataFrame:
    """Metric maps as (run_id, snapshot_date, metric_name, value); no snapshot tag gives ''."""
    snapshot = R.map_value(F.col("tags"), "snapshot_date", "")
    return runs.select(
        "run_id", snapshot.alias("snapshot_date"), F.explode("metrics").alias("metric_name", "value")
    )
