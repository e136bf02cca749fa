"""Train one model per snapshot, then choose what to promote."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditloom.operators import modeling as M, registry
from creditloom.operators.clean import feature_columns
from creditloom.operators.snapshots import as_of, attach_features, attach_label_counts, split_windows
from creditloom.sources import readers, writers
from creditloom.sources.staging import stage, temporary_tables


def training_rows(
    feat: DataFrame, labels: DataFrame, snapshot: dt.date | str, on: list[str] | None = None
) -> DataFrame:
    """Features, label and weight of everything known at the snapshot, split train / test.

    Labels are counted per customer before the join (see ``attach_label_counts``), and only the
    keys and features of known rows go into it. The split hashes customer, month and label.
    """
    known = as_of(feat, snapshot).select("Customer_ID", "snapshot_date", *feature_columns(feat))
    rows = attach_label_counts(known, as_of(labels, snapshot), on)
    key = F.concat_ws("|", "Customer_ID", "snapshot_date", "label")
    return M.stratified_split(rows.withColumn("__key", key), "__key").drop("__key")


def training_history(
    feat: DataFrame, labels: DataFrame, snapshots: list[dt.date | str], on: list[str] | None = None
) -> DataFrame:
    """What ``training_rows`` of several snapshots are made of, joined and written once for all of them.

    Every feature month known at the last snapshot, with the number of the customer's labels known at each snapshot
    (two columns a snapshot, so a fit reads its own), and the split of the row by either label.
    """
    on, last = on or ["Customer_ID"], max(str(s) for s in snapshots)
    counts = as_of(labels, last).groupBy(*on).agg(
        *[
            F.count_if((F.col("label") == v) & (F.col("snapshot_date") <= readers.as_date(s))).alias(_count(v, s))
            for s in snapshots
            for v in (1, 0)
        ]
    )
    known = as_of(feat, last).select("Customer_ID", "snapshot_date", *feature_columns(feat))
    # written first: the join then shuffles both sides itself, which lets AQE split a hot customer
    rows = known.join(stage(counts, "label-counts"), on)
    for v in (1, 0):
        key = F.concat_ws("|", "Customer_ID", "snapshot_date", F.lit(v))
        rows = M.stratified_split(rows.withColumn("__key", key), "__key").withColumnRenamed("split", f"__split_{v}").drop("__key")
    return stage(rows, "history")


def _count(label: int, snapshot: dt.date | str) -> str:
    return f"__n{label}_{snapshot}"


def history_rows(history: DataFrame, snapshot: dt.date | str) -> DataFrame:
    """The ``training_rows`` of one of the snapshots of ``training_history``."""
    both = F.array(
        *[
            F.struct(F.lit(v).alias("label"), F.col(f"`{_count(v, snapshot)}`").alias("weight"), F.col(f"__split_{v}").alias("split"))
            for v in (1, 0)
        ]
    )
    kept = [c for c in history.columns if not c.startswith("__")]
    return as_of(history, snapshot).select(*kept, F.inline(both)).where(F.col("weight") > 0)


def train_snapshot(
    spark: SparkSession,
    feat: DataFrame,
    labels: DataFrame,
    model_type: str,
    snapshot: dt.date | str,
    model_dir: str,
    runs_path: str | None = None,
    on: list[str] | None = None,
    history: DataFrame | None = None,
    **options,
) -> M.RunRecord | None:
    """Train on the snapshot's history, save the pipeline and log the run; None without data.

    ``history`` is the ``training_history`` of the same tables, for callers that train several snapshots.
    """
    cols = feature_columns(feat)
    with temporary_tables(spark):
        rows = stage(training_rows(feat, labels, snapshot, on), "training") if history is None else history_rows(history, snapshot)
        train = rows.where(F.col("split") == "train").select(*cols, "label", "weight")
        if train.isEmpty():
            return None
        model = M.TRAINERS[model_type](train, cols, weight="weight", **options)
        M.save_model(model, f"{model_dir.rstrip('/')}/{model_type}_{snapshot}")

        test = rows.where(F.col("split") == "test")
        scores = M.score(test, model, model_type, ("label", "weight"))
        test_auc = M.auc(scores, weight="weight").first()["auc"]
    record = M.RunRecord(
        run_id=uuid.uuid4().hex,
        start_time=dt.datetime.now(),
        tags={"snapshot_date": str(snapshot), "model_type": model_type},
        metrics={"auc": test_auc},
        params={},
    )
    if runs_path:
        M.log_run(spark, runs_path, record)
    return record


def train_windowed(
    feat: DataFrame,
    labels: DataFrame,
    train_date: dt.date | str,
    version: str,
    train_test_months: int = 12,
    oot_months: int = 2,
    frac: float = 0.2,
    **search,
) -> tuple[DataFrame, DataFrame]:
    """Train on the months before a date and describe the model: (scores, card).

    Labels are given the features of their customer month, missing ones 0; the windows before ``train_date``
    are train/test and out of time; the hash of customer, month and label splits train from test. The best
    point of a cross-validated random search over the train rows (options: ``search``) scores all rows, and
    AUC and Gini are taken per split.
    """
    windows = split_windows(readers.as_date(train_date), train_test_months, oot_months)
    cols = feature_columns(feat)
    rows = attach_features(labels.select("Customer_ID", "snapshot_date", "label"), feat)
    rows = M.time_split(rows, windows).where(F.col("period").isNotNull()).fillna(0, cols)
    key = F.concat_ws("|", "Customer_ID", "snapshot_date", "label")
    rows = M.stratified_split(rows.withColumn("__key", key), "__key", frac)
    split = F.when(F.col("period") == "oot", "oot").otherwise(F.col("split"))
    rows = stage(M.assemble(rows.withColumn("split", split), cols).select(M.FEATURES, "label", "split"), "windowed")
    found = M.random_search(rows.where(F.col("split") == "train").select(M.FEATURES, "label"), **search)
    scores = M.score(rows, found.best_model, version, ("label", "split"))
    params = {name: str(v) for name, v in found.best.items()}
    return scores, M.model_card(version, windows, M.split_stats(rows), M.evaluate(scores), params)


def list_artifacts(spark: SparkSession, model_dir: str) -> DataFrame:
    """Model folders below ``model_dir`` as an artefact table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(model_dir)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [(status.getPath().getName(),) for status in found]
    return registry.parse_artifacts(spark.createDataFrame(names, "name string"))


def select_models(
    spark: SparkSession, runs_path: str, model_dir: str, out: str, start: str, end: str, years: int | None = 3
) -> DataFrame:
    """Promotion table: for each snapshot in the range, the artefact to serve."""
    runs = registry.run_table(readers.read_runs(spark, runs_path))
    chosen = registry.promotions(runs, list_artifacts(spark, model_dir), start, end, years)
    writers.write_parquet(chosen, out)
    return spark.read.parquet(out)
