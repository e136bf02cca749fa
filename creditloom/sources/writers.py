"""Sinks: Parquet layers (whole or by snapshot), CSV, metric export, predictions, ingest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditloom import constants as K
from creditloom.sources import readers
from creditloom.sources.staging import stage


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: str | list[str] | None = None,
    whole: bool = False,
    clustered: bool = False,
) -> str:
    """Overwrite a Parquet dataset.

    With ``partition_by`` rows are first clustered on the partition columns by a rebalance
    hint: each folder gets few large files, and a month holding a large share of the rows is
    split over several tasks by AQE. Only the partitions present in ``df`` are replaced, so a
    re-run of one month leaves the others alone; with ``whole`` the dataset is replaced, so a full build
    leaves no month that its source no longer has. Rows that are ``clustered`` on the partition columns already, as
    those read from a dataset with the same folders, are not shuffled again.
    """
    if not partition_by:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return path
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    (
        (df if clustered else df.hint("rebalance", *columns))
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )
    return path


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    partition_by: str | list[str] | None = None,
    whole: bool = False,
    clustered: bool = False,
) -> str:
    return write_parquet(df, readers.table_path(root, layer, name), partition_by, whole, clustered)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> str:
    """Folder of CSV part files with headers."""
    df.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
    return path


def export_metrics(metrics: DataFrame, outdir: str) -> tuple[str, str]:
    """Metric table as Parquet and CSV. The CSV is written from the Parquet copy, so the runs
    are scanned once and both files hold the same rows."""
    parquet, csv = f"{outdir.rstrip('/')}/metrics.parquet", f"{outdir.rstrip('/')}/metrics.csv"
    write_parquet(metrics, parquet)
    write_csv(metrics.sparkSession.read.parquet(parquet), csv)
    return parquet, csv


def write_predictions(df: DataFrame, root: str) -> str:
    return write_table(df, root, "gold", "model_predictions", ["model_name", "snapshot_date"])


def ingest_sources(
    spark: SparkSession, sources: dict[str, str], root: str, infer: bool = False
) -> dict[str, DataFrame]:
    """Copy each named CSV source into the bronze layer; time series are stored by snapshot."""
    tables = {}
    for name, path in sources.items():
        df = readers.read_csv(spark, path, None if infer else K.SOURCE_SCHEMAS.get(name))
        by = "snapshot_date" if name in K.PARTITIONED["bronze"] and "snapshot_date" in df.columns else None
        write_table(df, root, "bronze", name, by, whole=True)
        tables[name] = readers.read_table(spark, root, "bronze", name)
    return tables


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run records to the log, which is kept by the day of their start."""
    runs.withColumn("day", F.to_date("start_time")).write.mode("append").partitionBy("day").parquet(path)


def compact_runs(spark: SparkSession, path: str, before: dt.date | str | None = None) -> int:
    """Rewrite the days of a run log that have more than one file, and give their number.

    Every run logged adds a file, so a scan of many runs opens as many; after this a day is as few files as its size
    needs. ``before`` leaves later days alone, to which runs may still be added: a run logged while
    its day is rewritten would be lost. The rows are staged first, then replace their days only.
    """
    days = readers.run_files(spark, path).where("n_files > 1")
    if before is not None:
        days = days.where(F.col("day") < readers.as_date(before))
    days = stage(days.select("day"), "days")
    n_days = days.count()
    if n_days:
        runs = spark.read.schema(K.RUNS_SCHEMA).parquet(path)
        # as many rows as days
        rows = stage(runs.join(F.broadcast(days), "day", "left_semi"), "runs")
        write_parquet(rows, path, "day")
    return n_days

