"""Report tables: AUC over time, PSI by feature and snapshot, null shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from creditloom.functions.records import strip_prefix


def metric_filter(metrics: DataFrame, name: str | None = None, prefix: str | None = None) -> DataFrame:
    if name is not None:
        metrics = metrics.where(F.col("metric_name") == name)
    if prefix is not None:
        metrics = metrics.where(F.col("metric_name").startswith(prefix))
    return metrics


def auc_series(metrics: DataFrame) -> DataFrame:
    return metric_filter(metrics, name="auc").select("snapshot_date", "run_id", "value").orderBy(
        "snapshot_date", "run_id"
    )


def metric_pivot(
    metrics: DataFrame,
    prefix: str = "psi_",
    snapshots: list[str] | None = None,
    exclude: list[str] | None = None,
    short_names: bool = False,
) -> DataFrame:
    """Metrics as rows, snapshots as columns, both sorted.

    Two values for one (metric, snapshot) are an error, as a cell can only hold one. The columns are
    the snapshots found; passing ``snapshots`` spares the job that looks them up, and any other
    snapshot in the data is then an error.
    """
    rows = metric_filter(metrics, prefix=prefix)
    if exclude:
        rows = rows.where(~F.col("metric_name").isin(exclude))
    clash = F.concat(F.lit("more than one value for "), F.first("metric_name"))
    cell = F.when(F.count(F.lit(1)) > 1, F.raise_error(clash)).otherwise(F.max("value"))
    cells = rows.groupBy("metric_name", "snapshot_date").agg(cell.alias("value"))
    if snapshots is not None:
        unlisted = F.raise_error(F.concat(F.lit("unlisted snapshot "), F.col("snapshot_date"))).cast("string")
        listed = F.when(F.col("snapshot_date").isin(snapshots), F.col("snapshot_date")).otherwise(unlisted)
        cells = cells.withColumn("snapshot_date", listed)
    table = cells.groupBy("metric_name").pivot("snapshot_date", snapshots).agg(F.max("value"))
    table = table.select("metric_name", *sorted(c for c in table.columns if c != "metric_name"))
    if short_names:
        table = table.withColumn("metric_name", strip_prefix(F.col("metric_name"), prefix))
    return table.orderBy("metric_name")


def pivot_cells(table: DataFrame, snapshot_col: str = "snapshot_date") -> DataFrame:
    """The filled cells of a metric matrix as (metric_name, snapshot, value) rows."""
    months = [c for c in table.columns if c != "metric_name"]
    if not months:
        return table.select("metric_name", F.lit("").alias(snapshot_col), F.lit(0.0).alias("value")).limit(0)
    return table.unpivot(["metric_name"], months, snapshot_col, "value").where(F.col("value").isNotNull())


def null_profile(df: DataFrame, cols: list[str] | None = None, by: str = "snapshot_date") -> DataFrame:
    """(by, null_pct): share of missing cells over ``cols`` per snapshot, in percent."""
    cols = cols or [c for c in df.columns if c != by]
    missing = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    share = F.sum(missing) * F.lit(100.0) / (F.count(F.lit(1)) * len(cols))
    return df.groupBy(by).agg(share.alias("null_pct")).orderBy(by)


def report_tables(metrics: DataFrame, data: DataFrame | None = None, **pivot_options) -> dict[str, DataFrame]:
    """The three tables of the performance report; ``data`` is profiled for missing values."""
    tables = {"auc": auc_series(metrics), "psi": metric_pivot(metrics, **pivot_options)}
    if data is not None:
        tables["nulls"] = null_profile(data)
    return tables
