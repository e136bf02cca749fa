"""Exact ordered totals that no single group can overload.

A window partitioned by a group sorts the whole group in one task. Here rows are first cut
into ordered slices of even size (range partitioning by group and order columns), totals are
taken per slice, and only the small per-slice totals are accumulated group by group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from creditloom.sources.staging import stage

SLICE = "__slice"


def slice_by_range(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Tag each row with the number of its range slice; slices ascend in (keys, order)."""
    return df.repartitionByRange(*keys, *order).withColumn(SLICE, F.spark_partition_id())


def total_before(measure, *partition_by: str, order: list):
    """Sum of ``measure`` over the rows strictly before this one."""
    window = W.partitionBy(*partition_by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(measure).over(window), F.lit(0))


def with_total_before(
    df: DataFrame, keys: list[str], order: list, measure, name: str, group_total: str | None = None
) -> DataFrame:
    """Add the sum of ``measure`` over all rows of the group that sort before the row, and on
    request the sum over the whole group.

    ``order`` must be a total order within a group. There is one path for every size: range slices,
    written once, as the slice totals and the rows must be taken from the same slices.
    """
    out = [*df.columns, name] + ([group_total] if group_total else [])
    group = group_total or "__group"
    rows = stage(slice_by_range(df.withColumn("__measure", measure), keys, order), "slices")
    totals = rows.groupBy(*keys, SLICE).agg(F.sum("__measure").alias("__total"))
    offsets = totals.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        F.col(SLICE).alias("__slice_no"),
        total_before(F.col("__total"), *keys, order=[SLICE]).alias("__offset"),
        F.sum("__total").over(W.partitionBy(*keys)).alias(group),
    )
    same = F.col(SLICE) == F.col("__slice_no")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    local = total_before(F.col("__measure"), *keys, SLICE, order=order)
    return rows.join(offsets, same).withColumn(name, F.col("__offset") + local).select(*out)
