"""Monthly snapshot panel: date filters, spines, and the joins of features to outcomes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from creditloom import constants as K
from creditloom.functions import delinquency as D
from creditloom.operators.labels import at_mob
from creditloom.sources.readers import as_date
from creditloom.operators.skew import salted_join
from creditloom.sources.staging import stage

SNAPSHOT = "snapshot_date"
LABELLED_KEYS = ["Customer_ID", "feature_snapshot_date", "label_snapshot_date", "label"]


# --- date filters and summaries ---------------------------------------------------


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def snapshots(df: DataFrame, date_col: str = SNAPSHOT) -> DataFrame:
    """Distinct snapshot dates (map-side distinct: one row per date and task is shuffled)."""
    return df.select(date_col).distinct()


def latest_snapshot(df: DataFrame, date_col: str = SNAPSHOT) -> DataFrame:
    return df.agg(F.max(date_col).alias(date_col))


def at_latest(df: DataFrame, date_col: str = SNAPSHOT) -> DataFrame:
    """Rows of the newest snapshot; the date is a scalar subquery, not a driver value."""
    return df.where(F.col(date_col) == latest_snapshot(df, date_col).scalar())


def as_of(df: DataFrame, day: dt.date | str, date_col: str = SNAPSHOT) -> DataFrame:
    return df.where(F.col(date_col) <= as_date(day))


def between_dates(df: DataFrame, start, end, date_col: str = SNAPSHOT) -> DataFrame:
    return df.where(F.col(date_col).between(as_date(start), as_date(end)))


def month_starts(start: Column, end: Column) -> Column:
    """First-of-month dates from the month of ``start`` to the month of ``end``, as an array."""
    return F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))


def month_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    return spark.range(1).select(F.explode(month_starts(as_date(start), as_date(end))).alias(SNAPSHOT))


def month_spine_of(df: DataFrame, date_col: str = SNAPSHOT) -> DataFrame:
    """Month spine spanning the dates of a table."""
    span = df.agg(F.min(date_col).alias("start"), F.max(date_col).alias("end"))
    return span.select(F.explode(month_starts(F.col("start"), F.col("end"))).alias(SNAPSHOT))


def trailing_year(day: Column) -> tuple[Column, Column]:
    """Default scoring range: from one year before ``day`` to ``day``."""
    return F.add_months(day, -12), day


def backfill_range(spark: SparkSession, today: dt.date | str | None = None) -> DataFrame:
    """Month starts of the trailing year (13 months)."""
    start, end = trailing_year(F.current_date() if today is None else as_date(today))
    return spark.range(1).select(F.explode(month_starts(start, end)).alias(SNAPSHOT))


def split_windows(train_date: Column, train_test_months: int = 12, oot_months: int = 2) -> dict[str, Column]:
    """Train/test and out-of-time windows that end the day before the training date."""
    oot_start = F.add_months(train_date, -oot_months)
    return {
        "train_test_start_date": F.add_months(oot_start, -train_test_months),
        "train_test_end_date": F.date_sub(oot_start, 1),
        "oot_start_date": oot_start,
        "oot_end_date": F.date_sub(train_date, 1),
    }


# --- slices -----------------------------------------------------------------------


def valid_slices(feat: DataFrame, loans: DataFrame, mob: int = K.MOB_CUTOFF) -> DataFrame:
    """Feature dates whose outcome month exists in the loan table."""
    wanted = snapshots(feat).select(F.add_months(SNAPSHOT, mob).alias("label_snapshot_date"), SNAPSHOT)
    present = snapshots(loans).withColumnRenamed(SNAPSHOT, "label_snapshot_date")
    return wanted.join(present, "label_snapshot_date", "left_semi").select(
        F.col(SNAPSHOT).alias("feature_snapshot_date"), "label_snapshot_date"
    )


def union_slices(slices: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, slices)


def backfill(
    df: DataFrame, months: DataFrame, build: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Run ``build`` for a list of snapshot months at once.

    The months become a semi-join (dynamic partition pruning on partitioned input), and the
    result stays keyed by snapshot date: one job instead of one per month.
    """
    wanted = df.join(months.select(SNAPSHOT).distinct(), SNAPSHOT, "left_semi")
    return build(wanted) if build else wanted


# --- joins ------------------------------------------------------------------------


def outcomes(loans: DataFrame, dpd: int = K.DPD_CUTOFF, mob: int = K.MOB_CUTOFF) -> DataFrame:
    """(Customer_ID, label_snapshot_date, label) of the loans at ``mob`` months on book."""
    return at_mob(loans, mob).select(
        "Customer_ID",
        F.col(SNAPSHOT).alias("label_snapshot_date"),
        D.delinquency_label(F.col("dpd"), dpd).alias("label"),
    )


def outcome_counts(loans: DataFrame, dpd: int = K.DPD_CUTOFF, mob: int = K.MOB_CUTOFF) -> DataFrame:
    """Outcomes with equal ones once and their number as ``copies``: at most two rows per
    customer and month, counted before the shuffle."""
    keys = ["Customer_ID", "label_snapshot_date", "label"]
    return outcomes(loans, dpd, mob).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def repeat_rows(df: DataFrame, copies: Column, chunk: int = 10_000) -> DataFrame:
    """Every row ``copies`` times. Rows of more than ``chunk`` copies are cut into chunks, and the chunks are
    dealt to all tasks before they are multiplied out, so no task makes the copies of one row alone."""
    columns = df.columns
    counted = df.withColumn("__copies", copies)
    few = counted.where(F.col("__copies") <= chunk).withColumn("__part", F.col("__copies"))
    chunks = F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / chunk).cast("bigint"))
    many = counted.where(F.col("__copies") > chunk).select("*", F.explode(chunks).alias("__chunk"))
    # a fixed number: by their size alone the chunks would be put together again
    n_tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(n_tasks, "__chunk", *columns)
    many = many.withColumn("__part", F.least(F.lit(chunk), F.col("__copies") - F.col("__chunk") * chunk)).drop("__chunk")
    parts = few.unionByName(many).where(F.col("__part") > 0)
    return parts.select("*", F.explode(F.sequence(F.lit(1), F.col("__part").cast("int"))).alias("__copy")).select(*columns)


def join_outcomes(feat: DataFrame, labelled: DataFrame, mob: int = K.MOB_CUTOFF, salt: bool = False) -> DataFrame:
    """Features of month m joined to the same customer's outcomes at month m + mob.

    One inner equi-join on (customer, outcome month) covers every month; every row of
    ``labelled`` (outcomes or outcome counts) that matches gives one output row. A hot customer
    is split by AQE's skew join, which applies because nothing above the join relies on its
    partitioning when the result is written; with ``salt`` by salts, whatever stands above the join, for one more pass.
    """
    features = feat.withColumnRenamed(SNAPSHOT, "feature_snapshot_date").withColumn(
        "label_snapshot_date", F.add_months("feature_snapshot_date", mob)
    )
    extra = [c for c in labelled.columns if c not in ("Customer_ID", "label_snapshot_date", "label")]
    join = salted_join if salt else DataFrame.join
    return join(features, labelled, ["Customer_ID", "label_snapshot_date"]).select(
        *[c for c in features.columns if c != "label_snapshot_date"], "label", "label_snapshot_date", *extra
    )


def multi_snapshot_join(
    feat: DataFrame,
    loans: DataFrame,
    dpd: int = K.DPD_CUTOFF,
    mob: int = K.MOB_CUTOFF,
    require_rows: bool = False,
    salt: bool = False,
) -> DataFrame:
    """Features with the label their customer's loans show ``mob`` months later.

    The loans are cut to the rows at ``mob`` and three narrow columns before the shuffle.
    """
    if require_rows and valid_slices(feat, loans, mob).isEmpty():
        raise ValueError(f"no feature month has an outcome month {mob} months later")
    return join_outcomes(feat, outcomes(loans, dpd, mob), mob, salt)


def join_sources(sources: list[DataFrame], on: list[str] = LABELLED_KEYS) -> DataFrame:
    """Inner join of several feature tables on their shared keys; duplicates fan out."""
    return reduce(lambda left, right: left.join(right, on, "inner"), sources)


def attach_labels(
    feat: DataFrame,
    labels: DataFrame,
    on: list[str] | None = None,
    columns: list[str] | None = None,
    salt: bool = False,
) -> DataFrame:
    """Features joined to labels, by default on the customer only: every feature month meets
    every label of the customer. Shared non-key columns get the suffixes ``_x`` and ``_y``. ``salt`` spreads customers
    with many feature months."""
    on = on or ["Customer_ID"]
    feat = feat if columns is None else feat.select(*columns)
    shared = [c for c in feat.columns if c in labels.columns and c not in on]
    left = feat.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = labels.withColumnsRenamed({c: f"{c}_y" for c in shared})
    return salted_join(left, right, on) if salt else left.join(right, on, "inner")


def attach_label_counts(feat: DataFrame, labels: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Features with each label value of the customer once, ``weight`` saying how often.

    Stands for ``attach_labels`` wherever only (features, label) matter, as in training: labels
    are counted per customer before the join, so a customer with many feature months and many
    labels gives two rows per month instead of every pair.
    """
    on = on or ["Customer_ID"]
    counts = labels.groupBy(*on).agg(
        F.count_if(F.col("label") == 1).alias("__n1"), F.count_if(F.col("label") == 0).alias("__n0")
    )
    both = F.array(
        F.struct(F.lit(1).alias("label"), F.col("__n1").alias("weight")),
        F.struct(F.lit(0).alias("label"), F.col("__n0").alias("weight")),
    )
    # written first: the join then shuffles both sides itself, which lets AQE split a hot customer
    return feat.join(stage(counts, "label-counts"), on).select(*feat.columns, F.inline(both)).where(F.col("weight") > 0)


def attach_features(labels: DataFrame, feat: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Every label with the features of the same customer and snapshot, if any."""
    return labels.join(feat, on or ["Customer_ID", SNAPSHOT], "left")


