"""Labels from cleaned loans: label store, cohort filters, bad rate by months on book."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from creditloom import constants as K
from creditloom.functions import delinquency as D
from creditloom.sources.readers import as_date


def at_mob(loans: DataFrame, mob: int = K.MOB_CUTOFF) -> DataFrame:
    return loans.where(F.col("mob") == mob)


def at_installment(loans: DataFrame, installment: int) -> DataFrame:
    return loans.where(F.col("installment_num") == installment)


def started_before(loans: DataFrame, day: dt.date | str) -> DataFrame:
    return loans.where(F.col("loan_start_date") < as_date(day))


def label_store(
    loans: DataFrame, dpd: int = K.DPD_CUTOFF, mob: int = K.MOB_CUTOFF, with_def: bool = False
) -> DataFrame:
    """One label per loan at the given months on book: 1 if ``dpd`` days late or more."""
    label = D.delinquency_label(F.col("dpd"), dpd).alias("label")
    columns = ["Customer_ID", "loan_id", label]
    if with_def:
        columns.append(D.label_definition(dpd, mob).alias("label_def"))
    return at_mob(loans, mob).select(*columns, "snapshot_date")


def bad_rate_by(loans: DataFrame, key: str = "mob", dpd: int = K.DPD_CUTOFF) -> DataFrame:
    """Share of rows at least ``dpd`` days late per key. Partial sums are combined before the
    shuffle, so a key holding most rows costs one small record per task."""
    flag = D.delinquency_label(F.col("dpd"), dpd).cast("double")
    return loans.groupBy(key).agg(F.avg(flag).alias("bad_rate")).orderBy(key)
