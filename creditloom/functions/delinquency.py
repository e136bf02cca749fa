"""Loan delinquency expressions: months on book, missed instalments, days past due, label."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from creditloom import constants as K


def months_on_book(installment_num: Column) -> Column:
    return installment_num.cast("int")


def installments_missed(overdue: Column, due: Column) -> Column:
    """Instalments covered by the overdue amount, rounded up; null when nothing is due."""
    return F.ceil(F.try_divide(overdue, due)).cast("int")


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(snapshot: Column, overdue: Column, first_missed: Column) -> Column:
    """Days since the first missed instalment; 0 when nothing is overdue, null when something
    is overdue but no instalment was due."""
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0)).cast("int")


def delinquency_label(dpd: Column, cutoff: int = K.DPD_CUTOFF) -> Column:
    return F.when(dpd >= cutoff, F.lit(1)).otherwise(F.lit(0))


def label_definition(dpd: int = K.DPD_CUTOFF, mob: int = K.MOB_CUTOFF) -> Column:
    return F.lit(f"{dpd}dpd_{mob}mob")
