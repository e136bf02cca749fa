"""Bronze to silver: null tokens, typed columns, domain checks, and the four table cleaners.

Each cleaner is one flat projection plus one filter, so it runs in a single scan stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from creditloom import constants as K
from creditloom.functions import delinquency as D, values as V

KEYS = ["Customer_ID", "snapshot_date"]


def null_tokens(df: DataFrame, tokens: list[str] = K.NULL_TOKENS) -> DataFrame:
    """String columns holding exactly one of the tokens become null; other types are untouched."""
    return df.replace(tokens, None)


def require_keys(df: DataFrame, columns: list[str] = KEYS) -> DataFrame:
    return df.dropna(subset=columns)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed projection by a name-to-type map; unparseable values become null."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})


def clean_numbers(df: DataFrame, columns: list[str], decimal: bool = True) -> DataFrame:
    """Dirty text columns to numbers. Columns that are numeric already are only cast."""
    types, target = dict(df.dtypes), "double" if decimal else "int"
    return df.withColumns(
        {
            c: V.clean_number(F.col(c), decimal) if types[c] == "string" else F.col(c).try_cast(target)
            for c in columns
        }
    )


def whitelist(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.withColumn(column, V.keep_values(F.col(column), values))


def null_outside(df: DataFrame, column: str, lo, hi, inclusive: bool = False) -> DataFrame:
    return df.withColumn(column, V.keep_range(F.col(column), lo, hi, inclusive))


def null_unless_match(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.withColumn(column, V.keep_match(F.col(column), pattern))


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Constant defaults for nulls, each in its column's own type."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """Every numeric null becomes 0."""
    return df.fillna(0)


def with_constants(df: DataFrame, **constants) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def feature_columns(df: DataFrame, prefix: str = K.FEATURE_PREFIX) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def drop_present(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def clean_financials(df: DataFrame, loan_type_separator: str = K.LOAN_TYPE_SEPARATOR) -> DataFrame:
    df = null_tokens(df)
    df = clean_numbers(df, K.FINANCIAL_DOUBLES)
    df = clean_numbers(df, K.FINANCIAL_COUNTS, decimal=False)
    df = cast_columns(df, dict.fromkeys(K.FINANCIAL_INTS, "int"))
    return require_keys(
        df.withColumns(
            {
                "Payment_Behaviour": V.keep_values(F.col("Payment_Behaviour"), K.PAYMENT_BEHAVIOURS),
                "Loan_Types_Array": V.split_list(F.col("Type_of_Loan"), loan_type_separator),
            }
        )
    )


def clean_attributes(df: DataFrame) -> DataFrame:
    df = null_tokens(df, K.ATTRIBUTE_NULL_TOKENS)
    df = clean_numbers(df, ["Age"], decimal=False)
    df = null_outside(df, "Age", 0, 100)
    df = null_unless_match(df, "SSN", K.SSN_PATTERN)
    return require_keys(df)


def clean_clickstream(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    df = null_tokens(df)
    return require_keys(cast_columns(df, dict.fromkeys(features or K.CLICKSTREAM_FEATURES, "int")))


def clean_loans(df: DataFrame) -> DataFrame:
    """Typed loan rows with months on book, missed instalments and days past due."""
    df = require_keys(cast_columns(df, K.LOAN_TYPES))
    snapshot, overdue = F.col("snapshot_date"), F.col("overdue_amt")
    return (
        df.withColumns(
            {
                "mob": D.months_on_book(F.col("installment_num")),
                "installments_missed": D.installments_missed(overdue, F.col("due_amt")),
            }
        )
        .withColumn("first_missed_date", D.first_missed_date(snapshot, F.col("installments_missed")))
        .withColumn("dpd", D.days_past_due(snapshot, overdue, F.col("first_missed_date")))
    )
