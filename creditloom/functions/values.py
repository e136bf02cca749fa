"""Column-level cleaning and feature expressions. Everything stays a built-in expression, so
whole projections compile into one codegen stage."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from creditloom import constants as K


def clean_number(c: Column, decimal: bool = True, keep_sign: bool = False) -> Column:
    """Number parsed from dirty text: every other character is dropped, unparseable is null.

    The minus sign is dropped too ("-500" is 500) unless ``keep_sign``.
    """
    kept = "0-9" + ("." if decimal else "")
    digits = F.regexp_replace(c, f"[^{kept}]", "").try_cast("double" if decimal else "int")
    if not keep_sign:
        return digits
    return F.when(F.ltrim(c).startswith("-"), -digits).otherwise(digits)


def split_list(c: Column, sep: str = K.LOAN_TYPE_SEPARATOR) -> Column:
    return F.transform(F.split(c, sep), lambda item: F.lower(F.trim(item)))


def history_months(c: Column) -> Column:
    """Months in "N Years and M Months"; null without years, no months part counts as 0."""
    years = F.regexp_extract(c, r"(\d+)\s+Years", 1).try_cast("int")
    months = F.regexp_extract(c, r"(\d+)\s+Months", 1).try_cast("int")
    return years * 12 + F.coalesce(months, F.lit(0))


def keep_values(c: Column, values: list[str]) -> Column:
    return F.when(c.isin(values), c)


def keep_range(c: Column, lo, hi, inclusive: bool = False) -> Column:
    return F.when(c.between(lo, hi) if inclusive else (c > lo) & (c < hi), c)


def keep_match(c: Column, pattern: str) -> Column:
    return F.when(c.rlike(pattern), c)


def smoothed_ratio(num: Column, den: Column, num_add: float = 0.0, den_add: float = 1.0) -> Column:
    """(num + num_add) / (den + den_add); null when the denominator is 0."""
    return F.try_divide(num + F.lit(num_add) if num_add else num, den + F.lit(den_add))


def flag_nonzero(c: Column) -> Column:
    return (c != 0).cast("int")


def age_band(age: Column, null_band: str | None = K.AGE_BAND_REST) -> Column:
    """Name of the age band. Missing ages fall into ``null_band`` (the oldest band by default)."""
    bands = F.when(age.isNull(), F.lit(null_band))
    for upper, name in K.AGE_BANDS:
        bands = bands.when(age < upper, name)
    return bands.otherwise(K.AGE_BAND_REST)


def array_length(c: Column) -> Column:
    """Number of items; null for a null array whatever the ANSI setting."""
    return F.when(c.isNotNull(), F.size(c))
