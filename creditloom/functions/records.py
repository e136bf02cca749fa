"""Expressions over run records (tag, parameter and metric maps)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def map_value(m: Column, key: str, default: str | None = None) -> Column:
    """Value of ``key``; the default when it is absent or an empty string."""
    value = F.nullif(F.try_element_at(m, F.lit(key)), F.lit(""))
    return value if default is None else F.coalesce(value, F.lit(default))


def first_of(key: str, *maps: Column) -> Column:
    """First non-empty value of ``key`` over several maps (tags before parameters)."""
    return F.coalesce(*[map_value(m, key) for m in maps])


def snapshot_of(artifact: Column) -> Column:
    """Snapshot date in an artefact name such as ``<model type>_2024-01-01.pkl``."""
    return F.regexp_extract(artifact, r"_(\d{4}-\d{2}-\d{2})(?:\.[^.]*)?$", 1).try_cast("date")


def model_type_of(artifact: Column) -> Column:
    return F.regexp_extract(artifact, r"^(.*)_\d{4}-\d{2}-\d{2}(?:\.[^.]*)?$", 1)


def strip_prefix(c: Column, prefix: str) -> Column:
    return F.replace(c, F.lit(prefix), F.lit(""))
