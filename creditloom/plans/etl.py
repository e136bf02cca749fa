"""Medallion build: CSV sources to bronze, cleaned silver tables, gold labels and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditloom import constants as K
from creditloom.operators import clean, drift, features, labels
from creditloom.sources import readers, writers
from creditloom.sources.staging import temporary_tables

# File names of the four sources below the data folder (fixed values).
SOURCE_FILES = {
    "clickstream": "feature_clickstream.csv",
    "attributes": "features_attributes.csv",
    "financials": "features_financials.csv",
    "loans": "lms_loan_daily.csv",
}
CLEANERS = {
    "financials": clean.clean_financials,
    "attributes": clean.clean_attributes,
    "clickstream": clean.clean_clickstream,
    "loans": clean.clean_loans,
}


def build_bronze(spark: SparkSession, data_dir: str, root: str) -> dict[str, DataFrame]:
    sources = {name: f"{data_dir.rstrip('/')}/{file}" for name, file in SOURCE_FILES.items()}
    return writers.ingest_sources(spark, sources, root)


def build_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    tables = {}
    for name, cleaner in CLEANERS.items():
        rows = readers.read_table(spark, root, "bronze", name)
        by = "snapshot_date" if name in K.PARTITIONED["silver"] else None
        if by and name not in K.PARTITIONED["bronze"]:
            # clustered before the cleaner adds its columns; bronze folders by snapshot are clustered as they are
            rows = rows.hint("rebalance", by)
        writers.write_table(cleaner(rows), root, "silver", f"{name}_clean", by, whole=True, clustered=True)
        tables[name] = readers.read_table(spark, root, "silver", f"{name}_clean")
    return tables


def build_label_store(
    spark: SparkSession, root: str, dpd: int = K.DPD_CUTOFF, mob: int = K.MOB_CUTOFF, with_def: bool = False
) -> DataFrame:
    loans = readers.read_table(spark, root, "silver", "loans_clean")
    writers.write_table(labels.label_store(loans, dpd, mob, with_def), root, "gold", "label_store")
    return readers.read_table(spark, root, "gold", "label_store")


def build_feature_store(
    spark: SparkSession, root: str, dpd: int = K.DPD_CUTOFF, mob: int = K.MOB_CUTOFF, **options
) -> DataFrame:
    silver = {name: readers.read_table(spark, root, "silver", f"{name}_clean") for name in CLEANERS}
    with temporary_tables(spark):
        store = features.feature_store(
            silver["financials"],
            silver["attributes"],
            silver["clickstream"],
            silver["loans"],
            dpd,
            mob,
            **options,
        )
        writers.write_table(store, root, "gold", "feature_store")
    return readers.read_table(spark, root, "gold", "feature_store")


def build_gold(spark: SparkSession, root: str, **options) -> dict[str, DataFrame]:
    return {
        "label_store": build_label_store(spark, root),
        "feature_store": build_feature_store(spark, root, **options),
    }


def run(spark: SparkSession, data_dir: str, root: str, **options) -> dict[str, DataFrame]:
    build_bronze(spark, data_dir, root)
    build_silver(spark, root)
    return build_gold(spark, root, **options)


def extract_baseline(spark: SparkSession, root: str, path: str, mode: str = "all") -> str:
    """Baseline features of the feature store as CSV (or Parquet when the path says so)."""
    rows = drift.baseline(readers.read_table(spark, root, "gold", "feature_store"), mode)
    if path.rstrip("/").lower().endswith((".parquet", ".parq")):
        return writers.write_parquet(rows, path)
    return writers.write_csv(rows, path)
