"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Shuffle partitions are sized at run time, joins are re-planned on measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split over tasks, also where that costs another shuffle further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Large months are split when tables are written by snapshot.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Feature rows without an outcome are dropped before the shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # What is read again is written, so a query's shuffle files are of no use after it: they go at once, not when the
    # driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session. All are runtime SQL settings."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
