"""Scans: CSV, Parquet layers, file lists, single snapshots, baselines, runs and metrics."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from creditloom import constants as K


def _by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The data files below a path, file or glob, compressed ones too, in groups with the same first line."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    groups: dict[str, list[str]] = {}
    todo = list(fs.globStatus(at) or [])
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += [s for s in fs.listStatus(status.getPath()) if not s.getPath().getName().startswith(("_", "."))]
            continue
        stream, codec = fs.open(status.getPath()), codecs.getCodec(status.getPath())
        try:
            stream = stream if codec is None else codec.createInputStream(stream)
            first = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream)).readLine()
        finally:
            stream.close()
        if first is not None:  # an empty file has neither header nor rows
            groups.setdefault(first, []).append(status.getPath().toString())
    return [groups[first] for first in sorted(groups)]


def _typed(text: DataFrame, schema: StructType) -> DataFrame:
    present = set(text.columns)
    return text.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields if f.name in present],
        *[F.col(f"`{c}`") for c in text.columns if c not in schema.names],
    )


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header. Fields are matched to a declared schema by header name, whatever the column order,
    in every file: files with the same header are one scan, and the scans are put together by name, null where
    a file lacks a column. Unparseable values become null; without a schema types are inferred, which costs
    one more pass."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    groups = _by_header(spark, path)
    if len(groups) < 2:
        return _typed(reader.option("inferSchema", False).csv(path), schema)
    # partition folders of the path give columns too
    based = reader.option("inferSchema", False).option("basePath", path) if "*" not in path else reader.option("inferSchema", False)
    parts = [_typed(based.csv(files), schema) for files in groups]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part, allowMissingColumns=True)
    return table.select(*[c for c in schema.names if c in table.columns], *[c for c in table.columns if c not in schema.names])


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(root, layer, name))


def read_files(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """Parquet files from a list of paths, globs, or a folder filtered by a file-name pattern."""
    reader = spark.read if pattern is None else spark.read.option("pathGlobFilter", pattern)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def read_snapshot(df: DataFrame, snapshot: dt.date | str, date_col: str = "snapshot_date") -> DataFrame:
    """Rows of one snapshot. A DATE literal, so partitioned tables are pruned to one folder."""
    return df.where(F.col(date_col) == as_date(snapshot))


def as_date(value: dt.date | str):
    """DATE literal (never a timestamp, which would add a cast and block pruning)."""
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    elif isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value)


def read_baseline(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Baseline features by file extension (csv, parq, parquet)."""
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension == ".csv":
        df = read_csv(spark, path)
    elif extension in (".parq", ".parquet"):
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported baseline extension {extension!r}: {path}")
    return df if columns is None else df.select(*columns)


def read_runs(spark: SparkSession, path: str, newest_first: bool = False) -> DataFrame:
    """Run records, from folders by day or a flat folder. They are read whole: there is no cap on the number of runs."""
    runs = spark.read.schema(K.RUNS_SCHEMA).parquet(path).select(*K.RUNS_SCHEMA.names)
    return runs.orderBy(F.desc("start_time")) if newest_first else runs


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Long metric table from Parquet or CSV, with the snapshot date as yyyy-MM-dd text."""
    if path.rstrip("/").lower().endswith(".csv"):
        metrics = read_csv(spark, path, K.METRICS_SCHEMA)
    else:
        metrics = spark.read.parquet(path)
    return metrics.withColumn("snapshot_date", date_text(metrics, "snapshot_date"))


def date_text(df: DataFrame, column: str):
    """yyyy-MM-dd text of a date, timestamp or already textual column; other text is kept."""
    c = F.col(column)
    if dict(df.dtypes)[column] == "string":
        return F.coalesce(F.date_format(c.try_cast("date"), "yyyy-MM-dd"), c)
    return F.date_format(c, "yyyy-MM-dd")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_optional(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV when the file exists, otherwise an empty table with the same schema."""
    if path_exists(spark, path):
        return read_csv(spark, path, schema)
    return spark.createDataFrame([], schema)


def run_files(spark: SparkSession, path: str) -> DataFrame:
    """(day, n_files, n_runs) of a run log that is kept by day."""
    runs = spark.read.schema(K.RUNS_SCHEMA).parquet(path).select("day", F.col("_metadata.file_path").alias("file"))
    return runs.groupBy("day").agg(F.count_distinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_runs"))
