"""Shared pieces of the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.sources.staging import rows_one_by_one, stage

#: Separators of the word pattern [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ on bytes; A-Z becomes a-z.
_WORD_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z" else (b + 32 if "A" <= chr(b) <= "Z" else 32)
    for b in range(256)
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: str | bytes) -> list[bytes]:
    """Lower-cased (A-Z only) runs of digits, letters and non-ASCII characters, as UTF-8."""
    data = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    return data.translate(_WORD_BYTES).split()


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of so many rows at most, so that what a task makes of a piece is small whatever the batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def md5_order(column: str) -> Column:
    """Text whose order is a fixed pseudorandom order of the values."""
    return F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")))


def running_total(df: DataFrame, groups: list[str], order: str, ties: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in its group.

    ``order`` is a column of md5 text. Its first three digits cut every group into 4,096 even slices,
    so a group with any share of the rows is spread over tasks; the slices' totals (at most 4,096 rows
    a group) are accumulated by a window, then each slice by its own.
    """
    cut = df.withColumn("__slice", F.substring(order, 1, 3))
    # null-safe keys: a null group is a group
    keys = [f"__key{i}" for i in range(len(groups))]
    for key, group in zip(keys, groups):
        cut = cut.withColumn(key, F.struct(F.col(group).alias("v")))
    per_slice = cut.groupBy(*keys, "__slice").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select(*keys, "__slice", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(*keys, "__slice").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("__within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return (
        placed.join(starts, [*keys, "__slice"])
        .withColumn(out, F.col("__start") + F.col("__within"))
        .drop(*keys, "__slice", "__start", "__within")
    )


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal neighbours."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return starts, np.append(starts[1:], len(keys))


def key_filter(keys: DataFrame, n_bits: int) -> bytes:
    """A filter of fixed size: bit (key mod n_bits) is set for every key of the one column of ``keys``.

    At most n_bits / 64 rows come to the driver, whatever the number of keys.
    """
    name = f"`{keys.columns[0]}`"
    word = F.expr(f"cast(shiftright(pmod({name}, {n_bits}), 6) as int)").alias("word")
    bits = F.expr(f"bit_or(shiftleft(1L, cast(pmod({name}, {n_bits}) & 63 as int)))").alias("bits")
    table = np.zeros(n_bits // 64, np.int64)
    for row in rows_one_by_one(keys.filter(f"{name} is not null").groupBy(word).agg(bits), "filter"):
        table[row["word"]] = row["bits"]
    return table.tobytes()


def in_filter(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (unsigned) have their bit set in the bytes of ``key_filter``; some without being keys."""
    at = keys & np.uint64(len(table) * 8 - 1)
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
