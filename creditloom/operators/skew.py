"""Joins whose hot keys are found by a sketch and salted, so that they are spread without a run-time re-plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Keys that are salted at most, and keys that the sketch tracks to find them.
HEAVY, TRACKED = 256, 8192
#: Parts that the rows of one task are cut into; a key with more rows than a part is hot.
PARTS = 4


def heavy_keys(df: DataFrame, on: list[str], n_tasks: int) -> dict[int, int]:
    """The hash of every hot key and the number of salts that cut it to parts of a task's even share.

    One pass, with map-side sketches; at most ``HEAVY`` keys come to the driver. A key that the sketch misses is joined
    unsalted: right, but not spread.
    """
    found = df.select(F.xxhash64(*on).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {HEAVY}, {TRACKED})").alias("top")
    ).first()
    part = max(1.0, found["n"] / (n_tasks * PARTS))
    return {r["item"]: min(n_tasks * PARTS, -int(-r["count"] // part)) for r in found["top"] or [] if r["count"] > part}


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", n_tasks: int | None = None) -> DataFrame:
    """The equi-join of two tables, hot keys of ``left`` dealt to many tasks; ``how`` is inner, left or left_semi.

    Rows of a hot key get one of its salts by their number in their partition, and the rows of ``right`` with
    that key are repeated once for each salt. All other rows have salt 0. The columns are those of the plain join. Null keys
    match nothing, as in a plain join.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"how {how!r}: a row of the right side would come once for each salt")
    n_tasks = n_tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(left.where(F.col(f"`{on[0]}`").isNotNull()), on, n_tasks)
    if not heavy:
        return left.join(right, on, how)

    def salts(df: DataFrame) -> Column:
        table = F.create_map(*[F.lit(x).cast(kind) for h, s in heavy.items() for x, kind in ((h, "bigint"), (s, "int"))])
        return F.coalesce(F.try_element_at(table, F.xxhash64(*on)), F.lit(1))

    dealt = left.withColumn("__salt", F.expr("monotonically_increasing_id()") % salts(left))
    dealt = dealt.withColumn("__salt", F.col("__salt").cast("int"))
    repeated = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts(right) - 1)))
    return dealt.join(repeated, [*on, "__salt"], how).drop("__salt")
