"""Feature drift: baselines, histograms over explicit edges, PSI, and the retrain decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creditloom import constants as K
from creditloom.operators.clean import feature_columns
from creditloom.operators.quantiles import decile_edges, long_form
from creditloom.operators.snapshots import at_latest


# A row of a table with this column stands for so many equal rows.
COPIES = "copies"


def baseline(
    store: DataFrame, mode: str = "all", date_col: str = "feature_snapshot_date", prefix: str = K.FEATURE_PREFIX
) -> DataFrame:
    """Feature columns of all snapshots, or of the latest one, with ``copies`` if the store counts by them."""
    if mode not in ("all", "latest"):
        raise ValueError(f"mode {mode!r}")
    rows = store if mode == "all" else at_latest(store, date_col)
    return rows.select(*feature_columns(store, prefix), *_copies(store))


def _copies(df: DataFrame) -> list[str]:
    """The column of row multiplicities, if there is one."""
    return [COPIES] if COPIES in df.columns else []


def baseline_edges(base: DataFrame, cols: list[str], buckets: int = K.PSI_BUCKETS, **options) -> DataFrame:
    """Decile edges of a baseline, whose rows count by their copies."""
    return decile_edges(base, cols, buckets, weight=COPIES if _copies(base) else None, **options)


def bin_number(value: Column, edges: Column, buckets: int) -> Column:
    """Bin 0..buckets-1 of [e_i, e_i+1), the last bin closed; -1 outside.

    Edges may repeat: a bin of no width then stays empty.
    """
    inner = sum((F.when(value >= edges[i], 1).otherwise(0) for i in range(1, buckets)), F.lit(0))
    within = value.between(edges[0], edges[buckets])
    return F.when(within, inner).otherwise(-1)


def edge_values(edges: DataFrame) -> dict[str, list[float]]:
    """The edges by feature: one row for each feature column comes to the driver."""
    rows = edges.select("feature", "edges").collect()
    found = {r["feature"]: r["edges"] for r in rows}
    if len(found) < len(rows):
        # a second row would count a feature's values twice
        raise ValueError("more than one row of edges for a feature")
    return found


def histogram(
    df: DataFrame,
    edges: DataFrame | dict[str, list[float]],
    cols: list[str],
    by: list[str] | None = None,
    buckets: int = K.PSI_BUCKETS,
) -> DataFrame:
    """(by, feature, counts, total): one array of bin counts per group and feature.

    ``total`` also counts values outside the edges. Rows with ``copies`` count so often. A value's bin is found in its
    row, by the edges of its feature as literals; what is counted, map-side, is (group, feature, bin), so a group
    costs a few small records per task however hot it is.
    """
    by, weight = by or [], _copies(df)
    found = edges if isinstance(edges, dict) else edge_values(edges)
    cols = [c for c in cols if c in found]
    own = F.array(*[F.array(*[F.lit(float(e)) for e in found[c]]) for c in cols]) if cols else F.array().cast("array<array<double>>")
    names = F.array(*[F.lit(c) for c in cols]).cast("array<string>")
    values = long_form(df, cols, [*by, *weight]) if cols else df.select(*by, *weight, F.lit(0).alias("f"), F.lit(0.0).alias("value")).limit(0)
    mine = F.element_at(own, F.col("f") + 1)
    binned = values.select(*by, *weight, "f", bin_number(F.col("value"), mine, buckets).alias("bin"))
    n = F.sum(COPIES) if weight else F.count(F.lit(1))
    per_bin = binned.groupBy(*by, "f", "bin").agg(n.cast("bigint").alias("n"))
    counts = [F.sum(F.when(F.col("bin") == i, F.col("n")).otherwise(0)).cast("bigint") for i in range(buckets)]
    return (
        per_bin.groupBy(*by, "f")
        .agg(F.array(*counts).alias("counts"), F.sum("n").cast("bigint").alias("total"))
        .select(*by, F.element_at(names, F.col("f") + 1).alias("feature"), "counts", "total")
    )


def histogram_rows(hist: DataFrame) -> DataFrame:
    """Histogram arrays as one row per bin."""
    kept = [c for c in hist.columns if c != "counts"]
    return hist.select(*kept, F.posexplode("counts").alias("bin", "n"))


def psi_value(base: Column, base_total: Column, cur: Column, cur_total: Column) -> Column:
    """Sum of (b - c) ln(b / c) over the bins' shares, an empty bin counting as 1e-8."""

    def shares(counts: Column, total: Column) -> Column:
        return F.transform(
            counts, lambda n: F.when(n == 0, F.lit(K.PSI_EMPTY_BIN)).otherwise(n / total.cast("double"))
        )

    terms = F.zip_with(
        shares(base, base_total), shares(cur, cur_total), lambda b, c: (b - c) * F.log(b / c)
    )
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def psi(
    base: DataFrame,
    current: DataFrame,
    cols: list[str] | None = None,
    by: list[str] | None = None,
    buckets: int = K.PSI_BUCKETS,
    edges: DataFrame | dict[str, list[float]] | None = None,
    **quantile_options,
) -> DataFrame:
    """(by, feature, psi) of every feature, for all snapshots of ``current`` in one job.

    Features without any value on either side are left out.
    """
    cols = cols or feature_columns(base)
    if edges is None:
        edges = baseline_edges(base, cols, buckets, **quantile_options)
    edges = edges if isinstance(edges, dict) else edge_values(edges)
    expected = histogram(base, edges, cols, buckets=buckets).select(
        "feature", F.col("counts").alias("base_counts"), F.col("total").alias("base_total")
    )
    actual = histogram(current, edges, cols, by, buckets)
    # expected has one row per feature column
    joined = actual.join(F.broadcast(expected), "feature")
    value = psi_value(F.col("base_counts"), F.col("base_total"), F.col("counts"), F.col("total"))
    return joined.select(*(by or []), "feature", value.alias("psi"))


def psi_by_snapshot(base: DataFrame, current: DataFrame, cols: list[str] | None = None, **options) -> DataFrame:
    return psi(base, current, cols, by=["snapshot_date"], **options)


def psi_summary(psi_rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    return psi_rows.groupBy(*(by or [])).agg(
        F.avg("psi").alias("psi_mean"), F.max("psi").alias("psi_max")
    )


def psi_global(psi_rows: DataFrame) -> DataFrame:
    """Largest PSI over every snapshot and feature; 0 when there is none."""
    return psi_rows.agg(F.round(F.coalesce(F.max("psi"), F.lit(0.0)), 6).alias("psi_max"))


def drift_decision(
    summary: DataFrame, threshold: float = K.PSI_THRESHOLD, missing: float = 1.0
) -> DataFrame:
    """Retrain from the threshold on; a missing PSI counts as ``missing``."""
    measured = F.coalesce(F.col("psi_max"), F.lit(missing))
    return summary.withColumn(
        "decision", F.when(measured >= threshold, "trigger_retrain").otherwise("continue_pipeline")
    )
