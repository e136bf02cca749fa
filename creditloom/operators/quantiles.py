"""Quantiles of many columns at once, and the operators built on them.

Quantiles are found by selection: values are counted in bins that keep their order, only the bins that hold a wanted
rank are looked into again, in finer bins, until every such bin holds one value. Each pass is one job for all columns,
with as many groups as there are bins, however many rows; bin counts, not values, come to the driver. Weights
are added up, so a row that stands for many is one row. ``method="approx"`` stops as soon as the rank is
known well enough. Null and NaN are missing values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from creditloom import constants as K


#: Bin counts that one pass brings to the driver at most, over all columns.
GROUPS = 100_000


def _plan(cols: list[str] | dict[str, list[float]], probs: list[float] | None) -> dict[str, list[float]]:
    return dict(cols) if isinstance(cols, dict) else {c: list(probs) for c in cols}


def _whole(df: DataFrame, cols: list[str]) -> bool:
    types = dict(df.dtypes)
    return all(types[c] in ("tinyint", "smallint", "int", "bigint") for c in cols)


def long_form(df: DataFrame, cols: list[str], by: list[str] | None = None, kind: str = "double") -> DataFrame:
    """(by, f, value) with one row per value that is not missing; ``f`` is the column's place in ``cols``."""
    values = F.array(*[F.col(c).cast(kind) for c in cols])
    long = df.select(*(by or []), F.posexplode(values).alias("f", "value"))
    present = F.col("value").isNotNull()
    return long.where(present if kind == "bigint" else present & ~F.isnan("value"))


@dataclass
class _Interval:
    """Values of column number ``f`` between two that occur: ``n`` of them with ``before`` smaller ones, and the wanted ranks."""

    f: int
    low: float
    high: float
    n: int
    before: int
    ranks: list[int] = field(default_factory=list)
    log: bool = False


def _intervals(df: DataFrame, cols: list[str], kind: str, weight: str | None) -> tuple[list[_Interval], list[int]]:
    """The infinite and the finite values of every column, and the number of values of each."""
    n = F.col(weight) if weight else F.lit(1)
    wanted = []
    for c in cols:
        x = F.col(c).cast(kind)
        present = x.isNotNull() & ~F.isnan(x.cast("double"))
        finite = present & (F.abs(x.cast("double")) < float("inf")) if kind == "double" else present
        at = F.when(finite, x)
        below, above = (F.sum(F.when(present & (x == F.lit(e)), n)) if kind == "double" else F.lit(0) for e in (float("-inf"), float("inf")))
        wanted.append(F.struct(F.min(at), F.max(at), F.sum(F.when(finite, n)), below, above))
    row = df.agg(F.array(*wanted).alias("r")).first()["r"]
    parts, totals = [], []
    for f, (low, high, inside, below, above) in enumerate(row):
        below, inside, above = below or 0, inside or 0, above or 0
        parts += [_Interval(f, float("-inf"), float("-inf"), below, 0), _Interval(f, low, high, inside, below)]
        parts.append(_Interval(f, float("inf"), float("inf"), above, below + inside))
        totals.append(below + inside + above)
    return parts, totals


def _place(kind: str) -> Column:
    """Number of a value's bin, which never falls as the value rises; the value itself where there are few."""
    x, low, high, bins = F.col("value"), F.col("low"), F.col("high"), F.col("bins")
    if kind == "bigint":
        near = F.expr("(value - low) * bins div (high - low + 1)")
        far = F.floor((x.cast("double") * 0.5 - low.cast("double") * 0.5) / (high.cast("double") * 0.5 - low.cast("double") * 0.5) * bins)
        place = F.when(F.col("how") == "near", near).otherwise(far.cast("bigint"))
    else:
        linear = F.floor((x * 0.5 - low * 0.5) / (high * 0.5 - low * 0.5) * bins)
        log = F.floor(F.log1p(x - low) / F.log1p(high - low) * bins)
        place = F.when(F.col("how") == "linear", linear).otherwise(log).cast("double")
    return F.when(F.col("how") == "value", x).otherwise(place)


def _how(i: _Interval, bins: int, kind: str) -> str:
    if i.n <= bins:
        return "value"
    if kind == "bigint":
        # whole-number bins as far as they cannot overflow
        return "near" if i.high - i.low < 2**62 // bins else "far"
    if i.high * 0.5 - i.low * 0.5 == 0:
        return "value"
    return "log" if i.log and math.isfinite(i.high - i.low) else "linear"


def _split(df: DataFrame, cols: list[str], kind: str, weight: str | None, open_: list[_Interval]) -> list[_Interval]:
    """One pass over the data: the parts of the open intervals that hold a wanted rank."""
    bins = max(16, min(4096, GROUPS // len(open_)))
    rows = [(no, i.f, i.low, i.high, bins, _how(i, bins, kind)) for no, i in enumerate(open_)]
    table = df.sparkSession.createDataFrame(rows, f"no int, f int, low {kind}, high {kind}, bins int, how string")
    values = long_form(df, cols, [weight] if weight else None, kind)
    # one row for each interval looked into
    met = values.join(F.broadcast(table), "f").where(F.col("value").between(F.col("low"), F.col("high")))
    n = F.sum(weight) if weight else F.count(F.lit(1))
    groups = met.groupBy("no", _place(kind).alias("place")).agg(n.alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    found: list[list] = [[] for _ in open_]
    for r in groups.collect():
        found[r["no"]].append((r["low"], r["high"], r["n"]))
    out = []
    for i, parts in zip(open_, found):
        before = i.before
        for low, high, n in sorted(parts):
            ranks = [r for r in i.ranks if before <= r < before + n]
            if ranks:
                out.append(_Interval(i.f, low, high, n, before, ranks, n > i.n // 8 and not i.log))
            before += n
    return out


def order_statistics(
    df: DataFrame, cols: list[str], ranks_of, weight: str | None = None, accuracy: int | None = None
) -> tuple[dict[str, dict[int, float]], dict[str, int]]:
    """The values at 0-based ranks and the number of values, by column.

    ``ranks_of(column, n)`` gives the ranks that are wanted of n values. With ``accuracy`` a value may be off by
    n / accuracy ranks.
    """
    kind = "bigint" if _whole(df, cols) else "double"
    rows = df.where(F.col(weight) > 0) if weight else df
    parts, totals = _intervals(rows, cols, kind, weight)
    answers: dict[str, dict[int, float]] = {c: {} for c in cols}
    for i in parts:
        i.ranks = [r for r in (ranks_of(cols[i.f], totals[i.f]) if totals[i.f] else []) if i.before <= r < i.before + i.n]
    open_ = [i for i in parts if i.ranks]
    while open_:
        done = [i for i in open_ if i.low == i.high or (accuracy and i.n <= totals[i.f] / accuracy)]
        for i in done:
            answers[cols[i.f]].update({r: i.high for r in i.ranks})
        open_ = [i for i in open_ if i not in done]
        if open_:
            mine = sorted({i.f for i in open_})
            renumbered = [_Interval(mine.index(i.f), i.low, i.high, i.n, i.before, i.ranks, i.log) for i in open_]
            open_ = _split(rows, [cols[f] for f in mine], kind, weight, renumbered)
            for i in open_:
                i.f = mine[i.f]
    return answers, dict(zip(cols, totals))


def _wanted(n: int, p: float, interpolate: bool) -> list[int]:
    if interpolate:
        lower = math.floor((n - 1) * p)
        return [lower, min(lower + 1, n - 1)]
    # decimal product: p * n must not round across an integer
    return [max(math.ceil(Decimal(repr(p)) * n) - 1, 0)]


def quantile_values(
    df: DataFrame,
    cols: list[str] | dict[str, list[float]],
    probs: list[float] | None = None,
    method: str = "exact",
    interpolate: bool = False,
    accuracy: int = 1000,
    weight: str | None = None,
) -> dict[str, list[float]]:
    """The quantiles of every column with any value; see ``quantile_table``. Runs its jobs at once."""
    if method not in ("exact", "approx") or (method == "approx" and interpolate):
        raise ValueError(f"method {method!r} with interpolate={interpolate}")
    plan = _plan(cols, probs)

    def ranks(c: str, n: int) -> list[int]:
        return sorted({r for p in plan[c] for r in _wanted(n, float(p), interpolate)})

    found, totals = order_statistics(df, list(plan), ranks, weight, accuracy if method == "approx" else None)

    def value(c: str, p: float) -> float:
        n = totals[c]
        at = [found[c][r] for r in _wanted(n, p, interpolate)]
        if not interpolate:
            return at[0]
        a, b = at
        t = (n - 1) * p - math.floor((n - 1) * p)
        if a == b:
            return float(a)
        # from the nearer end, so that equal neighbours give exactly that value
        return float(a + (b - a) * t if t < 0.5 else b - (b - a) * (1.0 - t))

    return {c: [value(c, float(p)) for p in own] for c, own in plan.items() if totals[c]}


def quantile_table(
    df: DataFrame,
    cols: list[str] | dict[str, list[float]],
    probs: list[float] | None = None,
    method: str = "exact",
    interpolate: bool = False,
    accuracy: int = 1000,
    weight: str | None = None,
) -> DataFrame:
    """(feature, quantiles): one row per column with any value; null and NaN are ignored.

    ``cols`` may map each column to its own probabilities. Without ``interpolate`` a quantile
    is the smallest value with at least that share of rows at or below it. ``accuracy`` bounds
    the rank error of ``approx`` by 1/accuracy. ``weight`` names a column of row multiplicities.
    Exact quantiles of whole-number columns alone are bigints unless interpolated, others doubles.
    """
    plan = _plan(cols, probs)
    values = quantile_values(df, plan, None, method, interpolate, accuracy, weight)
    whole = _whole(df, list(plan)) and not interpolate and method == "exact"
    rows = [(c, [v if whole else float(v) for v in own]) for c, own in values.items()]
    return df.sparkSession.createDataFrame(rows, f"feature string, quantiles array<{'bigint' if whole else 'double'}>")


def quantile_row(df: DataFrame, cols, probs=None, **options) -> DataFrame:
    """The quantiles as one row with one array column per feature."""
    table = quantile_table(df, cols, probs, **options)
    values = {r["feature"]: r["quantiles"] for r in table.collect()}
    names, kind = list(_plan(cols, probs or [])), table.schema["quantiles"].dataType.simpleString()
    schema = ", ".join(f"`{c}` {kind}" for c in names)
    return df.sparkSession.createDataFrame([tuple(values.get(c) for c in names)], schema)


def quantiles(df: DataFrame, cols: list[str], probs: list[float], **options) -> DataFrame:
    """(feature, prob, value) with one row per column and probability."""
    table = quantile_table(df, cols, probs, **options)
    paired = F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("quantiles").alias("value"))
    return table.select("feature", F.inline(paired).alias("prob", "value"))


def literal(values: list[float] | None) -> Column:
    """Fitted values as an array literal; null if the column had none."""
    if not values:
        return F.lit(None).cast("array<double>")
    return F.array(*[F.lit(v).cast("bigint" if isinstance(v, int) else "double") for v in values])


def impute_median(df: DataFrame, column: str, fit_df: DataFrame | None = None, **options) -> DataFrame:
    median = quantile_values(df if fit_df is None else fit_df, [column], [0.5], **options)
    value = F.col(column)
    if dict(df.dtypes)[column] in ("float", "double"):
        value = F.nanvl(value, F.lit(None))
    return df.withColumn(column, F.coalesce(value, literal(median.get(column))[0]))


def cap_expression(column: str, bounds: Column) -> Column:
    """Value limited to [bounds[0], bounds[1]] as a double; nulls and NaN stay."""
    value = F.col(column).cast("double")
    limited = F.when(value < bounds[0], bounds[0]).when(value > bounds[1], bounds[1]).otherwise(value)
    return F.when(F.isnan(value), value).otherwise(limited)


def cap_by_quantile(
    df: DataFrame,
    cols: list[str] | str,
    lower: float = K.CAP_LOWER,
    upper: float = K.CAP_UPPER,
    fit_df: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Limit columns to their own quantiles; the bounds of all come from the same passes over ``fit_df``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    bounds = quantile_values(df if fit_df is None else fit_df, cols, [lower, upper], **options)
    return df.withColumns({c: cap_expression(c, literal(bounds.get(c))) for c in cols})


def decile_edges(
    baseline: DataFrame, cols: list[str], buckets: int = K.PSI_BUCKETS, **options
) -> DataFrame:
    """(feature, edges): buckets + 1 linearly interpolated quantile edges per column."""
    probs = [i / buckets for i in range(buckets + 1)]
    table = quantile_table(baseline, cols, probs, interpolate=True, **options)
    return table.withColumnRenamed("quantiles", "edges")
