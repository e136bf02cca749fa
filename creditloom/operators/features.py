"""Gold features: financial, attribute and clickstream features, one-hot encoding, and the
feature store that joins them per customer and feature month."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import mul

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, functions as F

from creditloom import constants as K
from creditloom.functions import values as V
from creditloom.operators import clean, quantiles as Q
from creditloom.operators.ordering import with_total_before
from creditloom.operators.snapshots import LABELLED_KEYS, join_outcomes, join_sources, outcome_counts
from creditloom.sources.staging import stage


# Columns that identify a person; no feature is made of them.
PERSONAL = ["Name", "SSN"]


def category_counts(df: DataFrame, cols: list[str], weight: str | None = None) -> DataFrame:
    """(feature, category, n) of the non-null values, combined before the shuffle."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in cols])
    rows = df.select(*([weight] if weight else []), F.inline(entries)).where(F.col("category").isNotNull())
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return rows.groupBy("feature", "category").agg(n.alias("n"))


def category_index(df: DataFrame, cols: list[str], weight: str | None = None) -> DataFrame:
    """(feature, category, n, index): categories by falling frequency, ties by name."""
    order = [F.desc("n"), F.col("category")]
    ranked = with_total_before(category_counts(df, cols, weight), ["feature"], order, F.lit(1), "index")
    return ranked.withColumn("index", F.col("index").cast("int"))


def one_hot(
    df: DataFrame, cols: list[str], fit_df: DataFrame | None = None, drop: bool = True, weight: str | None = None
) -> DataFrame:
    """Encode ``cols`` into sparse vectors ``<col>_vec`` by the index of their categories.

    A vector has a place for each category of ``fit_df`` (by falling frequency, ties by name); unseen values
    and null are all zeros. The categories stay a table that is joined in, however many there are; only their
    number comes to the driver, one for each column.
    """
    index = stage(category_index(df if fit_df is None else fit_df, cols, weight), "categories")
    sizes = {r["feature"]: r["size"] for r in index.groupBy("feature").agg(F.count(F.lit(1)).alias("size")).collect()}
    out = df
    for c in cols:
        size = sizes.get(c, 0)
        # one place more for unseen and null, which the encoder drops
        nominal = {"ml_attr": {"type": "nominal", "name": f"{c}_idx", "num_vals": size + 1}}
        own = index.where(F.col("feature") == c).select(F.col("category").alias(c), F.col("index").alias("__place"))
        place = F.coalesce(F.col("__place"), F.lit(size)).cast("double")
        out = out.join(own, c, "left").withColumn("__place", place).withMetadata("__place", nominal).withColumnRenamed("__place", f"{c}_idx")
    encoder = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_vec" for c in cols])
    kept = [c for c in df.columns if not (drop and c in cols)]
    return encoder.fit(out).transform(out).select(*kept, *[f"{c}_vec" for c in cols])


def financial_features(
    df: DataFrame,
    encode: bool = True,
    fit_df: DataFrame | None = None,
    weight: str | None = None,
    **quantile_options,
) -> DataFrame:
    """Defaults, median imputation, history length, caps, log and ratios of cleaned financials.

    The median and the five cap bounds come from one pass. ``fit_df`` supplies other rows to
    take them (and the categories) from; by default it is the input itself. ``weight`` names a
    column of row multiplicities that the statistics count by.
    """

    def defaults(rows: DataFrame) -> DataFrame:
        filled = clean.fill_defaults(
            rows, {"Credit_Mix": "Unknown", "Payment_Behaviour": "Unknown", "Changed_Credit_Limit": 0.0}
        )
        return filled.where(F.col("Monthly_Balance").isNotNull())

    rows = defaults(df)
    fit_rows = rows if fit_df is None else defaults(fit_df)
    plan = {"Outstanding_Debt": [0.5], **{c: [K.CAP_LOWER, K.CAP_UPPER] for c in K.FINANCIAL_CAPPED}}
    stats = Q.quantile_values(fit_rows, plan, weight=weight, **quantile_options)

    rows = rows.withColumns(
        {
            "Outstanding_Debt": F.coalesce(F.col("Outstanding_Debt"), Q.literal(stats.get("Outstanding_Debt"))[0]),
            "credit_history_months": V.history_months(F.col("Credit_History_Age")),
            "num_loan_types": V.array_length(F.col("Loan_Types_Array")),
            **{c: Q.cap_expression(c, Q.literal(stats.get(c))) for c in K.FINANCIAL_CAPPED},
        }
    ).drop("Credit_History_Age")

    income, salary = F.col("Annual_Income"), F.col("Monthly_Inhand_Salary")
    debt = F.col("Outstanding_Debt")
    rows = rows.withColumns(
        {
            "log_Annual_Income": F.log1p(income),
            "debt_to_income": V.smoothed_ratio(debt, income),
            "emi_to_salary": V.smoothed_ratio(F.col("Total_EMI_per_month"), salary),
            "investment_rate": V.smoothed_ratio(F.col("Amount_invested_monthly"), salary),
            "has_credit_limit_change": V.flag_nonzero(F.col("Changed_Credit_Limit")),
            "balance_to_debt": V.smoothed_ratio(F.col("Monthly_Balance"), debt, num_add=1.0),
            "inq_per_loan": V.smoothed_ratio(F.col("Num_Credit_Inquiries"), F.col("Num_of_Loan")),
        }
    )
    if not encode:
        return rows
    return one_hot(rows, K.FINANCIAL_CATEGORIES, fit_rows, weight=weight)


def attribute_features(
    df: DataFrame,
    encode: bool = True,
    fit_df: DataFrame | None = None,
    null_band: str | None = K.AGE_BAND_REST,
    weight: str | None = None,
) -> DataFrame:
    """Plausible ages, default occupation and age band of cleaned attributes."""

    def bands(rows: DataFrame) -> DataFrame:
        rows = clean.null_outside(rows, "Age", 18, 75, inclusive=True)
        rows = clean.fill_defaults(rows, {"Occupation": "Unknown"})
        return rows.withColumn("Age_group", V.age_band(F.col("Age"), null_band))

    rows = bands(df)
    if not encode:
        return rows
    return one_hot(rows, K.ATTRIBUTE_CATEGORIES, rows if fit_df is None else bands(fit_df), weight=weight)


def clickstream_features(
    df: DataFrame, fit_df: DataFrame | None = None, features: list[str] | None = None, **quantile_options
) -> DataFrame:
    """Every clickstream feature capped to its own quantiles, all bounds from one pass."""
    return Q.cap_by_quantile(df, features or clean.feature_columns(df), fit_df=fit_df, **quantile_options)


def feature_store(
    fin: DataFrame,
    att: DataFrame,
    clk: DataFrame,
    loans: DataFrame,
    dpd: int = K.DPD_CUTOFF,
    mob: int = K.MOB_CUTOFF,
    encode: bool = True,
    keep: tuple[str, ...] = (),
    staging: Callable[[DataFrame, str], DataFrame] = stage,
    **quantile_options,
) -> DataFrame:
    """Features of every labelled customer month, from the four cleaned tables, with ``copies``.

    The loans are reduced to outcome counts once, so a customer with many loans in a month is
    one or two rows in every join and in the result: ``copies`` says how many rows the plain join of
    the three sources gives there (each of them repeats the outcome). Baselines and statistics count by
    it. Each source is joined to its outcome month and staged, as its statistics are fitted on the
    labelled rows (by their number of copies) and then applied to them: no source is read or shuffled
    twice. ``keep`` names columns to retain although the store normally drops them (such as the label);
    names and numbers of persons are dropped before anything is written.
    """
    att = clean.drop_present(att, [c for c in PERSONAL if c not in keep])
    labels = staging(outcome_counts(loans, dpd, mob), "outcomes")
    labelled = {
        name: staging(join_outcomes(df, labels, mob), name)
        for name, df in {"financials": fin, "attributes": att, "clickstream": clk}.items()
    }
    sources = [
        financial_features(labelled["financials"], encode, weight="copies", **quantile_options),
        attribute_features(labelled["attributes"], encode, weight="copies"),
        clickstream_features(labelled["clickstream"], weight="copies", **quantile_options),
    ]
    store = join_sources(sources, [*LABELLED_KEYS, "copies"])
    store = store.withColumn("copies", reduce(mul, [F.col("copies")] * len(sources)))
    return clean.drop_present(store, [c for c in K.FEATURE_STORE_DROPS if c not in keep])
