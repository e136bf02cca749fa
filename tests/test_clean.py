import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.functions import values as V
from creditloom.operators import clean

D = dt.date(2023, 1, 1)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_null_tokens_match_whole_strings_only(spark):
    rows = [("_", 1), ("NA", 2), ("na", 3), ("N/A", 4), ("_______", 5), ("a_", None), (None, 0)]
    df = spark.createDataFrame(rows, "s string, n int")
    assert [r.s for r in clean.null_tokens(df).collect()] == [None] * 4 + ["_______", "a_", None]
    assert [r.n for r in clean.null_tokens(df).collect()] == [1, 2, 3, 4, 5, None, 0]
    assert clean.null_tokens(df, K.ATTRIBUTE_NULL_TOKENS).collect()[4].s is None


def test_clean_number(spark):
    dirty = ["12_", "-500", "__10000__", "", "1.2.3", None, "1.5", "abc"]
    assert column(spark, dirty, "string", V.clean_number) == [12.0, 500.0, 10000.0, None, None, None, 1.5, None]
    whole = column(spark, dirty, "string", lambda c: V.clean_number(c, decimal=False))
    assert whole == [12, 500, 10000, None, 123, None, 15, None]
    signed = column(spark, ["-500", "5", "_-7"], "string", lambda c: V.clean_number(c, keep_sign=True))
    assert signed == [-500.0, 5.0, 7.0]


def test_numeric_columns_are_cast_not_stripped(spark):
    df = spark.createDataFrame([(1.2e7, -5.0)], "a double, b double")
    row = clean.clean_numbers(df, ["a", "b"]).first()
    assert (row.a, row.b) == (1.2e7, -5.0)


@pytest.mark.parametrize(
    "text, default, strict",
    [
        ("Auto Loan", ["auto loan"], ["auto loan"]),
        ("A, and B", ["a", "and b"], ["a", "b"]),
        ("A, B, and C", ["a", "b", "and c"], ["a", "b", "c"]),
        (None, None, None),
    ],
)
def test_split_list(spark, text, default, strict):
    assert column(spark, [text], "string", V.split_list) == [default]
    assert column(spark, [text], "string", lambda c: V.split_list(c, K.LOAN_TYPE_SEPARATOR_STRICT)) == [strict]
    expected = None if default is None else len(default)
    assert column(spark, [text], "string", lambda c: V.array_length(V.split_list(c))) == [expected]


def test_history_months(spark):
    texts = ["10 Years and 3 Months", "10 Years", "1 Year", "3 Months", None]
    assert column(spark, texts, "string", V.history_months) == [123, 120, None, None, None]


def test_age_domains_and_bands(spark):
    ages = [0, 17, 18, 24, 25, 39, 40, 59, 60, 75, 76, 100, None]
    silver = column(spark, ages, "int", lambda c: V.keep_range(c, 0, 100))
    assert silver == [None, 17, 18, 24, 25, 39, 40, 59, 60, 75, 76, None, None]
    gold = column(spark, ages, "int", lambda c: V.keep_range(c, 18, 75, inclusive=True))
    assert gold == [None, None, 18, 24, 25, 39, 40, 59, 60, 75, None, None, None]
    bands = column(spark, gold, "int", V.age_band)
    assert bands == ["60+"] * 2 + ["<25"] * 2 + ["25–39"] * 2 + ["40–59"] * 2 + ["60+"] * 5
    unknown = column(spark, [None, 30], "int", lambda c: V.age_band(c, null_band=None))
    assert unknown == [None, "25–39"]


def test_clean_attributes(spark):
    rows = [
        ("c1", D, "N", "-500", "123-45-6789", "_______"),
        ("c2", D, "N", "34_", "123456789", "Lawyer"),
        ("c3", D, "N", "99", "#F%$D@*&8", "Lawyer"),
        (None, D, "N", "40", None, "Lawyer"),
        ("_", D, "N", "40", None, "Lawyer"),
        ("c4", None, "N", "40", None, "Lawyer"),
    ]
    out = clean.clean_attributes(spark.createDataFrame(rows, K.ATTRIBUTES_SCHEMA)).orderBy("Customer_ID").collect()
    assert [(r.Customer_ID, r.Age, r.SSN, r.Occupation) for r in out] == [
        ("c1", None, "123-45-6789", None),
        ("c2", 34, None, "Lawyer"),
        ("c3", 99, None, "Lawyer"),
    ]


def test_fill_defaults_and_zero(spark):
    df = spark.createDataFrame([(None, None, None), ("x", 2, 1.5)], "s string, n int, d double")
    filled = clean.fill_defaults(df, {"s": "Unknown", "d": 0.0}).collect()
    assert filled[0].asDict() == {"s": "Unknown", "n": None, "d": 0.0}
    assert clean.fill_numeric_zero(df).collect()[0].asDict() == {"s": None, "n": 0, "d": 0.0}


def test_prefix_projection_and_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "fe_1 int, xfe_2 int, fe_3 int")
    assert clean.feature_columns(df) == ["fe_1", "fe_3"]
    assert clean.drop_present(df, ["fe_1", "absent"]).columns == ["xfe_2", "fe_3"]


def test_ratios(spark):
    df = spark.createDataFrame([(4.0, 1.0), (4.0, -1.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(V.smoothed_ratio(F.col("a"), F.col("b"))).collect()] == [2.0, None, None]
    plus = V.smoothed_ratio(F.col("a"), F.col("b"), num_add=1.0)
    assert df.select(plus).first()[0] == 2.5
