"""Lending-shaped views of the driver tables: orders are loans, customers are borrowers, the
event stream is a run log, embeddings are model features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(c):
    return c.cast("date").cast("string")


def _month(c):
    return F.trunc(c.cast("date"), "MM")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    price, line = F.col("l_extendedprice"), F.col("l_linenumber")
    returned = F.col("l_returnflag") == "R"
    return item.join(order, item.l_orderkey == order.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("loan_id"),
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        F.col("o_orderdate").cast("date").alias("loan_start_date"),
        F.lit(10).alias("tenure"),
        line.alias("installment_num"),
        (price * 10).alias("loan_amt"),
        price.alias("due_amt"),
        F.when(returned, 0.0).otherwise(price).alias("paid_amt"),
        F.when(returned, F.col("l_quantity") * F.col("l_discount") * price).otherwise(0.0).alias("overdue_amt"),
        (price * (10 - line)).alias("balance"),
        F.add_months(_month(F.col("o_orderdate")), line).alias("snapshot_date"),
    )


def customer_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First order (and its price) of each customer and month."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("ck"), _month(F.col("o_orderdate")).alias("sd"))
        .agg(F.min("o_orderkey").alias("ok"), F.min_by("o_totalprice", "o_orderkey").alias("price"))
    )


FINANCIAL_COLUMNS = """
 cast(ck as string) Customer_ID, sd snapshot_date,
 cast(cast(round(price) as bigint) as string) || case when ok%7=0 then '_' else '' end Annual_Income,
 cast(cast(round(price) as bigint)%9000 + 500 as double) Monthly_Inhand_Salary,
 cast(ok%11 as int) Num_Bank_Accounts, cast(ok%9 as int) Num_Credit_Card, cast(ok%34 as int) Interest_Rate,
 case when ok%17=0 then '-100' else cast(ok%8 as string) || case when ok%5=0 then '_' else '' end end Num_of_Loan,
 case ok%4 when 0 then 'Auto Loan' when 1 then 'Auto Loan, and Home Loan' when 2 then 'Home Loan, Student Loan, and Auto Loan' end Type_of_Loan,
 case when ok%10=0 then 'NA' else cast(ok%25 as string) || case when ok%6=0 then '_' else '' end end Num_of_Delayed_Payment,
 case when ok%12=0 then '_' else cast(ok%30 as string) || '.5' end Changed_Credit_Limit,
 cast(ok%15 as int) Num_Credit_Inquiries,
 case ok%4 when 0 then '_' when 1 then 'Good' when 2 then 'Standard' else 'Bad' end Credit_Mix,
 case when ok%19=0 then 'N/A' else cast(ok%5000 as string) || '.25' end Outstanding_Debt,
 cast(ok%100 as string) || '.75' Credit_Utilization_Ratio,
 case when ok%11=0 then 'NA' when ok%13=0 then '1 Year' else cast(ok%30 as string) || ' Years and ' || cast(ok%12 as string) || ' Months' end Credit_History_Age,
 case ok%3 when 0 then 'Yes' when 1 then 'No' else 'NM' end Payment_of_Min_Amount,
 cast(ok%700 as string) || '.5' Total_EMI_per_month,
 case when ok%23=0 then '__10000__' else cast(ok%900 as string) || '.0' end Amount_invested_monthly,
 case when ok%13=0 then '!@9#%8' when ok%2=0 then 'Low_spent_Small_value_payments' else 'High_spent_Large_value_payments' end Payment_Behaviour,
 case when ok%29=0 then 'NA' else cast(ok%1000 as string) || '.1' end Monthly_Balance
"""

ATTRIBUTE_COLUMNS = """
 cast(ck as string) Customer_ID, sd snapshot_date, c_name Name,
 case when ok%21=0 then '-500' else cast(cast(floor(abs(c_acctbal)/90) as bigint) as string) || case when ok%8=0 then '_' else '' end end Age,
 case when ok%14=0 then '#F%$D@*&8' else cast(100+ck%900 as string) || '-' || cast(10+ck%90 as string) || '-' || cast(1000+ck%9000 as string) end SSN,
 case when ok%9=0 then '_______' else c_mktsegment end Occupation
"""

CLICKSTREAM_COLUMNS = "cast(ck as string) Customer_ID, sd snapshot_date,\n " + ",\n ".join(
    f"cast((ok*{2 * i + 1}+ck)%251-60 as int) fe_{i}" for i in range(1, 21)
)


def _select(df: DataFrame, columns: str) -> DataFrame:
    return df.sparkSession.sql(f"select {columns} from {{src}}", src=df)


def financials(spark: SparkSession, sf_dir: str, months: DataFrame | None = None) -> DataFrame:
    return _select(months or customer_months(spark, sf_dir), FINANCIAL_COLUMNS)


def attributes(spark: SparkSession, sf_dir: str, months: DataFrame | None = None) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ck"), "c_name", "c_acctbal", "c_mktsegment"
    )
    return _select((months or customer_months(spark, sf_dir)).join(customer, "ck"), ATTRIBUTE_COLUMNS)


def clickstream(spark: SparkSession, sf_dir: str, months: DataFrame | None = None) -> DataFrame:
    return _select(months or customer_months(spark, sf_dir), CLICKSTREAM_COLUMNS)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records with tag, parameter and metric maps."""
    e = table(spark, sf_dir, "events")
    model_type = F.when(F.col("event_type").isin("click", "view"), "logistic_regression").otherwise("gbt")
    return e.select(
        F.concat(F.lit("run_"), F.col("event_id").cast("string")).alias("run_id"),
        F.col("ts").alias("start_time"),
        F.create_map(
            F.lit("snapshot_date"), _day(F.col("ts")), F.lit("model_type"), model_type
        ).alias("tags"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("params"),
        F.create_map(
            F.lit("auc"),
            F.col("value") / 500,
            F.lit("psi_max"),
            (F.col("event_id") % 37).cast("double") / 100,
        ).alias("metrics"),
    )


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artefact names: each model type stores one per snapshot, on working days only."""
    e = table(spark, sf_dir, "events")
    model_type = F.when(F.col("event_type").isin("click", "view"), "logistic_regression").otherwise("gbt")
    name = F.concat(model_type, F.lit("_"), _day(F.col("ts")), F.lit(".pkl"))
    return e.where(F.weekday("ts") < 5).select(name.alias("name")).distinct()


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return d.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id",
        F.col("lang").alias("model_name"),
        F.col("n_chars").cast("double").alias("prediction"),
        F.col("quality").alias("label"),
    )


def ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.when(F.col("label") < 5, 1).otherwise(0).alias("label"),
        *[F.col("embedding")[i - 1].cast("double").alias(f"fe_{i}") for i in range(1, 21)],
    )
