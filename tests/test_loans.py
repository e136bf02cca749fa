import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditloom.operators import clean, labels as L, snapshots as S


def loan(snapshot, due, overdue, mob=6, customer="c1", loan_id="l1", start=dt.date(2023, 1, 1)):
    return (loan_id, customer, start, 10, mob, 1000.0, due, 0.0, overdue, 500.0, snapshot)


COLUMNS = (
    "loan_id string, Customer_ID string, loan_start_date date, tenure int, installment_num int, loan_amt double,"
    " due_amt double, paid_amt double, overdue_amt double, balance double, snapshot_date date"
)


def cleaned(spark, rows):
    return clean.clean_loans(spark.createDataFrame(rows, COLUMNS))


@pytest.mark.parametrize(
    "due, overdue, missed, first, dpd",
    [
        (100.0, 0.0, 0, None, 0),
        (100.0, 150.0, 2, dt.date(2023, 5, 1), 61),
        (0.0, 50.0, None, None, None),
        (100.0, None, None, None, 0),
        (None, 0.0, None, None, 0),
    ],
)
def test_days_past_due(spark, due, overdue, missed, first, dpd):
    row = cleaned(spark, [loan(dt.date(2023, 7, 1), due, overdue)]).first()
    assert (row.mob, row.installments_missed, row.first_missed_date, row.dpd) == (6, missed, first, dpd)


def test_month_end_is_clamped(spark):
    row = cleaned(spark, [loan(dt.date(2023, 3, 31), 100.0, 100.0)]).first()
    assert (row.first_missed_date, row.dpd) == (dt.date(2023, 2, 28), 31)


def test_label_boundaries(spark):
    rows = [
        loan(dt.date(2023, 3, 1), 100.0, 100.0, loan_id="feb28"),  # 28 days
        loan(dt.date(2023, 5, 1), 100.0, 100.0, loan_id="apr30"),  # 30 days
        loan(dt.date(2023, 5, 1), 0.0, 100.0, loan_id="nodue"),  # dpd null
        loan(dt.date(2023, 5, 1), 100.0, 100.0, mob=5, loan_id="mob5"),
        loan(dt.date(2023, 5, 1), 100.0, 100.0, mob=7, loan_id="mob7"),
    ]
    store = L.label_store(cleaned(spark, rows))
    assert store.columns == ["Customer_ID", "loan_id", "label", "snapshot_date"]
    assert {r.loan_id: r.label for r in store.collect()} == {"feb28": 0, "apr30": 1, "nodue": 0}
    assert L.label_store(cleaned(spark, rows), 28, 6, with_def=True).first().label_def == "28dpd_6mob"
    assert {r.loan_id: r.label for r in L.label_store(cleaned(spark, rows), dpd=28).collect()}["feb28"] == 1


def test_bad_rate_and_filters(spark):
    rows = [loan(dt.date(2023, 5, 1), 100.0, o, mob=m) for o, m in [(100.0, 1), (0.0, 1), (0.0, 2)]]
    loans = cleaned(spark, rows)
    assert [tuple(r) for r in L.bad_rate_by(loans).collect()] == [(1, 0.5), (2, 0.0)]
    assert L.at_installment(loans, 2).count() == 1
    assert L.started_before(loans, "2023-01-01").count() == 0
    assert L.started_before(loans, "2023-01-02").count() == 3


def panel(spark, rows):
    return spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, x int")


def month(m, year=2023):
    return dt.date(year, m, 1)


def naive_offset_join(features, loans, mob, dpd=30):
    out = []
    for c, d, x in features:
        total = d.month - 1 + mob
        target = dt.date(d.year + total // 12, total % 12 + 1, d.day)
        for row in loans:
            if row.Customer_ID == c and row.snapshot_date == target and row.mob == mob:
                out.append((c, d, x, int(row.dpd is not None and row.dpd >= dpd), target))
    return sorted(out)


def test_multi_snapshot_join_equals_a_loop_over_months(spark):
    features = [("c1", month(1), 1), ("c1", month(2), 2), ("c1", month(8), 3), ("c2", month(1), 4), ("c3", month(1), 5)]
    loans = cleaned(
        spark,
        [
            loan(month(7), 100.0, 200.0, customer="c1", loan_id="a"),
            loan(month(7), 100.0, 0.0, customer="c1", loan_id="b"),  # second loan of the customer
            loan(month(8), 100.0, 0.0, customer="c1", loan_id="a", mob=7),  # wrong months on book
            loan(month(7), 100.0, 0.0, customer="c2", loan_id="c"),
            loan(month(2, 2024), 100.0, 100.0, customer="c1", loan_id="d"),  # over the year's end
            loan(month(7), 100.0, 0.0, customer="c9", loan_id="e"),  # no features
        ],
    )
    joined = S.multi_snapshot_join(panel(spark, features), loans)
    assert joined.columns == ["Customer_ID", "feature_snapshot_date", "x", "label", "label_snapshot_date"]
    assert sorted(map(tuple, joined.collect())) == naive_offset_join(features, loans.collect(), 6)
    assert joined.count() == 4


def test_multi_snapshot_join_without_slices(spark):
    loans = cleaned(spark, [loan(month(1), 100.0, 0.0)])
    features = panel(spark, [("c1", month(1), 1)])
    assert S.multi_snapshot_join(features, loans).count() == 0
    with pytest.raises(ValueError):
        S.multi_snapshot_join(features, loans, require_rows=True)


def test_hot_customer_is_split_by_the_planner(spark):
    """A join key holding most rows is read by several tasks."""
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 60000, 1, 8)
        customer = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id"))
        features = ids.select(customer.alias("Customer_ID"), F.lit(month(1)).alias("snapshot_date"), "id")
        people = ids.where(F.col("id") % 3 != 0).select(F.concat(F.lit("c"), "id").alias("Customer_ID"))
        people = people.union(spark.range(1).select(F.lit("hot")))
        loans = people.select(
            "Customer_ID", F.lit(month(7)).alias("snapshot_date"), F.lit(6).alias("mob"), F.lit(0).alias("dpd")
        )
        joined = S.multi_snapshot_join(features, loans)
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_attach_labels_keeps_both_dates(spark):
    features = panel(spark, [("c1", month(1), 1), ("c1", month(2), 2), ("c2", month(1), 3)])
    labels = spark.createDataFrame(
        [("c1", 1, month(7)), ("c1", 0, month(8)), ("c3", 1, month(7))], "Customer_ID string, label int, snapshot_date date"
    )
    pairs = S.attach_labels(features, labels)
    assert pairs.columns == ["Customer_ID", "snapshot_date_x", "x", "label", "snapshot_date_y"]
    assert pairs.count() == 4
    counted = S.attach_label_counts(features, labels)
    assert sorted((r.x, r.label, r.weight) for r in counted.collect()) == [(1, 0, 1), (1, 1, 1), (2, 0, 1), (2, 1, 1)]
    left = S.attach_features(labels.withColumn("snapshot_date", F.lit(month(1))), features)
    assert sorted((r.Customer_ID, r.label, r.x) for r in left.collect() if r.x) == [("c1", 0, 1), ("c1", 1, 1)]
    assert left.count() == 3


def test_date_helpers(spark):
    assert [r[0] for r in S.month_spine(spark, "2023-11-15", "2024-02-01").collect()] == [
        month(11), month(12), month(1, 2024), month(2, 2024)
    ]
    assert S.backfill_range(spark, "2024-05-31").count() == 13
    assert S.backfill_range(spark).count() == 13
    windows = S.split_windows(F.lit(month(9, 2024)))
    row = spark.range(1).select(*[c.alias(n) for n, c in windows.items()]).first()
    assert row.asDict() == {
        "train_test_start_date": month(7),
        "train_test_end_date": dt.date(2024, 6, 30),
        "oot_start_date": month(7, 2024),
        "oot_end_date": dt.date(2024, 8, 31),
    }


def test_slices_and_backfill(spark):
    features = panel(spark, [("c1", month(1), 1), ("c1", month(2), 2), ("c2", month(2), 3)])
    loans = panel(spark, [("c1", month(7), 0)])
    assert [tuple(r) for r in S.valid_slices(features, loans).collect()] == [(month(1), month(7))]
    months = S.month_spine(spark, "2023-02-01", "2023-03-01")
    assert S.backfill(features, months, lambda df: df.select("x")).count() == 2
    assert S.at_latest(features).count() == 2
    assert S.as_of(features, "2023-01-01").count() == 1
    assert S.between_dates(features, "2023-01-01", "2023-02-01").count() == 3


def test_hot_customer_is_salted(spark):
    """One customer has half the rows; without any skew handling at run time no task of the join gets over 5 %."""
    from creditloom.operators import skew

    left = spark.range(40_000).selectExpr("if(id % 2 = 0, 'hot', concat('c', id % 3000)) as k", "id as v")
    left = left.union(left.limit(1).selectExpr("cast(null as string) as k", "-1L as v"))
    right = spark.range(3000).selectExpr("concat('c', id) as k", "id as w").union(spark.sql("select 'hot' k, explode(array(1L, 2L)) w"))
    kept = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "64", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in kept}
    try:
        for k, v in kept.items():
            spark.conf.set(k, v)
        joined = skew.salted_join(left, right, ["k"])
        assert joined.columns == ["k", "v", "w"]
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
        total = sum(r["count"] for r in tasks)
        assert max(r["count"] for r in tasks) <= 0.05 * total
        plain = left.join(right, "k")
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
        for how in ("left", "left_semi"):
            one, other = skew.salted_join(left, right.where("w = 1"), ["k"], how), left.join(right.where("w = 1"), "k", how)
            assert one.exceptAll(other).isEmpty() and one.count() == other.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    with pytest.raises(ValueError):
        skew.salted_join(left, right, ["k"], "right")
