import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillgrain import schemas
from tillgrain.functions.numeric import money_avg, money_sum
from tillgrain.operators import gold, reports
from tillgrain.sources import lake


def silver(spark, *rows):
    """rows: (transaction_id, customer_id, category, quantity, amount, timestamp)"""
    values = [
        (tid, cust, cat, qty, 1.0, amount, "upi", datetime.fromisoformat(ts), "now", "f.csv")
        for tid, cust, cat, qty, amount, ts in rows
    ]
    return lake.rows(spark, values, schemas.SILVER_TRANSACTIONS)


def people(spark, *rows):
    return lake.rows(spark, rows, schemas.CUSTOMERS)


SALES = (
    ("t1", "c1", "Books", 2, 10.10, "2026-01-01T09:00:00"),
    ("t2", "c1", "Books", 1, 5.05, "2026-01-01T23:59:59"),
    ("t3", "c2", "Books", 1, 1.00, "2026-01-01T10:00:00"),
    ("t4", "c2", "Toys", 3, None, "2026-01-02T00:00:00"),
)


def test_category_sales_per_day(spark):
    rows = gold.sorted_sales(gold.category_sales(silver(spark, *SALES))).collect()
    assert [tuple(r) for r in rows] == [
        (date(2026, 1, 1), "Books", 16.15, 4, 2, 3),
        (date(2026, 1, 2), "Toys", None, 3, 1, 1),
    ]
    names = gold.category_sales(silver(spark)).dtypes
    assert names == [(f.name, f.dataType.simpleString()) for f in schemas.CATEGORY_SALES]


def test_features_go_through_silver_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(key):
        read.add(1)
        return key

    rows = silver(spark, *SALES).withColumn("customer_id", counted("customer_id"))
    features = gold.customer_features(rows, people(spark, ("c1", date(2025, 1, 1), "N", 30.0)))
    assert {r.customer_id: r.days_since_last_purchase for r in features.collect()} == {"c1": 1, "c2": 0}
    assert read.value == len(SALES)


def test_customer_features(spark):
    features = gold.customer_features(
        silver(
            spark,
            ("t1", "c1", "Books", 1, 10.0, "2026-01-01T23:00:00"),
            ("t2", "c1", "Toys", 1, 20.0, "2026-01-03T01:00:00"),
            ("t3", "c2", "Toys", 1, 7.0, "2026-03-04T00:30:00"),
            ("t4", "c9", "Toys", 1, 7.0, "2026-03-05T00:00:00"),
        ),
        people(
            spark,
            ("c1", date(2025, 1, 1), "North", 30.0),
            ("c2", date(2025, 1, 2), "South", None),
            ("c3", date(2025, 1, 3), "South", 44.0),
        ),
    )
    assert features.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.CUSTOMER_FEATURES
    ]
    rows = {r["customer_id"]: r for r in features.collect()}
    assert set(rows) == {"c1", "c2", "c9"}  # c3 bought nothing
    first = rows["c1"]
    assert (first["total_transactions"], first["lifetime_value"]) == (2, 30.0)
    assert first["avg_transaction_value"] == 15.0
    assert first["distinct_categories_purchased"] == 2
    # calendar days, not spans of 24 hours
    assert first["customer_tenure_days"] == 2
    assert first["days_since_last_purchase"] == 61
    assert (first["churned"], rows["c2"]["churned"]) == (1, 0)
    assert (rows["c9"]["region"], rows["c9"]["age"]) == (None, None)


@pytest.mark.parametrize(("as_of", "churned"), [("2026-03-02", 0), ("2026-03-03", 1)])
def test_churn_is_strictly_more_than_sixty_days(spark, as_of, churned):
    rows = silver(spark, ("t1", "c1", "Books", 1, 10.0, "2026-01-01T23:00:00"))
    features = gold.customer_features(rows, people(spark), as_of_date=as_of)
    assert features.first()["churned"] == churned


def test_repeated_customer_does_not_repeat_features(spark):
    rows = silver(spark, *SALES)
    twice = people(
        spark, ("c1", date(2025, 1, 1), "North", 30.0), ("c1", date(2025, 1, 1), "East", 31.0)
    )
    features = gold.customer_features(rows, twice)
    assert features.count() == 2
    assert features.where("customer_id = 'c1'").first()["region"] == "East"


def test_empty_silver(spark):
    empty = silver(spark)
    assert gold.category_sales(empty).count() == 0
    assert gold.customer_features(empty, people(spark)).count() == 0


def test_tables_add_up(spark):
    rows = silver(spark, *SALES)
    sales = gold.category_sales(rows)
    assert sales.agg(F.sum("transaction_count")).first()[0] == rows.count()
    features = gold.customer_features(rows, people(spark))
    assert features.agg(F.sum("total_transactions")).first()[0] == rows.count()
    assert reports.total_revenue(sales).first()[0] == 16.15


def amounts(spark, *values):
    return lake.rows(spark, [(v,) for v in values], "x double")


def test_money_sum_is_exact_in_any_layout(spark):
    values = amounts(spark, *[0.1] * 1000, 1e15, -1e15)
    for parts in (1, 3, 17):
        assert values.repartition(parts).agg(money_sum(F.col("x"))).first()[0] == 100.0


def test_money_sum_loses_nothing(spark):
    total = lambda *v: amounts(spark, *v).agg(money_sum(F.col("x"))).first()[0]
    assert total(0.001, 0.001) == pytest.approx(0.002)
    assert total(1e20, 1.5) == 1e20 + 1.5
    assert total(None, 2.0) == 2.0
    assert total(None) is None
    assert total() is None
    assert math.isnan(total(float("nan"), 1.0))
    assert total(float("inf"), 1.0) == math.inf


def test_money_avg_skips_nulls(spark):
    assert amounts(spark, 1.0, None, 2.0).agg(money_avg(F.col("x"))).first()[0] == 1.5


def test_sketches_estimate_customers_over_days(spark):
    rows = silver(
        spark,
        *[
            (f"t{d}-{c}", f"c{c}", "Books", 1, 1.0, f"2026-01-{d:02d}T00:00:00")
            for d in range(1, 5)
            for c in range(d, d + 200)
        ],
    )
    estimate = reports.category_reach(gold.daily_customer_sketches(rows)).first()
    assert abs(estimate["customers_estimate"] - 203) <= 10
    added_up = reports.category_customer_count(gold.category_sales(rows), "BOOK").first()
    assert added_up["approx_distinct_customers"] == 800


def gold_fixture(spark):
    """Two categories that share a piece of their name, and five customers."""
    sales = lake.rows(
        spark,
        [
            (date(2025, 11, 3), "Garden", 820.5, 7, 5, 6),
            (date(2025, 11, 4), "Garden", 79.5, 2, 2, 2),
            (date(2025, 11, 3), "Garage Tools", 310.25, 11, 4, 6),
        ],
        schemas.CATEGORY_SALES,
    )
    features = lake.rows(
        spark,
        [(f"CUST{i:06d}", int(i in (2, 5))) for i in range(1, 6)],
        "customer_id string, churned int",
    )
    return sales, features


def test_reports(spark):
    sales, features = gold_fixture(spark)
    assert tuple(reports.churn_summary(features).first()) == (5, 2, 40.0)
    assert [tuple(r) for r in reports.top_categories(sales, 1).collect()] == [("Garden", 900.0, 9)]
    assert reports.top_categories(sales, 0).count() == 0
    assert tuple(reports.category_total(sales, "rden").first()) == ("Garden", 900.0, 9)
    assert reports.category_total(sales, "zzz").count() == 0


def test_the_most_complete_customer_record_is_kept(spark):
    rows = [
        ("C1", date(2020, 1, 1), "North", 30.0),
        ("C1", None, None, None),
        ("C2", None, "South", None),
        ("C2", date(2021, 1, 1), None, None),
    ]
    kept = gold.one_row_per_customer(
        lake.rows(spark, rows, "customer_id string, signup_date date, region string, age double")
    )
    assert {r["customer_id"]: (r["region"], r["age"]) for r in kept.collect()} == {
        "C1": ("North", 30.0),
        "C2": ("South", None),
    }
