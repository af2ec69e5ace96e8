"""Gold: daily category sales and per-customer features."""

from datetime import date, datetime
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.functions.numeric import money_parts, money_total
from tillgrain.session import stage

CHURN_AFTER_DAYS = 60


def purchases(silver: DataFrame) -> DataFrame:
    """Silver added up once per (date, category, customer): all that both Gold tables are made of.

    A category or customer that holds most rows is spread over its partners here, before it comes
    together, and distinct customers and categories become counts of rows of this table.
    """
    cents, rest = money_parts(F.col("transaction_amount"))
    return (
        silver.withColumn("transaction_date", F.to_date("transaction_ts"))
        .groupBy("transaction_date", "product_category", "customer_id")
        .agg(
            F.count("transaction_id").alias("transactions"),
            F.count("transaction_amount").alias("amounts"),
            F.sum("quantity").alias("units"),
            cents.alias("cents"),
            rest.alias("rest"),
            F.min("transaction_ts").alias("first_ts"),
            F.max("transaction_ts").alias("last_ts"),
        )
    )


def merged(bought: DataFrame, *keys: str) -> DataFrame:
    """Purchases of the same keys made one row; rows of other pieces of Silver, or of finer keys."""
    cents = F.sum("cents").cast("decimal(38,2)")
    return bought.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("transactions", "amounts", "units")],
        cents.alias("cents"),
        F.sum("rest").alias("rest"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )


def _money() -> Column:
    return money_total(F.sum("cents"), F.sum("rest"))


def category_sales(silver: DataFrame) -> DataFrame:
    """Sales per (date, category)."""
    return sales_of(purchases(silver))


def sales_of(bought: DataFrame) -> DataFrame:
    return sales_by(bought, "transaction_date", "product_category")


def sales_by(bought: DataFrame, *keys: str) -> DataFrame:
    return bought.groupBy(*keys).agg(
        _money().alias("total_sales"),
        F.sum("units").alias("total_units"),
        F.count("customer_id").alias("distinct_customers"),
        F.sum("transactions").alias("transaction_count"),
    )


def sorted_sales(sales: DataFrame) -> DataFrame:
    """For reading: a stored table keeps no order."""
    return sales.orderBy("transaction_date", "product_category")


def customer_totals(bought: DataFrame) -> DataFrame:
    return totals_by(bought, "customer_id")


def totals_by(bought: DataFrame, *keys: str) -> DataFrame:
    return bought.groupBy(*keys).agg(
        F.sum("transactions").alias("total_transactions"),
        _money().alias("lifetime_value"),
        F.try_divide(_money(), F.sum("amounts")).alias("avg_transaction_value"),
        F.countDistinct("product_category").alias("distinct_categories_purchased"),
        F.max("last_ts").alias("last_purchase_ts"),
        F.min("first_ts").alias("first_purchase_ts"),
    )


def as_of(bought: DataFrame) -> Column:
    """The latest transaction time, as a subquery: it stays in the plan and reuses its exchange."""
    return bought.agg(F.max("last_ts")).scalar()


def one_row_per_customer(customers: DataFrame) -> DataFrame:
    """A repeated customer would repeat the feature row; the most complete record is kept.

    Of equally complete records the smallest is kept, NULL standing behind every value.
    """
    attributes = ("region", "age", "signup_date")
    missing = reduce(add, [F.col(a).isNull().cast("int") for a in attributes])
    order = [x for a in attributes for x in (F.col(a).isNull(), F.col(a))]
    return (
        customers.groupBy("customer_id")
        .agg(F.min_by(F.struct(*attributes), F.struct(missing, *order)).alias("record"))
        .select("customer_id", *[F.col(f"record.{a}").alias(a) for a in attributes])
    )


def customer_features(
    silver: DataFrame, customers: DataFrame, as_of_date: date | datetime | str | None = None
) -> DataFrame:
    """Features and churn label of every customer with a clean transaction."""
    return features_of(purchases(silver), customers, as_of_date)


def features_of(
    bought: DataFrame, customers: DataFrame, as_of_date: date | datetime | str | None = None
) -> DataFrame:
    """Features and churn label from what was bought.

    Days are calendar days. Without any transaction date the label is 0. Customers not in the
    dimension keep NULL attributes. Without a given day the totals are staged: the latest time is read
    from them, where a subquery over what was bought would compute all of it once more.
    """
    totals = customer_totals(bought)
    if as_of_date is not None:
        return features_from(totals, customers, F.lit(as_of_date))
    totals = stage(totals, "customer_totals")
    return features_from(totals, customers, totals.agg(F.max("last_purchase_ts")).scalar())


def features_from(totals: DataFrame, customers: DataFrame, today: Column) -> DataFrame:
    """Features and churn label from the totals of each customer, seen from a day."""
    return (
        totals.withColumn(
            "days_since_last_purchase",
            F.datediff(F.to_date(today), F.to_date("last_purchase_ts")),
        )
        .withColumn(
            "customer_tenure_days",
            F.datediff(F.to_date("last_purchase_ts"), F.to_date("first_purchase_ts")),
        )
        .join(one_row_per_customer(customers), "customer_id", "left")
        .withColumn(
            "churned",
            F.when(F.col("days_since_last_purchase") > CHURN_AFTER_DAYS, 1).otherwise(0),
        )
    )


def daily_customer_sketches(silver: DataFrame) -> DataFrame:
    """A mergeable sketch of each day's customers per category; daily counts cannot be added."""
    return (
        silver.withColumn("transaction_date", F.to_date("transaction_ts"))
        .groupBy("transaction_date", "product_category")
        .agg(F.hll_sketch_agg("customer_id").alias("customer_sketch"))
    )
