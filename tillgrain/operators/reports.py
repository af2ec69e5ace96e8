"""The five fixed reports over Gold."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.functions.numeric import money_sum
from tillgrain.functions.text import contains_ignoring_case


def churn_summary(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("churned").alias("churned_customers"),
        F.round(F.avg("churned") * 100, 1).alias("churn_rate_pct"),
    )


def total_revenue(sales: DataFrame) -> DataFrame:
    return sales.agg(money_sum(F.col("total_sales")).alias("total_revenue"))


def category_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_category").agg(
        money_sum(F.col("total_sales")).alias("total_sales"),
        F.sum("total_units").alias("total_units"),
    )


def category_customers(sales: DataFrame) -> DataFrame:
    """Daily distinct customers added up: a customer counts once per day of purchase."""
    return sales.groupBy("product_category").agg(
        F.sum("distinct_customers").alias("approx_distinct_customers")
    )


def top_categories(sales: DataFrame, n: int = 5) -> DataFrame:
    return category_totals(sales).orderBy(F.desc("total_sales"), "product_category").limit(n)


def matching(report: DataFrame, category: str) -> DataFrame:
    """The rows of a category report whose category contains the text, in any case."""
    return report.where(contains_ignoring_case(F.col("product_category"), F.lit(category)))


def category_total(sales: DataFrame, category: str) -> DataFrame:
    return category_totals(matching(sales, category))


def category_customer_count(sales: DataFrame, category: str) -> DataFrame:
    return category_customers(matching(sales, category))


def category_reach(sketches: DataFrame) -> DataFrame:
    """Customers of each category over all days, estimated from the merged daily sketches."""
    return sketches.groupBy("product_category").agg(
        F.hll_sketch_estimate(F.hll_union_agg("customer_sketch")).alias("customers_estimate")
    )
