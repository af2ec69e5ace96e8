"""The retail feed derived from the TPC-H-like tables, and dirt for any feed."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.functions.numeric import hash_fraction


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_code(key: Column) -> Column:
    """CUST and at least six digits; lpad alone would cut longer keys."""
    digits = key.cast("string")
    return F.concat(F.lit("CUST"), F.lpad(digits, F.greatest(F.lit(6), F.length(digits)), "0"))


def transactions(spark: SparkSession, sf_dir: str, with_batch: bool = False) -> DataFrame:
    """Raw transactions: one per line item, about one in twenty broken in one of five ways.

    Ids repeat with differing content where line numbers repeat within an order. with_batch adds
    the month the row shipped in, the batch it would have arrived with.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    fault = F.pmod(
        F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_linenumber"), F.lit(100)
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.when(fault != 0, customer_code(F.col("o_custkey"))).alias("customer_id"),
        F.when(fault != 1, F.col("p_type")).alias("product_category"),
        F.when(fault == 2, "N/A")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        F.when(fault == 3, -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice"))
        .alias("transaction_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(fault == 4, "not-a-date")
        .otherwise(F.to_date("l_shipdate").cast("string"))
        .alias("transaction_ts"),
        *([F.date_format("l_shipdate", "yyyy-MM").alias("batch")] if with_batch else []),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            customer_code(F.col("c_custkey")).alias("customer_id"),
            F.date_add(F.lit("1992-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias(
                "signup_date"
            ),
            F.col("n_name").alias("region"),
            F.when(F.col("c_custkey") % 67 != 0, (18 + F.col("c_custkey") % 53).cast("double")).alias(
                "age"
            ),
        )
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions about every customer and every part, and all that users said in conversations."""
    code = customer_code(F.col("c_custkey"))
    customer_kind = F.col("c_custkey") % 4
    about_customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c-"), F.col("c_custkey")).alias("question_id"),
        F.when(customer_kind == 0, F.concat(F.lit("Why is customer "), code, F.lit(" high risk?")))
        .when(customer_kind == 1, F.concat(F.lit("Is "), F.lower(code), F.lit(" likely to churn?")))
        .when(customer_kind == 2, F.concat(F.lit("Show customer "), code))
        .otherwise(F.concat(F.lit("why did "), code, F.lit("1 leave")))
        .alias("question"),
    )
    part_kind = F.col("p_partkey") % 10
    kind = F.col("p_type")
    about_parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("p-"), F.col("p_partkey")).alias("question_id"),
        F.when(part_kind == 0, F.concat(F.lit("What is the total sales for "), kind, F.lit("?")))
        .when(part_kind == 1, F.concat(F.lit("How many distinct customers bought "), kind, F.lit("?")))
        .when(part_kind == 2, F.concat(F.lit("how much did we sell in "), F.col("p_name")))
        .when(
            part_kind == 3,
            F.concat(F.lit("What were the top "), F.col("p_size"), F.lit(" selling categories?")),
        )
        .when(part_kind == 4, F.lit("best categories"))
        .when(part_kind == 5, F.lit("What is the churn rate?"))
        .when(part_kind == 6, F.lit("What is the total revenue?"))
        .when(part_kind == 7, F.lit("total sales for   ?"))
        .when(part_kind == 8, F.concat(F.lit("Total sales of  "), F.substring(kind, 1, 3), F.lit("  ")))
        .otherwise(
            F.concat(F.lit("how many customers purchased "), F.lower(F.substring(kind, 2, 1)))
        )
        .alias("question"),
    )
    said = (
        table(spark, sf_dir, "conversations")
        .where("role = 'user'")
        .select(
            F.concat_ws("-", F.lit("t"), "conv_id", "turn").alias("question_id"),
            F.col("text").alias("question"),
        )
    )
    return about_customers.unionByName(about_parts).unionByName(said)


def with_dirt(df: DataFrame, fraction: float = 0.05) -> DataFrame:
    """Break about `fraction` of a feed's rows, each in one of five ways, by the row's id."""
    roll = hash_fraction("transaction_id") / fraction
    issue = F.floor(roll * 5)

    def broken(column: str, which: int, value: Column) -> Column:
        return F.when(issue == which, value).otherwise(F.col(column)).alias(column)

    faults = {
        "product_category": (0, F.lit(None).cast("string")),
        "transaction_amount": (1, -F.abs("transaction_amount")),
        "customer_id": (2, F.lit(None).cast("string")),
        "quantity": (4, F.lit("N/A")),
    }
    copies = F.when(issue == 3, 2).otherwise(1)
    return df.select(
        *[broken(c, *faults[c]) if c in faults else c for c in df.columns],
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")


def shuffled(df: DataFrame, *keys: str) -> DataFrame:
    """A random-looking row order that is the same on every run."""
    return df.orderBy(F.md5(F.concat_ws("|", *keys)), *keys)
