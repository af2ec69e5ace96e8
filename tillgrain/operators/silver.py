"""Silver: one row per transaction, parsed, with every rejected row kept in a quarantine."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.functions.numeric import share
from tillgrain.functions.parsing import parse_quantity, parse_timestamp
from tillgrain.functions.rules import failure_reasons, is_rejected

_SURVIVOR_ORDER = (
    "transaction_ts",
    "customer_id",
    "product_category",
    "quantity",
    "transaction_amount",
    "unit_price",
    "payment_method",
    "_ingested_at",
    "_source_file",
)


def dedup_transactions(bronze: DataFrame) -> DataFrame:
    """Keep one row per transaction_id, the same one on every run.

    The order covers all columns, so ties are equal rows. row_number() = 1 is planned with a group
    limit ahead of the exchange: each task sends at most one row per id, however often an id (NULL
    included) is repeated.
    """
    order = [F.col(c).asc_nulls_last() for c in _SURVIVOR_ORDER if c in bronze.columns]
    first = Window.partitionBy("transaction_id").orderBy(*order)
    return bronze.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")


def tag_failures(deduped: DataFrame) -> DataFrame:
    return deduped.withColumn("_dq_failures", failure_reasons())


def clean_rows(tagged: DataFrame) -> DataFrame:
    return _clean_columns(tagged.where(F.size("_dq_failures") == 0))


def _clean_columns(accepted: DataFrame) -> DataFrame:
    return accepted.select(
        "transaction_id",
        "customer_id",
        "product_category",
        parse_quantity(F.col("quantity")).alias("quantity"),
        "unit_price",
        "transaction_amount",
        "payment_method",
        parse_timestamp(F.col("transaction_ts")).alias("transaction_ts"),
        *_lineage(accepted, "_ingested_at", "_source_file"),
    )


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size("_dq_failures") > 0).select(
        "transaction_id",
        "customer_id",
        "product_category",
        "quantity",
        "transaction_amount",
        "_dq_failures",
        *_lineage(tagged, "_ingested_at"),
    )


def clean_transactions(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined). To write both, stage the tagged rows once; see plans.flow.

    The split is a plain condition; reasons are listed for rejected rows only.
    """
    deduped = dedup_transactions(bronze)
    rejected = deduped.where(is_rejected())
    return _clean_columns(deduped.where(~is_rejected())), quarantined_rows(tag_failures(rejected))


def flow_summary(bronze: DataFrame) -> DataFrame:
    """How many rows came in, were kept and were quarantined; shares are of the rows that came in."""
    counts = dedup_transactions(bronze).agg(
        F.count_if(~is_rejected()).alias("clean_rows"),
        F.count_if(is_rejected()).alias("quarantined_rows"),
    ).withColumn("input_rows", bronze.agg(F.count(F.lit(1))).scalar())
    return counts.select(
        "input_rows",
        "clean_rows",
        "quarantined_rows",
        share(F.col("clean_rows"), F.col("input_rows")).alias("clean_share"),
        share(F.col("quarantined_rows"), F.col("input_rows")).alias("quarantined_share"),
    )


def quarantine_reasons(quarantined: DataFrame) -> DataFrame:
    return (
        quarantined.select(F.explode("_dq_failures").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _lineage(df: DataFrame, *names: str) -> list[str]:
    return [name for name in names if name in df.columns]
