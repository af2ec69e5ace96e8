"""Model input: filled and encoded features, class weights, the train/test split."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.operators.ranking import numbered, running_totals
from tillgrain.operators.selection import medians

LABEL = "churned"
LEAKY_COLUMN = "days_since_last_purchase"  # the label is defined on it
FEATURES = (
    "total_transactions",
    "lifetime_value",
    "avg_transaction_value",
    "distinct_categories_purchased",
    "customer_tenure_days",
    "age",
    "region_encoded",
)
NO_REGION = "UNKNOWN"


def check_features(columns=FEATURES) -> None:
    if LEAKY_COLUMN in columns:
        raise ValueError(f"{LEAKY_COLUMN} defines the label and must not be a feature")


def region_codes(features: DataFrame) -> DataFrame:
    """The dictionary of regions: region, region_encoded, numbered from 0 in sorted order.

    A table of any length: it is numbered range by range and joined, never held as a whole.
    """
    regions = features.select(F.coalesce("region", F.lit(NO_REGION)).alias("region")).distinct()
    codes = numbered(regions, ["region"], "_place")
    return codes.select("region", (F.col("_place") - 1).cast("int").alias("region_encoded"))


def with_codes(features: DataFrame, codes: DataFrame, unseen: int | None = None) -> DataFrame:
    """features, its regions filled, with the code of each from a dictionary; regions that are not in it
    have the code `unseen`."""
    filled = features.withColumn("region", F.coalesce("region", F.lit(NO_REGION)))
    coded = filled.join(codes, "region", "left")
    code = F.col("region_encoded") if unseen is None else F.coalesce("region_encoded", F.lit(unseen))
    return coded.select(*features.columns, code.alias("region_encoded"))


def median_age(features: DataFrame) -> float | None:
    found = medians(features, "age").first()
    return None if found is None else found["median"]


def encode_features(features: DataFrame) -> DataFrame:
    """Fill age with its exact median and region with a constant, and add the region code."""
    filled = features.withColumn("age", F.coalesce("age", F.lit(median_age(features)).cast("double")))
    return with_codes(filled, region_codes(features))


def label_stats(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(LABEL), 4).alias("churn_rate")
    )


def class_weights(features: DataFrame) -> DataFrame:
    """Balanced weights n / (classes * n_class), one row per class present."""
    per_class = features.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n_rows"))
    both = Window.partitionBy()  # over one row per class
    return per_class.withColumn(
        "weight",
        F.sum("n_rows").over(both) / (F.count(F.lit(1)).over(both) * F.col("n_rows")),
    )


def with_class_weights(features: DataFrame) -> DataFrame:
    """Every row with its class weight; the two weights come from one subquery, not a join."""
    positive = F.count_if(F.col(LABEL) == 1)
    negative = F.count_if(F.col(LABEL) == 0)
    classes = F.when(positive > 0, 1).otherwise(0) + F.when(negative > 0, 1).otherwise(0)
    weights = features.agg(
        F.struct(
            F.try_divide(positive + negative, classes * positive).alias("positive"),
            F.try_divide(positive + negative, classes * negative).alias("negative"),
        )
    ).scalar()
    own = F.when(F.col(LABEL) == 1, F.col("_weights.positive")).otherwise(
        F.col("_weights.negative")
    )
    return features.withColumn("_weights", weights).withColumn("weight", own).drop("_weights")


def stratified_split(
    features: DataFrame, test_share: float = 0.2, key: str = "customer_id"
) -> DataFrame:
    """Add is_test: in each class the ceil(test_share * n) rows whose key hashes lowest.

    Exact, and the same under any layout. The class is cut into 4096 buckets by the start of the
    hash, so no task sorts a whole class.
    """
    hashed = features.withColumns(
        {
            "_hash": F.md5(F.coalesce(F.col(key), F.lit(""))),
            "_bucket": F.substring(F.md5(F.coalesce(F.col(key), F.lit(""))), 1, 3),
            "_one": F.lit(1).cast("bigint"),
        }
    )
    sizes = features.groupBy(LABEL).agg(
        F.ceil(F.count(F.lit(1)) * F.lit(test_share)).alias("_test_rows")
    )
    # At most one row per class; rows without a key or a label are rows of their class as well.
    ranked = running_totals(hashed, ["_one"], ["_hash", key], "_bucket", [LABEL])
    sizes = sizes.withColumnRenamed(LABEL, "_label")
    same_class = ranked[LABEL].eqNullSafe(sizes["_label"])
    return ranked.join(F.broadcast(sizes), same_class).select(
        *features.columns, (F.col("running__one") <= F.col("_test_rows")).alias("is_test")
    )
