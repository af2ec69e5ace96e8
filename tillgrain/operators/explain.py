"""Why a customer is at risk: two explanations, each for all customers at once.

A customer's factors are an array inside the row, sorted and cut there, so explaining needs neither
an exchange nor a window. Importances come as one row per feature of FEATURES.
"""

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.operators.features import FEATURES, LABEL

# How answers name the features.
FEATURE_LABELS = {
    "customer_tenure_days": "how long they've been a customer",
    "lifetime_value": "their total lifetime spend",
    "total_transactions": "how many purchases they've made",
    "distinct_categories_purchased": "how many different categories they buy from",
    "avg_transaction_value": "their average order size",
    "age": "their age",
    "region_encoded": "their region",
}
HIGH_RISK = 0.6
MODERATE_RISK = 0.3
NOT_ZERO = 1e-9


def feature_stats(encoded: DataFrame) -> DataFrame:
    """Mean and sample deviation, one row per feature, from one pass."""
    return _per_feature(
        encoded, lambda f: {"mean": F.avg(f), "std": F.stddev_samp(F.col(f).cast("double"))}
    )


def reference_profiles(encoded: DataFrame) -> DataFrame:
    """The average churned and the average retained customer, one row per feature."""
    return _per_feature(
        encoded,
        lambda f: {
            "churned_avg": F.avg(F.when(F.col(LABEL) == 1, F.col(f))),
            "retained_avg": F.avg(F.when(F.col(LABEL) == 0, F.col(f))),
        },
    )


def zscore_factors(
    encoded: DataFrame, importances: Mapping[str, float], top: int = 4
) -> DataFrame:
    """Importance times the feature's z-score, largest first.

    Its direction misleads for tree models; profile_factors is the default.
    """
    def weight(f: str) -> Column:
        deviation = F.col(f) - F.col(f"_of.{f}.mean")
        return F.lit(importances[f]) * deviation / (F.col(f"_of.{f}.std") + NOT_ZERO)

    stats = _as_struct(feature_stats(encoded), "mean", "std")
    return _with_factors(encoded, stats, weight, top, "increases", "decreases")


def profile_factors(
    encoded: DataFrame, importances: Mapping[str, float], top: int = 3
) -> DataFrame:
    """Importance times how much nearer the value is to the churned than to the retained average."""

    def weight(f: str) -> Column:
        churned, retained = F.col(f"_of.{f}.churned_avg"), F.col(f"_of.{f}.retained_avg")
        nearer = F.abs(F.col(f) - retained) - F.abs(F.col(f) - churned)
        return F.lit(importances[f]) * nearer / (F.abs(churned - retained) + NOT_ZERO)

    profiles = _as_struct(reference_profiles(encoded), "churned_avg", "retained_avg")
    # How answers state the direction.
    positive, negative = "typical of customers who churn", "typical of customers who stay"
    return _with_factors(encoded, profiles, weight, top, positive, negative)


def factor_rows(explained: DataFrame) -> DataFrame:
    """One row per customer and factor, ranked from 1."""
    return explained.select(
        "customer_id", F.posexplode("factors").alias("position", "factor")
    ).select(
        "customer_id",
        (F.col("position") + 1).alias("factor_rank"),
        F.col("factor.feature").alias("feature"),
        F.col("factor.value").alias("value"),
        F.col("factor.weight").alias("weight"),
        F.col("factor.direction").alias("direction"),
    )


def risk_band(score: Column) -> Column:
    return (
        F.when(score >= HIGH_RISK, "high").when(score >= MODERATE_RISK, "moderate").otherwise("low")
    )


def risk_answers(
    encoded: DataFrame, importances: Mapping[str, float], score: str = "churn_risk_score"
) -> DataFrame:
    """A sentence per customer on score, band and the three main factors, with the numbers behind it.

    Where encoded has the version of the model that gave the score, the answer carries it.
    """
    labels = F.create_map(*[F.lit(x) for pair in FEATURE_LABELS.items() for x in pair])
    explained = profile_factors(encoded, importances)
    phrases = F.transform(
        "factors",
        lambda f: F.concat(labels[f["feature"]], F.lit(" ("), f["direction"], F.lit(")")),
    )
    # Fixed value: the answer's wording. The percentage is rounded half to even.
    sentence = F.format_string(
        "Customer %s has a %d%% churn risk score, which is %s. The biggest factors are: %s.",
        F.col("customer_id"),
        F.rint(F.col(score) * 100).cast("int"),
        risk_band(F.col(score)),
        F.concat_ws(", ", phrases),
    )
    known = "model_version" in encoded.columns
    version = F.col("model_version") if known else F.lit(None)
    return explained.select(
        "customer_id",
        F.col(score),
        risk_band(F.col(score)).alias("risk_band"),
        sentence.alias("answer"),
        F.to_json(F.struct(F.round(score, 4).alias("churn_risk_score"), *FEATURES)).alias("evidence"),
        version.cast("int").alias("model_version"),
    )


def evidence(encoded: DataFrame, score: str = "churn_risk_score") -> DataFrame:
    return encoded.select("customer_id", F.round(score, 4).alias("churn_risk_score"), *FEATURES)


def _per_feature(encoded: DataFrame, measures: Callable[[str], dict[str, Column]]) -> DataFrame:
    entries = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"), *[m.alias(name) for name, m in measures(f).items()]
            )
            for f in FEATURES
        ]
    )
    return encoded.agg(entries.alias("entries")).select(F.inline("entries"))


def _as_struct(per_feature: DataFrame, *measures: str) -> Column:
    """The seven rows as one subquery value: a field per feature holding its measures."""
    fields = [
        F.max(F.when(F.col("feature") == f, F.struct(*measures))).alias(f) for f in FEATURES
    ]
    return per_feature.agg(F.struct(*fields)).scalar()


def _with_factors(
    encoded: DataFrame,
    measures: Column,
    weight: Callable[[str], Column],
    top: int,
    positive: str,
    negative: str,
) -> DataFrame:
    # The subquery is put into one column: every other mention of it would be planned anew.
    weighed = encoded.withColumn("_of", measures).withColumns(
        {f"_weight_{f}": weight(f) for f in FEATURES}
    )
    factors = F.array(
        *[
            F.struct(
                # Sorting fields: largest weight first, equal weights in feature order.
                (-F.abs(f"_weight_{f}")).alias("order"),
                F.lit(position).alias("position"),
                F.lit(f).alias("feature"),
                F.col(f).cast("double").alias("value"),
                F.col(f"_weight_{f}").alias("weight"),
                F.when(F.col(f"_weight_{f}") > 0, positive).otherwise(negative).alias("direction"),
            )
            for position, f in enumerate(FEATURES)
        ]
    )
    return weighed.withColumn("factors", F.slice(F.sort_array(factors), 1, top)).drop(
        "_of", *[f"_weight_{f}" for f in FEATURES]
    )
