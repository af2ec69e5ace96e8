"""Metrics of a scored, labelled table. Labels are 0 or 1."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.operators.ranking import running_totals, with_range_bucket


def roc_auc(
    scored: DataFrame, score: str = "score", label: str = "churned", by: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve per group of `by`: the chance that a positive outranks a negative.

    Ties count half. NULL where a group lacks one of the labels. Rows are first added up per
    distinct score; the global order of scores is then walked bucket by bucket. Counts are kept
    whole until the last division, so the result is exact.
    """
    points = (
        scored.where(F.col(score).isNotNull())
        .groupBy(*by, score)
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    walked = running_totals(with_range_bucket(points, [*by, score]), ["neg"], [score], "_bucket", by)
    # Doubled, to keep the half ties whole.
    wins = (2 * F.col("running_neg") - F.col("neg")).cast("decimal(19,0)")
    return (
        walked.groupBy(*by)
        .agg(
            F.sum((F.col("pos").cast("decimal(19,0)") * wins).cast("decimal(28,0)")).alias("wins"),
            F.sum("pos").alias("p"),
            F.sum("neg").alias("n"),
        )
        .select(
            *by,
            F.try_divide(
                F.col("wins").cast("double"), 2.0 * F.col("p").cast("double") * F.col("n")
            ).alias("roc_auc"),
        )
    )


def classification_metrics(
    scored: DataFrame, score: str = "score", label: str = "churned", threshold: float = 0.5
) -> DataFrame:
    """Precision, recall, F1 and accuracy; a ratio without a denominator is 0.

    Rows without a score or a label stand in no count but in unscored_rows, so that an incomplete
    scoring shows.
    """
    predicted, actual = F.col(score) > threshold, F.col(label) == 1
    counts = scored.agg(
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
        F.count_if(~predicted & ~actual).alias("tn"),
        F.count_if(F.col(score).isNull() | F.col(label).isNull()).alias("unscored_rows"),
    )

    def ratio(part: str, whole: str):
        return F.coalesce(F.try_divide(F.expr(part), F.expr(whole)), F.lit(0.0))

    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        ratio("tp", "tp + fp").alias("precision"),
        ratio("tp", "tp + fn").alias("recall"),
        ratio("2 * tp", "2 * tp + fp + fn").alias("f1"),
        ratio("tp + tn", "tp + fp + fn + tn").alias("accuracy"),
        "unscored_rows",
    )


def majority_scores(df: DataFrame, label: str = "churned", score: str = "score") -> DataFrame:
    """The broken-model baseline: everyone gets the majority label as score. A tie gives 0."""
    majority = df.agg(F.when(F.avg(label) > 0.5, 1.0).otherwise(0.0)).scalar()
    return df.withColumn(score, majority)


def leakage_check(
    df: DataFrame, columns: Sequence[str], label: str = "churned", limit: float = 0.999
) -> DataFrame:
    """AUC of each column taken alone, in the better direction; near 1.0 it gives the label away."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("score"))
            for c in columns
        ]
    )
    alone = roc_auc(df.select(label, F.inline(entries)), "score", label, by=["feature"])
    return alone.select(
        "feature",
        F.greatest("roc_auc", 1 - F.col("roc_auc")).alias("single_feature_auc"),
    ).withColumn("leaks", F.col("single_feature_auc") >= limit)
