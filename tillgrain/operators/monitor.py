"""Run records, and the health numbers derived from the run log and the query log."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain import schemas
from tillgrain.operators.quality import DEFAULT_THRESHOLD


def run_records(runs: DataFrame, quality: DataFrame, model: DataFrame) -> DataFrame:
    """Merge the reports of each run. Either report may be missing: its columns are NULL then.

    runs: run_id, timestamp, pipeline_duration_seconds, failed_step. quality and model: run_id with
    the columns of the quality report and of the model gate.
    """
    return (
        runs.join(
            quality.select(
                "run_id",
                F.col("overall_score").alias("dq_overall_score"),
                F.col("total_rows").alias("dq_total_rows"),
                F.col("fully_passing_rows").alias("dq_fully_passing_rows"),
            ),
            "run_id",
            "left",
        )
        .join(
            model.select(
                "run_id",
                F.col("roc_auc").alias("model_roc_auc"),
                "model_version",
                F.col("passed").alias("model_gate_passed"),
            ),
            "run_id",
            "left",
        )
        .withColumn("pipeline_duration_seconds", F.round("pipeline_duration_seconds", 2))
        .select(*schemas.METRICS_HISTORY.names)
    )


def run_kpis(history: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    def latest(column: str) -> Column:
        return F.max_by(column, "timestamp")

    return history.agg(
        F.count(F.lit(1)).alias("total_runs"),
        latest("dq_overall_score").alias("latest_dq_score"),
        latest("model_roc_auc").alias("latest_model_roc_auc"),
        F.count_if(F.col("dq_overall_score") < threshold).alias("dq_failures"),
        F.count_if(~F.col("model_gate_passed")).alias("model_failures"),
    )


def newest_first(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("timestamp"))


def intent_distribution(log: DataFrame) -> DataFrame:
    counts = log.groupBy("matched_intent").agg(F.count(F.lit(1)).alias("queries"))
    return counts.orderBy(F.desc("queries"), "matched_intent")


def unmatched_rate(log: DataFrame) -> DataFrame:
    unmatched = F.when(F.col("matched_intent") == "unmatched", 1.0).otherwise(0.0)
    return log.agg(
        F.count(F.lit(1)).alias("total_queries"), F.avg(unmatched).alias("unmatched_rate")
    )
