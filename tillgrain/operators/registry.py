"""The model_runs table: which version is in production, and whether it may be."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_MIN_AUC = 0.75


def promotion_history(runs: DataFrame) -> DataFrame:
    """Add promoted: a promotable run with no production AUC to beat, or strictly above it.

    Every promotion raises the production AUC, so that AUC is the highest one among the earlier
    promotable runs. The window holds the runs of one model: one row per training, not per customer.
    """
    earlier = (
        Window.partitionBy("model_name")
        .orderBy("version")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    production_auc = F.max(F.when(F.col("promotable"), F.col("roc_auc"))).over(earlier)
    return runs.withColumn("production_auc_before", production_auc).withColumn(
        "promoted",
        F.col("promotable")
        & (
            F.col("production_auc_before").isNull()
            | F.coalesce(F.col("roc_auc") > F.col("production_auc_before"), F.lit(False))
        ),
    )


def production_models(runs: DataFrame) -> DataFrame:
    """The latest promoted version of each model."""
    kept = [c for c in runs.columns if c != "model_name"]
    return (
        promotion_history(runs)
        .where("promoted")
        .groupBy("model_name")
        .agg(F.max_by(F.struct(*kept), "version").alias("run"))
        .select("model_name", "run.*")
    )


def model_gate(runs: DataFrame, min_auc: float = DEFAULT_MIN_AUC) -> DataFrame:
    """The evaluation report of each production model; without an AUC it fails."""
    return production_models(runs).select(
        "model_name",
        F.col("version").alias("model_version"),
        "roc_auc",
        F.lit(min_auc).alias("threshold"),
        F.coalesce(F.col("roc_auc") >= min_auc, F.lit(False)).alias("passed"),
    )


def next_version(runs: DataFrame, model_name: str) -> DataFrame:
    return runs.where(F.col("model_name") == model_name).agg(
        (F.coalesce(F.max("version"), F.lit(0)) + 1).alias("version")
    )
