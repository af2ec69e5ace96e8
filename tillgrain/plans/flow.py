"""The gated batch flow: Bronze, quality gate, Silver, Gold, training, model gate, run record."""

import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain import schemas
from tillgrain.operators import (
    bronze,
    evaluation,
    explain,
    features,
    forest,
    gold,
    monitor,
    quality,
    questions,
    registry,
    silver,
)
from tillgrain.plans import steps
from tillgrain.session import stage, staging
from tillgrain.sources import lake, logs
from tillgrain.sources.files import Ledger

MODEL_NAME = "churn-model"


@dataclass(frozen=True)
class Lake:
    """Where the tables of one lake live."""

    root: str
    fmt: str = "parquet"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/transactions"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/transactions"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/silver/_quarantine/transactions"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def purchases(self) -> str:
        return f"{self.gold}/purchases"

    @property
    def customer_purchases(self) -> str:
        return f"{self.gold}/customer_purchases"

    @property
    def customer_totals(self) -> str:
        return f"{self.gold}/customer_totals"

    @property
    def scores(self) -> str:
        return f"{self.gold}/customer_scores"

    @property
    def model_runs(self) -> str:
        return f"{self.root}/models/runs"

    @property
    def models(self) -> str:
        return f"{self.root}/models/stored"

    @property
    def steps(self) -> str:
        return f"{self.root}/steps"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    @property
    def history(self) -> str:
        return f"{self.root}/monitoring/metrics_history"


class GateFailed(RuntimeError):
    """A gate stopped the flow; the run is on record."""


def run(
    spark: SparkSession,
    raw_transactions: str,
    customers: str,
    lake_tables: Lake,
    dq_threshold: float = quality.DEFAULT_THRESHOLD,
    min_auc: float = registry.DEFAULT_MIN_AUC,
    skip_seen_files: bool = False,
    keep_history: bool = True,
) -> None:
    """Run every step; whatever ends the run, a gate or an error, it is put on record first.

    A run on the same files as the last one, which did not get to its end, goes on at the first step
    that is not done, or whose input has changed since.
    """
    with staging(spark):
        _run(
            spark,
            raw_transactions,
            customers,
            lake_tables,
            dq_threshold,
            min_auc,
            skip_seen_files,
            keep_history,
        )


def _run(
    spark: SparkSession,
    raw_transactions: str,
    customers: str,
    lake_tables: Lake,
    dq_threshold: float,
    min_auc: float,
    skip_seen_files: bool,
    keep_history: bool,
) -> None:
    started, step = time.time(), "bronze"
    quality_verdict = model_verdict = None
    raw = steps.files_below(spark, raw_transactions)
    done = steps.Steps(spark, lake_tables.steps, steps.fingerprint(raw, skip_seen_files))

    def once(name: str, reads: list, do: Callable[[], Any]) -> None:
        read = steps.fingerprint(*reads)
        if done.made(name, read) is None:
            made = do()
            done.note(name, read, made if isinstance(made, (dict, list, str, int)) else True)

    try:
        # Should the first try have ended between batch and entry, the batch takes its own place.
        batch_id = f"run-{done.number}-{steps.fingerprint(raw)[:16]}"
        ingested = (spark, raw_transactions, lake_tables.bronze, lake_tables.fmt, skip_seen_files)
        once("bronze", raw, lambda: bronze.ingest(*ingested, batch_id=batch_id))
        step = "quality_gate"
        quality_verdict = check_quality(spark, lake_tables, dq_threshold)
        _require(quality_verdict, "data quality score is below the threshold")
        step = "silver"
        bronze_now = steps.version_of(spark, lake_tables.bronze)
        once("silver", bronze_now, lambda: write_silver(spark, lake_tables))
        step = "gold"
        gold_reads = [steps.version_of(spark, lake_tables.silver), steps.files_below(spark, customers)]
        once("gold", gold_reads, lambda: write_gold(spark, customers, lake_tables))
        step = "training"
        features_now = steps.version_of(spark, f"{lake_tables.gold}/customer_features")
        once("training", features_now, lambda: train(spark, lake_tables))
        step = "model_gate"
        model_verdict = check_model(spark, lake_tables, min_auc)
        _require(model_verdict, "no production model reaches the minimum ROC-AUC")
        step = None
        done.complete()
    finally:
        if keep_history:
            record_run(
                spark, lake_tables, quality_verdict, model_verdict, time.time() - started, step
            )


def check_quality(spark: SparkSession, tables: Lake, threshold: float) -> DataFrame:
    """Score Bronze, store the report and return the stored one-row verdict."""
    report = quality.quality_report(lake.read_table(spark, tables.bronze, tables.fmt))
    return _store_report(quality.quality_gate(report, threshold), f"{tables.reports}/quality")


def write_silver(spark: SparkSession, tables: Lake) -> dict[str, int]:
    """Write the clean table and the quarantine; returns the row counts.

    The deduplicated, tagged rows are staged once, split by outcome, so the exchange runs once and
    either table is then written from its own partition.
    """
    source = lake.read_table(spark, tables.bronze, tables.fmt)
    tagged = silver.tag_failures(silver.dedup_transactions(source))
    staged = stage(
        tagged.withColumn("_rejected", F.size("_dq_failures") > 0), "tagged", "_rejected"
    )
    clean = silver.clean_rows(staged.where(~F.col("_rejected")))
    quarantined = silver.quarantined_rows(staged.where(F.col("_rejected")))
    # All of Bronze is in these rows, so they may replace what a stream has written so far.
    lake.overwrite_table(clean, tables.silver, tables.fmt)
    lake.overwrite_table(quarantined, tables.quarantine, tables.fmt)
    # Reads row counts only: the outcome is in the path.
    counts = {row["_rejected"]: row["count"] for row in staged.groupBy("_rejected").count().collect()}
    return {"clean_rows": counts.get(False, 0), "quarantined_rows": counts.get(True, 0)}


def write_gold(spark: SparkSession, customers: str, tables: Lake) -> None:
    """Both Gold tables from one pass over Silver."""
    clean = lake.read_table(spark, tables.silver, tables.fmt)
    bought = stage(gold.purchases(clean), "purchases")
    dimension = lake.read_customers(spark, customers)
    lake.overwrite_table(gold.sales_of(bought), f"{tables.gold}/category_sales", tables.fmt)
    lake.overwrite_table(
        gold.features_of(bought, dimension), f"{tables.gold}/customer_features", tables.fmt
    )


def claim_version(spark: SparkSession, tables: Lake, model_name: str) -> int:
    """A version number that no other training gets, however many run at once.

    Promotion is decided in the order of the numbers. A training that does not end leaves a number
    that no run has.
    """
    logged = registry.next_version(model_runs(spark, tables), model_name).first()["version"]
    claims = Ledger(spark, f"{tables.models}/{model_name}/_versions")
    return claims.claim({"claimed_at": bronze.utc_now()}, at_least=logged)


def train(spark: SparkSession, tables: Lake, model_name: str = MODEL_NAME) -> forest.ChurnModel:
    """Fit on four fifths of the customers, measure on the rest, store the model, log the run."""
    customers = lake.read_table(spark, f"{tables.gold}/customer_features", tables.fmt)
    split = stage(features.stratified_split(customers), "split", "is_test")
    version = claim_version(spark, tables, model_name)
    path = f"{tables.models}/{model_name}/{version}"
    forest.fit_churn_model(split.where(~F.col("is_test"))).save(path)
    # What is measured is the stored model, the one that will be served.
    model = forest.ChurnModel.load(spark, path)
    scored = stage(forest.score_customers(model, split.where("is_test")), "scored")
    log_model_run(customers, scored, tables, model_name, version, path, model)
    return model


def register_baseline(spark: SparkSession, tables: Lake, model_name: str = MODEL_NAME) -> None:
    """Log the majority-class model as a run that can never be promoted."""
    customers = lake.read_table(spark, f"{tables.gold}/customer_features", tables.fmt)
    test = features.stratified_split(customers).where("is_test")
    scored = stage(evaluation.majority_scores(test, score="churn_risk_score"), "scored")
    version = claim_version(spark, tables, model_name)
    log_model_run(customers, scored, tables, model_name, version, None, None)


def log_model_run(
    customers: DataFrame,
    scored: DataFrame,
    tables: Lake,
    model_name: str,
    version: int,
    path: str | None,
    model: forest.ChurnModel | None,
) -> None:
    """Append one row to model_runs. Without a model the run is a baseline, not promotable."""
    auc = evaluation.roc_auc(scored, "churn_risk_score")
    metrics = evaluation.classification_metrics(scored, "churn_risk_score")
    fitted = model is not None
    importances = forest.importances(model) if fitted else {}
    entries = [F.struct(F.lit(f).alias("feature"), F.lit(w).alias("importance")) for f, w in importances.items()]
    constants = {
        "model_name": model_name,
        "version": version,
        "logged_at": bronze.utc_now(),
        "model_type": "random_forest" if fitted else "majority_class",
        "num_trees": forest.NUM_TREES if fitted else None,
        "max_depth": forest.MAX_DEPTH if fitted else None,
        "min_instances_per_node": forest.MIN_INSTANCES if fitted else None,
        "seed": forest.SEED if fitted else None,
        "promotable": fitted,
        "model_path": path,
    }
    stats = features.label_stats(customers)
    row = metrics.withColumns(
        {
            **{name: F.lit(value) for name, value in constants.items()},
            "roc_auc": auc.select("roc_auc").scalar(),
            "importances": F.array(*entries),
            "n_training_rows": stats.select("n_rows").scalar(),
            "churn_rate": stats.select("churn_rate").scalar(),
        }
    )
    typed = row.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.MODEL_RUNS.fields]
    )
    # One row, so one file.
    lake.append_table(typed.coalesce(1), tables.model_runs)


def model_runs(spark: SparkSession, tables: Lake) -> DataFrame:
    try:
        return lake.read_table(spark, tables.model_runs)
    except lake.TableMissing:
        return spark.createDataFrame([], schemas.MODEL_RUNS)


def load_production(
    spark: SparkSession, tables: Lake, model_name: str = MODEL_NAME
) -> tuple[forest.ChurnModel, int]:
    """The production model and its version."""
    run_row = (
        registry.production_models(model_runs(spark, tables))
        .where(F.col("model_name") == model_name)
        .first()
    )
    if run_row is None:
        raise LookupError(f"no version of {model_name} is in production")
    return forest.ChurnModel.load(spark, run_row["model_path"]), run_row["version"]


def score(spark: SparkSession, tables: Lake, model_name: str = MODEL_NAME) -> int:
    """Score every customer with the production model and store the scores; returns its version."""
    model, version = load_production(spark, tables, model_name)
    customers = lake.read_table(spark, f"{tables.gold}/customer_features", tables.fmt)
    scored = forest.score_customers(model, customers)
    lake.overwrite_table(
        scored.withColumn("model_version", F.lit(version).cast("int")), tables.scores, tables.fmt
    )
    return version


def model_importances(
    spark: SparkSession, tables: Lake, version: int, model_name: str = MODEL_NAME
) -> dict[str, float]:
    """What the run of a version logged: one number for each feature."""
    run_row = (
        model_runs(spark, tables)
        .where((F.col("model_name") == model_name) & (F.col("version") == version))
        .select("importances")
        .first()
    )
    return {entry["feature"]: entry["importance"] for entry in run_row["importances"]}


def answer_questions(
    spark: SparkSession, tables: Lake, asked: DataFrame, model_name: str = MODEL_NAME
) -> DataFrame:
    """Answer questions from the stored Gold tables and the stored scores, explained by the model
    that gave them."""
    scores = lake.read_table(spark, tables.scores, tables.fmt)
    version = scores.agg(F.max("model_version")).first()[0]
    risk = explain.risk_answers(scores, model_importances(spark, tables, version, model_name))
    return questions.answer(
        asked,
        lake.read_table(spark, f"{tables.gold}/category_sales", tables.fmt),
        lake.read_table(spark, f"{tables.gold}/customer_features", tables.fmt),
        risk,
    )


def check_model(
    spark: SparkSession, tables: Lake, min_auc: float, model_name: str = MODEL_NAME
) -> DataFrame:
    """Gate the production model, store the report and return the stored verdict, if there is one."""
    report = registry.model_gate(
        model_runs(spark, tables).where(F.col("model_name") == model_name), min_auc
    )
    return _store_report(report, f"{tables.reports}/model")


def record_run(
    spark: SparkSession,
    tables: Lake,
    quality_verdict: DataFrame | None,
    model_verdict: DataFrame | None,
    seconds: float,
    failed_step: str | None,
) -> None:
    """Append the run to the history, with the reports of the steps it reached."""
    this_run = spark.createDataFrame(
        [("run", bronze.utc_now(), seconds, failed_step)],
        "run_id string, timestamp string, pipeline_duration_seconds double, failed_step string",
    )
    reports = []
    for verdict, schema in (
        (quality_verdict, schemas.DQ_REPORT),
        (model_verdict, schemas.MODEL_REPORT),
    ):
        known = spark.createDataFrame([], schema) if verdict is None else verdict
        reports.append(known.withColumn("run_id", F.lit("run")))
    record = monitor.run_records(this_run, *reports)
    logs.append_log(record.coalesce(1), tables.history)


def _store_report(report: DataFrame, path: str) -> DataFrame:
    schema = report.schema
    logs.write_report(report.coalesce(1), path)
    return report.sparkSession.read.schema(schema).json(path)


def _require(verdict: DataFrame, message: str) -> None:
    row = verdict.first()
    if row is None or not row["passed"]:
        raise GateFailed(f"{message}: {row.asDict() if row else 'no report'}")
