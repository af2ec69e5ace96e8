"""Every operator as a named query over the given tables: (spark, sf_dir) -> DataFrame."""

from collections.abc import Callable, Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession, Window
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
    reports,
    silver,
)
from tillgrain.plans import flow, incremental
from tillgrain.session import releasing, scratch_path, slices, stage
from tillgrain.sources import feed, files, lake, logs
from tillgrain.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the queries; the SQL in plans.oracle repeats them.
INCIDENT_FRACTION = 0.30
DIRT_FRACTION = 0.05
RUN_THRESHOLD = 0.96
DEAL_ROUNDS = 4  # in which a feed is joined and dealt out; no parameter of a result
IMPORTANCES = dict(zip(features.FEATURES, (0.25, 0.2, 0.15, 0.1, 0.15, 0.1, 0.05)))


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ---- inputs shared by the queries ------------------------------------------------------------


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_transactions(feed.transactions(spark, sf_dir))[0]


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.category_sales(_clean(spark, sf_dir))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.customer_features(_clean(spark, sf_dir), feed.customers(spark, sf_dir))


def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as a stored table, for queries that read them more than once."""
    return stage(_features(spark, sf_dir), "customer_features")


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.encode_features(_stored_features(spark, sf_dir))


def _with_formula_score(df: DataFrame, name: str = "score") -> DataFrame:
    """A score that SQL can compute too: fewer transactions, higher risk."""
    return df.withColumn(name, F.round(1.0 / (1.0 + F.col("total_transactions") / 10.0), 6))


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report of every monthly batch."""
    return quality.quality_report(feed.transactions(spark, sf_dir, with_batch=True), by=["batch"])


def _monthly_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A candidate model per month: its customers scored by how little they bought in it."""
    clean = stage(_clean(spark, sf_dir), "silver")
    labels = gold.customer_features(clean, feed.customers(spark, sf_dir)).select(
        "customer_id", "churned"
    )
    activity = clean.groupBy(
        (F.year("transaction_ts") * 12 + F.month("transaction_ts")).alias("version"), "customer_id"
    ).agg((-F.count(F.lit(1))).cast("double").alias("score"))
    measured = evaluation.roc_auc(activity.join(labels, "customer_id"), by=["version"])
    return measured.select(
        F.lit(flow.MODEL_NAME).alias("model_name"),
        "version",
        F.round("roc_auc", 6).alias("roc_auc"),
        (F.col("version") % 5 != 0).alias("promotable"),
    )


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run record per monthly batch; batches below the gate have no model report."""
    batches = stage(_batches(spark, sf_dir), "batches").withColumnRenamed("batch", "run_id")
    runs = batches.select(
        "run_id",
        F.concat("run_id", F.lit("-01T00:00:00+00:00")).alias("timestamp"),
        (F.col("total_rows") / 7.0).alias("pipeline_duration_seconds"),
        F.when(F.col("overall_score") < RUN_THRESHOLD, "quality_gate").alias("failed_step"),
    )
    month = F.col("version") - 1
    models = (
        _monthly_runs(spark, sf_dir)
        .select(
            F.format_string("%04d-%02d", F.floor(month / 12).cast("int"), month % 12 + 1).alias(
                "run_id"
            ),
            F.col("version").alias("model_version"),
            "roc_auc",
            (F.col("roc_auc") >= 0.5).alias("passed"),
        )
        .join(runs.where(F.col("failed_step").isNull()).select("run_id"), "run_id", "left_semi")
    )
    return monitor.run_records(runs, batches, models)


def _answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = stage(gold.purchases(_clean(spark, sf_dir)), "purchases")
    sales = stage(gold.sales_of(bought), "category_sales")
    customer_rows = stage(
        gold.features_of(bought, feed.customers(spark, sf_dir)), "customer_features"
    )
    risk = explain.risk_answers(
        _with_formula_score(features.encode_features(customer_rows), "churn_risk_score"),
        IMPORTANCES,
    )
    asked = feed.questions(spark, sf_dir)
    answered = questions.answer(asked, sales, customer_rows, risk)
    return answered.drop("evidence", "model_version")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The day of the log is fixed here, so that the query gives the same rows every time.
    return questions.query_log(_answered(spark, sf_dir), F.lit("2026-01-01T00:00:00+00:00"))


def _lake_with_bronze(spark: SparkSession, sf_dir: str) -> flow.Lake:
    tables = flow.Lake(scratch_path(spark, "lake"))
    raw = scratch_path(spark, "raw")
    lake.write_csv(feed.transactions(spark, sf_dir), raw)
    bronze.ingest(spark, raw, tables.bronze)
    return tables


def _received(stored: DataFrame) -> DataFrame:
    """Bronze rows, with their lineage reduced to whether it is there."""
    return stored.select(
        *schemas.RAW_TRANSACTIONS.names,
        F.col("_ingested_at").isNotNull().alias("has_time"),
        F.col("_source_file").endswith(".csv").alias("has_file"),
    )


# ---- Bronze and its quality ------------------------------------------------------------------


@query
def bronze_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.transactions(spark, sf_dir)


@query
def dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.with_dirt(feed.transactions(spark, sf_dir), DIRT_FRACTION)


@query
def shuffled_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.shuffled(feed.transactions(spark, sf_dir), "transaction_id", "transaction_ts")


@query
def customers_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customers")
    lake.write_csv(feed.customers(spark, sf_dir), path)
    return lake.read_customers(spark, path)


@query
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest the same drop twice, the second time skipping what is there."""
    raw, stored = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    lake.write_csv(feed.transactions(spark, sf_dir), raw)
    for _ in range(2):
        bronze.ingest(spark, raw, stored, skip_seen_files=True)
    return _received(lake.read_table(spark, stored))


@query
def bronze_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest the same drop twice with plain appends: every row is stored, and scored, twice."""
    raw, stored = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    lake.write_csv(feed.transactions(spark, sf_dir), raw)
    for _ in range(2):
        bronze.ingest(spark, raw, stored)
    return quality.overall(quality.quality_report(lake.read_table(spark, stored)))


@query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the file stream twice over one drop."""
    raw, stored = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    checkpoint = scratch_path(spark, "stream")
    lake.write_csv(feed.transactions(spark, sf_dir), raw)
    for _ in range(2):
        ingest.stream_bronze(spark, raw, stored, checkpoint).awaitTermination()
    return _received(lake.read_table(spark, stored))


@query
def dq_rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_report(quality.quality_report(feed.transactions(spark, sf_dir)))


@query
def dq_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.overall(quality.quality_report(feed.transactions(spark, sf_dir)))


@query
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_gate(quality.quality_report(feed.transactions(spark, sf_dir)))


@query
def dq_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.overall(_batches(spark, sf_dir))


@query
def dq_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict written as a JSON report and read back."""
    return flow.check_quality(spark, _lake_with_bronze(spark, sf_dir), quality.DEFAULT_THRESHOLD)


@query
def corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.inject_incident(feed.transactions(spark, sf_dir), INCIDENT_FRACTION)


@query
def incident_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.incident_report(feed.transactions(spark, sf_dir), INCIDENT_FRACTION)


@query
def incident_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corrupted batch stored as a Bronze table, read again and put before the gate."""
    tables = flow.Lake(scratch_path(spark, "lake"))
    batch = quality.inject_incident(feed.transactions(spark, sf_dir), INCIDENT_FRACTION)
    lake.write_batch(batch, tables.bronze, "incident")
    return flow.check_quality(spark, tables, quality.DEFAULT_THRESHOLD)


# ---- Silver ----------------------------------------------------------------------------------


@query
def dedup_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dedup_transactions(feed.transactions(spark, sf_dir))


@query
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


@query
def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarantined = silver.clean_transactions(feed.transactions(spark, sf_dir))[1]
    return quarantined.withColumn("_dq_failures", F.concat_ws(",", "_dq_failures"))


@query
def silver_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.flow_summary(feed.transactions(spark, sf_dir))


@query
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.quarantine_reasons(silver.clean_transactions(feed.transactions(spark, sf_dir))[1])


@query
def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the clean table and of the quarantine after Silver wrote both."""
    tables = _lake_with_bronze(spark, sf_dir)
    flow.write_silver(spark, tables)
    kept = ("transaction_id", "customer_id", "product_category", "transaction_amount")
    return (
        lake.read_table(spark, tables.silver)
        .select(*kept, F.lit(False).alias("quarantined"))
        .unionByName(
            lake.read_table(spark, tables.quarantine).select(*kept, F.lit(True).alias("quarantined"))
        )
    )


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a stream over three drops: the second replays rows and has an old time stamp, the
    third has none. Returns all columns of the clean table and of the quarantine."""
    tables, checkpoint = flow.Lake(scratch_path(spark, "lake")), scratch_path(spark, "stream")
    rows = feed.transactions(spark, sf_dir)
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    drops = (
        (rows.where(part == 0), "2026-08-30T00:00:00"),
        (rows.where(part != 2), "2026-08-01T00:00:00"),
        (rows.where(part != 1), None),
    )
    for i, (drop, stamp) in enumerate(drops):
        batch = drop.select(
            *schemas.RAW_TRANSACTIONS.names,
            F.lit(stamp).cast("string").alias("_ingested_at"),
            F.lit(f"drop-{i}").alias("_source_file"),
        )
        bronze.store_batch(batch, tables.bronze, f"drop-{i}")
        for _ in range(2):
            ingest.stream_silver(
                spark, tables.bronze, tables.silver, tables.quarantine, checkpoint
            ).awaitTermination()
    return _both_silver(spark, tables)


def _both_silver(spark: SparkSession, tables: flow.Lake) -> DataFrame:
    """All columns of the clean table and of the quarantine but the lineage."""
    clean = lake.read_table(spark, tables.silver).drop("_ingested_at", "_source_file")
    bad = lake.read_table(spark, tables.quarantine).drop("_ingested_at")
    return (
        clean.withColumn("quantity", F.col("quantity").cast("string"))
        .withColumn("_dq_failures", F.lit(""))
        .unionByName(
            bad.withColumn("_dq_failures", F.concat_ws(",", "_dq_failures")), allowMissingColumns=True
        )
    )


def _drop(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").option("header", True).csv(folder)


def _by_thirds(rows: DataFrame) -> list[DataFrame]:
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    return [rows.where(part == i) for i in range(3)]


@query
def two_streams_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with a drop folder each fill one Bronze table; then the first one's checkpoint is
    lost after its folder was emptied, and it starts anew on new files."""
    stored = scratch_path(spark, "bronze")
    for rows in _by_thirds(feed.transactions(spark, sf_dir)):
        raw, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "stream")
        _drop(rows, raw)
        for _ in range(2):
            ingest.stream_bronze(spark, raw, stored, checkpoint).awaitTermination()
    return _received(lake.read_table(spark, stored))


@query
def two_streams_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams from a Bronze table each fill one Silver; the second finds what the first has stored."""
    tables = flow.Lake(scratch_path(spark, "lake"))
    first, second, third = _by_thirds(feed.transactions(spark, sf_dir))
    for rows in (first.unionByName(second), second.unionByName(third)):
        raw, stored = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
        _drop(rows, raw)
        ingest.stream_bronze(spark, raw, stored, scratch_path(spark, "stream")).awaitTermination()
        ingest.stream_silver(
            spark, stored, tables.silver, tables.quarantine, scratch_path(spark, "stream")
        ).awaitTermination()
    return _both_silver(spark, tables)


def _store_drop(rows: DataFrame, tables: flow.Lake, number: int) -> None:
    lineage = {"_ingested_at": F.lit(f"day {number}"), "_source_file": F.lit(f"drop-{number}")}
    bronze.store_batch(rows.withColumns(lineage), tables.bronze, f"drop-{number}")


def _months_to_bronze(rows: DataFrame, tables: flow.Lake) -> Iterator[int]:
    """Bronze gets three drops, the next one when it is asked for: mostly of one span of time each; a tenth
    of the rows comes two drops late. A drop that is stored is not kept beside Bronze."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "dealt")
    year = F.coalesce(F.year(F.col("transaction_ts").try_cast("date")), F.lit(0))
    span = F.when(year < 1994, 0).when(year < 1996, 1).otherwise(2)
    late = F.pmod(F.xxhash64("transaction_id"), F.lit(10)) == 0
    # Copies of a transaction come together, as batch Silver chooses among all of them.
    first = F.min(F.when(late, 2).otherwise(span)).over(Window.partitionBy("transaction_id"))
    # In rounds, so that no more than a share of the feed is on its way through joins and windows.
    marked = [s.withColumn("drop", first) for s in slices(rows, "transaction_id", DEAL_ROUNDS)]
    for share in marked:
        with releasing(spark):
            share.write.mode("append").partitionBy("drop").parquet(path)
    dealt = spark.read.schema(marked[0].schema).parquet(path)
    for i in range(3):
        with releasing(spark):
            _store_drop(dealt.where(F.col("drop") == i).drop("drop"), tables, i)
        files.delete(spark, f"{path}/drop={i}")
        yield i


def _lake_in_batches(spark: SparkSession, sf_dir: str) -> tuple[flow.Lake, str]:
    """Silver streamed in three batches, with Gold brought up to it after each."""
    tables, checkpoint = flow.Lake(scratch_path(spark, "lake")), scratch_path(spark, "stream")
    customers = scratch_path(spark, "customers")
    lake.write_csv(feed.customers(spark, sf_dir), customers)
    for _ in _months_to_bronze(feed.transactions(spark, sf_dir), tables):
        ingest.stream_silver(
            spark, tables.bronze, tables.silver, tables.quarantine, checkpoint, ids_per_bucket=20_000
        ).awaitTermination()
        incremental.update_gold(spark, customers, tables, buckets=8, period="month")
    return tables, customers


@query
def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver over four batches, the last of which replays a part of all others, with small buckets of
    ids, so that the index is made anew on the way."""
    tables, checkpoint = flow.Lake(scratch_path(spark, "lake")), scratch_path(spark, "stream")
    rows = feed.transactions(spark, sf_dir)
    def replay() -> Iterator[int]:
        _store_drop(_by_thirds(rows)[1], tables, 3)
        yield 3

    for _ in chain(_months_to_bronze(rows, tables), replay()):
        ingest.stream_silver(
            spark, tables.bronze, tables.silver, tables.quarantine, checkpoint, ids_per_bucket=5_000
        ).awaitTermination()
    return _both_silver(spark, tables)


@query
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category sales after three batches, each merged into what the ones before have left."""
    tables, _ = _lake_in_batches(spark, sf_dir)
    return lake.read_table(spark, f"{tables.gold}/category_sales").select(*schemas.CATEGORY_SALES.names)


@query
def features_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features after three batches, each merged into what the ones before have left."""
    tables, _ = _lake_in_batches(spark, sf_dir)
    return lake.read_table(spark, f"{tables.gold}/customer_features")


@query
def stream_and_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Bronze table fed by the stream, by a batch job and by the stream again."""
    raw, stored = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    checkpoint = scratch_path(spark, "stream")
    rows = feed.transactions(spark, sf_dir)
    for i in range(3):
        own = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == i
        rows.where(own).write.mode("append").option("header", True).csv(raw)
        if i == 1:
            bronze.ingest(spark, raw, stored, skip_seen_files=True)
        else:
            ingest.stream_bronze(spark, raw, stored, checkpoint).awaitTermination()
    return _received(lake.read_table(spark, stored))


# ---- Gold and its reports --------------------------------------------------------------------


@query
def category_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.sorted_sales(_sales(spark, sf_dir))


@query
def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


@query
def churn_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.churn_summary(_features(spark, sf_dir))


@query
def total_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.total_revenue(_sales(spark, sf_dir))


@query
def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_categories(_sales(spark, sf_dir))


@query
def category_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_total(_sales(spark, sf_dir), "m")


@query
def category_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_customer_count(_sales(spark, sf_dir), "ar")


@query
def category_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_reach(gold.daily_customer_sketches(_clean(spark, sf_dir)))


@query
def gold_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both Gold tables stored, registered as views and read with SQL."""
    gold_dir = scratch_path(spark, "gold")
    bought = stage(gold.purchases(_clean(spark, sf_dir)), "purchases")
    lake.overwrite_table(gold.sales_of(bought), f"{gold_dir}/category_sales")
    lake.overwrite_table(
        gold.features_of(bought, feed.customers(spark, sf_dir)),
        f"{gold_dir}/customer_features",
    )
    lake.register_gold_views(spark, gold_dir)
    return spark.sql(
        """
        SELECT 'category_sales' AS source, count(*) AS rows, sum(transaction_count) AS measure
        FROM category_sales
        UNION ALL
        SELECT 'customer_features', count(*), sum(churned) FROM customer_features
        """
    )


# ---- Model input, metrics and registry -------------------------------------------------------


@query
def features_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir).select("customer_id", *features.FEATURES, "region", "churned")


@query
def label_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.label_stats(_features(spark, sf_dir))


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.class_weights(_features(spark, sf_dir))


@query
def weighted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_class_weights(_stored_features(spark, sf_dir))
    return rows.select("customer_id", "churned", "weight")


@query
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = features.stratified_split(_stored_features(spark, sf_dir))
    return split.select("customer_id", "churned", "is_test")


@query
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _with_formula_score(_stored_features(spark, sf_dir))
    return evaluation.roc_auc(scored).select(F.round("roc_auc", 9).alias("roc_auc"))


@query
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _with_formula_score(_features(spark, sf_dir))
    return evaluation.classification_metrics(scored, threshold=0.2)


@query
def baseline_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = evaluation.majority_scores(_stored_features(spark, sf_dir))
    return evaluation.roc_auc(scored)


@query
def leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (*features.FEATURES, features.LEAKY_COLUMN)
    checked = evaluation.leakage_check(stage(_encoded(spark, sf_dir), "encoded"), columns)
    return checked.withColumn("single_feature_auc", F.round("single_feature_auc", 9))


@query
def promotion_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.promotion_history(_monthly_runs(spark, sf_dir))


@query
def production_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.production_models(_monthly_runs(spark, sf_dir)).select(
        "model_name", "version", "roc_auc"
    )


@query
def model_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.model_gate(_monthly_runs(spark, sf_dir))


@query
def churn_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(features.stratified_split(_stored_features(spark, sf_dir)), "split", "is_test")
    model = forest.fit_churn_model(rows.where(~F.col("is_test")))
    return forest.highest_risk(forest.score_customers(model, rows))


@query
def churn_model_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stored_features(spark, sf_dir)
    return forest.importance_table(forest.fit_churn_model(rows), rows)


@query
def highest_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = stage(_encoded(spark, sf_dir), "encoded")
    return forest.highest_risk(_with_formula_score(encoded, "churn_risk_score"))


@query
def churn_model_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of a forest fitted on the customers, whatever its scores are."""
    rows = stage(features.stratified_split(_stored_features(spark, sf_dir)), "split", "is_test")
    model = forest.fit_churn_model(rows.where(~F.col("is_test")))
    scored = stage(forest.score_customers(model, rows), "scored")
    weights = forest.importances(model)
    auc = evaluation.roc_auc(scored, "churn_risk_score").scalar()
    in_range = F.coalesce(F.col("churn_risk_score").between(0, 1), F.lit(False))
    return scored.agg(
        F.count("*").alias("rows_scored"),
        F.bool_and(in_range).alias("scores_in_range"),
        F.lit(len(weights)).cast("long").alias("importances"),
        F.lit(abs(sum(weights.values()) - 1) < 1e-6).alias("importances_sum_to_one"),
    ).withColumn("better_than_chance", auc > 0.5)


@query
def category_reach_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketches' estimate beside the exact number of customers."""
    clean = stage(_clean(spark, sf_dir), "silver")
    exact = clean.groupBy("product_category").agg(
        F.countDistinct("customer_id").alias("distinct_customers")
    )
    reach = reports.category_reach(gold.daily_customer_sketches(clean))
    estimate = next(c for c in reach.columns if c != "product_category")
    off = F.abs(F.col(estimate) - F.col("distinct_customers"))
    return exact.join(reach.select("product_category", estimate), "product_category").select(
        "product_category",
        "distinct_customers",
        (off <= 0.05 * F.col("distinct_customers")).alias("estimate_within_5_percent"),
    )


# ---- Explanations ----------------------------------------------------------------------------


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query
def feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(explain.feature_stats(_encoded(spark, sf_dir)), 4, "mean", "std")


@query
def reference_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = explain.reference_profiles(_encoded(spark, sf_dir))
    return _rounded(profiles, 4, "churned_avg", "retained_avg")


@query
def explain_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    explained = explain.zscore_factors(stage(_encoded(spark, sf_dir), "encoded"), IMPORTANCES)
    return _rounded(explain.factor_rows(explained), 6, "value", "weight")


@query
def explain_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    explained = explain.profile_factors(stage(_encoded(spark, sf_dir), "encoded"), IMPORTANCES)
    return _rounded(explain.factor_rows(explained), 6, "value", "weight")


@query
def risk_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _with_formula_score(_encoded(spark, sf_dir), "churn_risk_score")
    return explain.evidence(scored).withColumn(
        "risk_band", explain.risk_band(F.col("churn_risk_score"))
    )


@query
def risk_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = stage(_encoded(spark, sf_dir), "encoded")
    answers = explain.risk_answers(_with_formula_score(encoded, "churn_risk_score"), IMPORTANCES)
    return answers.drop("evidence", "model_version")


# ---- Questions -------------------------------------------------------------------------------


@query
def route_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.route(feed.questions(spark, sf_dir)).drop("question")


@query
def answer_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answered(spark, sf_dir).drop("question")


@query
def lookup_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order; a third of them ask for the same customer, some for unknown ones."""
    key = F.col("o_orderkey")
    requests = feed.table(spark, sf_dir, "orders").select(
        key.alias("request_id"),
        F.when(key % 3 == 0, "CUST000001")
        .when(key % 7 == 0, F.concat(F.lit("X"), F.col("o_custkey")))
        .otherwise(feed.customer_code(F.col("o_custkey")))
        .alias("customer_id"),
    )
    scored = _with_formula_score(_stored_features(spark, sf_dir), "churn_risk_score")
    return questions.lookup_customers(
        requests, scored.select("customer_id", "churn_risk_score", "total_transactions")
    )


@query
def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log appended to as JSON lines and read back."""
    path = scratch_path(spark, "query_log")
    logs.append_log(_log(spark, sf_dir), path)
    return logs.read_log(spark, path, schemas.QUERY_LOG).drop("timestamp")


# ---- Monitoring ------------------------------------------------------------------------------


@query
def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)


@query
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records appended as JSON lines, read back, newest first."""
    path = scratch_path(spark, "history")
    logs.append_log(_history(spark, sf_dir), path)
    read = monitor.newest_first(logs.read_log(spark, path, schemas.METRICS_HISTORY))
    in_utc = F.to_utc_timestamp("timestamp", F.current_timezone())
    return read.withColumn("timestamp", F.date_format(in_utc, "yyyy-MM-dd"))


@query
def run_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.run_kpis(_history(spark, sf_dir), RUN_THRESHOLD)


@query
def intent_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.intent_distribution(_log(spark, sf_dir))


@query
def unmatched_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = monitor.unmatched_rate(_log(spark, sf_dir))
    return _rounded(rate, 9, "unmatched_rate")


# ---- The whole flow --------------------------------------------------------------------------


@query
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze to model gate in one run; returns the run's record."""
    tables = flow.Lake(scratch_path(spark, "lake"))
    raw, customers = scratch_path(spark, "raw"), scratch_path(spark, "customers")
    lake.write_csv(feed.transactions(spark, sf_dir), raw)
    lake.write_csv(feed.customers(spark, sf_dir), customers)
    flow.run(spark, raw, customers, tables, min_auc=0.5)
    record = logs.read_log(spark, tables.history, schemas.METRICS_HISTORY)
    return record.select(
        "dq_overall_score",
        "dq_total_rows",
        "dq_fully_passing_rows",
        "model_version",
        "model_gate_passed",
        F.col("failed_step").isNull().alias("complete"),
    )


@query
def resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that fails at the model gate and is started again with another one: how often each step was
    done, and what is in Bronze."""
    tables = flow.Lake(scratch_path(spark, "lake"))
    raw, customers = scratch_path(spark, "raw"), scratch_path(spark, "customers")
    lake.write_csv(feed.transactions(spark, sf_dir), raw)
    lake.write_csv(feed.customers(spark, sf_dir), customers)
    try:
        flow.run(spark, raw, customers, tables, min_auc=1.01)
    except flow.GateFailed:
        flow.run(spark, raw, customers, tables, min_auc=0.0)
    history = logs.read_log(spark, tables.history, schemas.METRICS_HISTORY)
    stored, silver_rows = lake.read_table(spark, tables.bronze), lake.read_table(spark, tables.silver)
    return history.agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("failed_step") == "model_gate").alias("failed_at_the_gate"),
        F.count_if(F.col("failed_step").isNull()).alias("complete"),
        F.max("model_version").alias("model_version"),
    ).withColumns(
        {
            "bronze_rows": stored.agg(F.count(F.lit(1))).scalar(),
            "silver_rows": silver_rows.agg(F.count(F.lit(1))).scalar(),
            "trained": flow.model_runs(spark, tables).agg(F.count(F.lit(1))).scalar(),
        }
    )


def _lake_with_scores(spark: SparkSession, sf_dir: str) -> flow.Lake:
    """A lake up to the stored scores of its production model."""
    tables, customers = _lake_with_bronze(spark, sf_dir), scratch_path(spark, "customers")
    lake.write_csv(feed.customers(spark, sf_dir), customers)
    flow.write_silver(spark, tables)
    flow.write_gold(spark, customers, tables)
    flow.train(spark, tables)
    flow.score(spark, tables)
    return tables


@query
def production_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer scored by the stored production model."""
    tables = _lake_with_scores(spark, sf_dir)
    return lake.read_table(spark, tables.scores).select(
        "customer_id",
        "model_version",
        F.coalesce(F.col("churn_risk_score").between(0, 1), F.lit(False)).alias("score_in_range"),
    )


@query
def production_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions answered from the stored scores: version and evidence of each explanation, and
    whether its sentence agrees with the stored score."""
    tables = _lake_with_scores(spark, sf_dir)
    answered = flow.answer_questions(spark, tables, feed.questions(spark, sf_dir))
    score = F.get_json_object("evidence", "$.churn_risk_score").cast("double")
    asks = F.col("agent_used") == questions.EXPLAINER
    said = F.regexp_extract("answer", r"a (\d+)% churn risk score, which is (\w+)\.", 1)
    agrees = F.abs(said.try_cast("double") - 100 * score) <= 0.51
    return answered.select(
        "question_id",
        asks.alias("asks_for_risk"),
        "model_version",
        (asks & F.col("evidence").isNotNull()).alias("has_evidence"),
        F.when(asks & F.col("evidence").isNotNull(), F.coalesce(agrees, F.lit(False)))
        .otherwise(F.col("answer").isNotNull())
        .alias("consistent"),
    )
