"""The churn forest: fit, score, importances. Fit and transform are Spark ML's."""

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.operators.features import (
    FEATURES,
    LABEL,
    check_features,
    median_age,
    region_codes,
    with_class_weights,
    with_codes,
)
from tillgrain.session import stage

PARTITION_ROWS, LEAST_PARTITIONS = 100_000, 8
REGION_CODES = "region string, region_encoded int"
NUM_TREES, MAX_DEPTH, MIN_INSTANCES, SEED = 150, 6, 5, 42


@dataclass
class ChurnModel:
    """The fitted stages, and the dictionary of regions they were fitted with."""

    pipeline: PipelineModel
    regions: DataFrame
    n_regions: int

    def save(self, path: str) -> None:
        self.pipeline.write().save(f"{path}/pipeline")
        self.regions.write.parquet(f"{path}/regions")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ChurnModel":
        regions = spark.read.schema(REGION_CODES).parquet(f"{path}/regions")
        return cls(PipelineModel.load(f"{path}/pipeline"), regions, regions.count())

    def transform(self, features: DataFrame) -> DataFrame:
        """Regions that were not there when the model was fitted share the code after the last one."""
        return self.pipeline.transform(with_codes(features, self.regions, unseen=self.n_regions))


def fit_churn_model(train: DataFrame) -> ChurnModel:
    """Fit on customer features. Pass stored or staged rows: fitting reads them several times.

    The median age and the region codes are fixed here and kept in the model, so scoring never
    derives them again from other data. The codes are a stored table that is joined: neither their
    number nor their length is bound by what the driver holds. Regions not seen in training share one
    extra code.
    """
    check_features()
    age = median_age(train)
    regions = stage(region_codes(train), "region_codes")
    n_regions = regions.count()
    fill = SQLTransformer(
        statement=f"""
            SELECT * EXCEPT (age), coalesce(age, {0.0 if age is None else age}D) AS age
            FROM __THIS__"""
    )
    forest = RandomForestClassifier(
        featuresCol="_features",
        labelCol=LABEL,
        weightCol="weight",
        numTrees=NUM_TREES,
        maxDepth=MAX_DEPTH,
        minInstancesPerNode=MIN_INSTANCES,
        seed=SEED,
    )
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    # Partitions by the number of rows, not of cores, and sorted: trees draw their samples by row
    # position, so the same rows give the same forest on any cluster.
    parts = max(LEAST_PARTITIONS, -(-train.count() // PARTITION_ROWS))
    spread = with_class_weights(with_codes(train, regions)).repartition(parts, "customer_id")
    fitted = Pipeline(stages=[fill, assemble, forest]).fit(spread.sortWithinPartitions("customer_id"))
    return ChurnModel(fitted, regions, n_regions)


def score_customers(model: ChurnModel, features: DataFrame) -> DataFrame:
    """Every input row with its encoded features and churn_risk_score."""
    scored = model.transform(features)
    risk = vector_to_array("probability")[1]
    return scored.withColumns(
        {"churn_risk_score": risk, "region_encoded": F.col("region_encoded").cast("double")}
    ).select(*features.columns, "region_encoded", "churn_risk_score")


def highest_risk(scored: DataFrame, n: int = 10) -> DataFrame:
    return (
        scored.orderBy(F.desc("churn_risk_score"), "customer_id")
        .limit(n)
        .select(
            "customer_id", "region", "lifetime_value", "days_since_last_purchase", "churn_risk_score"
        )
    )


def importances(model: ChurnModel) -> dict[str, float]:
    return dict(zip(FEATURES, model.pipeline.stages[-1].featureImportances.toArray().tolist()))


def importance_table(model: ChurnModel, features: DataFrame) -> DataFrame:
    spark = features.sparkSession
    return spark.createDataFrame(
        list(importances(model).items()), "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")
