"""JSON reports and append-only JSON logs."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def append_log(records: DataFrame, path: str) -> None:
    """Append records as JSON lines; a NULL column leaves its key out of the line."""
    records.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A log with its timestamp parsed; a log not yet written is empty, an absent key is NULL."""
    try:
        log = spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], schema)
    if "timestamp" in schema.names:
        log = log.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
    return log
