"""Readers and writers of lake tables, raw CSV drops and named views."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrain import schemas
from tillgrain.sources import parts
from tillgrain.sources.parts import BATCH


class TableMissing(Exception):
    """Nothing has been written at the path yet."""


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A CSV drop with a header. A field that does not parse becomes NULL, the row is kept."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A lake table; fmt "delta" needs the Delta jar on the session's class path.

    The files of a parquet table are looked up once, here: what is replaced later does not show.
    """
    try:
        if fmt == "parquet":
            return _stored(spark, path).drop(BATCH)
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise TableMissing(path) from error
        raise


def _stored(spark: SparkSession, path: str, without: str | None = None) -> DataFrame:
    """Rows of a parquet table, with their batch where it has batches; all batches but one."""
    reader = spark.read.option("basePath", path)
    folders = parts.Versions(spark, path).folders()
    if folders is None:
        found = reader.parquet(path)
        return found if without is None else found.where(F.col(BATCH) != without)
    if not folders:
        raise TableMissing(path)
    return reader.parquet(*[f"{path}/{f}" for f in folders if f != f"{BATCH}={without}"]).drop(parts.PART_SET, parts.PART)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).save(path)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace all rows of a table. Readers see the old rows or the new ones."""
    if fmt == "parquet":
        parts.replace_all(df, path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def write_batch(df: DataFrame, path: str, batch: str, fmt: str = "parquet") -> None:
    """Add a batch to a table as a folder of its own; written again it takes its own place.

    Streams and batch jobs share this layout, so either may add to a table of the other.
    """
    if fmt == "parquet":
        df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")
    else:
        append_table(df, path, fmt)


def read_batch(df: DataFrame, path: str, batch: str) -> DataFrame:
    """The rows of df, as a batch of a parquet table has them."""
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{BATCH}={batch}")


def other_batches(spark: SparkSession, path: str, batch: str, schema: T.StructType) -> DataFrame:
    """Rows of a parquet table but those of one batch; no rows if there is no table yet."""
    # Rows whose number the planner knows, so that a join with none of them exchanges nothing.
    none = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    try:
        return _stored(spark, path, without=batch).select(*schema.names)
    except TableMissing:
        return none
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return none
        raise


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    # Declared, not inferred: inference would read the file once more.
    return read_csv(spark, path, schemas.CUSTOMERS)


def register_gold_views(spark: SparkSession, gold_dir: str, fmt: str = "parquet") -> None:
    for name in ("category_sales", "customer_features"):
        read_table(spark, f"{gold_dir}/{name}", fmt).createOrReplaceTempView(name)


def rows(spark: SparkSession, values: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Literal rows; the schema is given because an all-NULL column has no type to infer."""
    return spark.createDataFrame(list(values), schema)


def manifest_path(table_path: str) -> str:
    """Where the names of the files that a table was ingested from are kept."""
    return f"{table_path.rstrip('/')}_files"


MANIFEST = T.StructType([T.StructField("file", T.StringType())])


def unified(name: Column) -> Column:
    """Spark writes a local path as file:/ or file:///, depending on where it is asked."""
    return F.regexp_replace(name, "^([a-z0-9]+):/+", "$1:/")


def unseen_files(spark: SparkSession, input_path: str, table_path: str) -> list[str]:
    """Files below input_path that the table's manifest does not name.

    The listing is a scan without content, compared with the manifest in the plan. Only the new
    names come to the driver, which needs them to plan the scan of these files.
    """
    listing = spark.read.format("binaryFile").load(input_path).select("path", source_file().alias("f"))
    seen = other_batches(spark, manifest_path(table_path), "", MANIFEST)
    left = listing.join(seen, unified(F.col("f")) == F.col("file"), "left_anti")
    return sorted(row["path"] for row in left.select("path").collect())


def source_file() -> Column:
    return F.col("_metadata.file_path")
