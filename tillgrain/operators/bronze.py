"""Bronze: raw drops stored as received, with where and when they came in."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain import schemas
from tillgrain.sources import lake


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def with_lineage(raw: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Add the batch's ingestion time and each row's source file to a file scan."""
    return raw.withColumn("_ingested_at", F.lit(ingested_at or utc_now())).withColumn(
        "_source_file", lake.source_file()
    )


def store_batch(batch: DataFrame, output_path: str, batch_id: str, fmt: str = "parquet") -> None:
    """Add a batch with lineage to the Bronze table, then its file names to the manifest.

    A run that ends between the two stores its files again the next time, which Silver's
    deduplication takes back; the other order could lose them.
    """
    lake.write_batch(batch, output_path, batch_id, fmt)
    if fmt == "parquet":
        # From the one column that was just stored: the batch is not read and parsed once more.
        batch = lake.read_batch(batch, output_path, batch_id)
    files = batch.select("_source_file").distinct()
    names = files.select(lake.unified(F.col("_source_file")).alias("file")).where("file IS NOT NULL")
    lake.write_batch(names.distinct(), lake.manifest_path(output_path), batch_id)


def ingest(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    fmt: str = "parquet",
    skip_seen_files: bool = False,
    ingested_at: str | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Append a CSV drop to the Bronze table and return what was appended.

    Appending the same drop twice stores it twice unless skip_seen_files is set, or it is the same
    batch: one that is named again takes its own place.
    """
    files = lake.unseen_files(spark, input_path, output_path) if skip_seen_files else input_path
    if not files:
        return spark.createDataFrame([], schemas.BRONZE_TRANSACTIONS)
    raw = lake.read_csv(spark, files, schemas.RAW_TRANSACTIONS)
    batch = with_lineage(raw, ingested_at)
    store_batch(batch, output_path, batch_id or f"run-{uuid.uuid4().hex}", fmt)
    return batch
