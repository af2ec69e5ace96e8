"""Bronze and Silver as file streams: each run takes only the files that are new.

Batches are written by foreachBatch as folders of plain files, the layout that batch jobs use too: no
reader sees fewer files than there are. A batch is named by its stream and its number. The name of a
stream is kept with its checkpoint, so a retried batch takes its own place and no other: streams that
share a table, and a stream that starts anew because its checkpoint is lost, leave each other's rows.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillgrain import schemas
from tillgrain.operators import bronze, silver
from tillgrain.session import releasing, rounds_for, slices, stage, stage_rounds, staging
from tillgrain.sources import files, id_index, lake
from tillgrain.sources.id_index import IdIndex

IDS = "transaction_id"
STREAM = "stream-"
# What a task reads of a batch. Stored rows are many times smaller than those that it then sorts.
SPLIT_BYTES = 16 * 1024 * 1024


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that a checkpoint belongs to, made when it is asked for first."""
    path = f"{checkpoint}/stream_name"
    files.write_once(spark, path, f"{STREAM}{uuid.uuid4().hex}")
    return files.read(spark, path)


def stream_bronze(
    spark: SparkSession, input_dir: str, output_path: str, checkpoint: str
) -> StreamingQuery:
    """Append the CSV files that arrived since the last run, then stop.

    The checkpoint remembers the stream's files and the manifest those of all other streams and jobs,
    so a drop is stored once however often this runs.
    """
    raw = (
        spark.readStream.option("header", True).schema(schemas.RAW_TRANSACTIONS).csv(input_dir)
    )
    arrivals = raw.withColumn(
        "_ingested_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    ).withColumn("_source_file", lake.source_file())
    stream = stream_name(spark, checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        name = f"{stream}-{batch_id}"
        seen = lake.other_batches(spark, lake.manifest_path(output_path), name, lake.MANIFEST)
        unseen = lake.unified(F.col("_source_file")) == F.col("file")
        bronze.store_batch(batch.join(seen, unseen, "left_anti"), output_path, name)

    return _once(arrivals, write_batch, checkpoint)


def silver_ids(
    spark: SparkSession,
    clean_path: str,
    quarantine_path: str,
    ids_per_bucket: int = id_index.IDS_PER_BUCKET,
    most_folders: int = id_index.MOST_FOLDERS,
) -> IdIndex:
    """The index of the ids of both Silver tables, kept beside the clean one."""
    path = f"{clean_path.rstrip('/')}_ids"
    tables = [clean_path.rstrip("/"), quarantine_path.rstrip("/")]
    return IdIndex(spark, tables, path, IDS, STREAM, ids_per_bucket, most_folders)


def stream_silver(
    spark: SparkSession,
    bronze_path: str,
    clean_path: str,
    quarantine_path: str,
    checkpoint: str,
    ids_per_bucket: int = id_index.IDS_PER_BUCKET,
    most_folders: int = id_index.MOST_FOLDERS,
) -> StreamingQuery:
    """Clean the Bronze rows that arrived since the last run, then stop.

    Every row of Bronze is taken, whatever its time stamps. A batch is deduplicated as batch Silver
    does it; ids that either table already has, NULL included, are replays and left out. They are
    looked up in the index of ids, so a batch reads neither table. What the batch itself has stored
    does not count, so a retry repeats itself, and a batch that is done is not repeated.

    Streams that fill the same tables must not run at the same time: neither sees what the other one
    is about to store.
    """
    arrivals = (
        spark.readStream.schema(schemas.BRONZE_TRANSACTIONS).parquet(bronze_path).drop(lake.BATCH)
    )
    stream = stream_name(spark, checkpoint)
    index = silver_ids(spark, clean_path, quarantine_path, ids_per_bucket, most_folders)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        name = f"{stream}-{batch_id}"
        if index.is_done(name):
            return
        # Staged, so that all writes see the same rows even if executors are lost.
        with staging(spark), releasing(spark), releasing(batch.sparkSession):
            batch.sparkSession.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
            ids = stage(batch.select(IDS).distinct(), "stream_ids")
            index.refresh(name)
            known = index.candidates(ids, name).select(F.col(IDS).alias("_known"))
            # Found among the ids alone: what is left of the index's candidates is as small as the replay.
            replayed = stage(known.join(ids, F.col(IDS).eqNullSafe(F.col("_known")), "left_semi").distinct(), "replayed")
            null_is_known = not replayed.where("_known IS NULL").isEmpty()
            rounds = rounds_for(ids.count())
            parts_of_batch = zip(slices(batch, IDS, rounds), slices(replayed, "_known", rounds))
            # By plain equality, as the rows are dealt for their deduplication: they are not exchanged again.
            new = [
                silver.dedup_transactions(rows).join(gone, F.col(IDS) == F.col("_known"), "left_anti")
                for rows, gone in parts_of_batch
            ]
            if null_is_known:
                new = [rows.where(F.col(IDS).isNotNull()) for rows in new]
            tagged = stage_rounds([silver.tag_failures(rows) for rows in new], "stream_tagged")
            lake.write_batch(silver.clean_rows(tagged), clean_path, name)
            lake.write_batch(silver.quarantined_rows(tagged), quarantine_path, name)
            index.mark_done(name)

    return _once(arrivals, write_batch, checkpoint)


def _once(arrivals: DataFrame, write_batch, checkpoint: str) -> StreamingQuery:
    return (
        arrivals.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
