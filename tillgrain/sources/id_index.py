"""An index of the ids that some tables hold, of which a new batch reads little.

Ids are dealt by hash into buckets, and every batch adds a folder to each bucket it has ids of, with the
ids and with a Bloom filter of them. A new batch looks only into its own buckets, there only into the
filters, and reads the ids of just those folders whose filter holds one of its own. Buckets are kept at
about the same size: when there are too many ids for them, or too many folders, all is written anew into
more buckets, as one folder each. So what a batch reads depends on its own size, not on the history's.

Where that would make very many small buckets, a bucket consists of several cells, which lie one after the
other in its files, each with a filter of its own: the number of folders grows with IDS_PER_FOLDER, and a
small batch reads of a folder only the pages of its cells.

The index is made of the tables and can be made again: batches of the tables that it lacks are added to
it, and if a batch that it holds has gone, for the tables were replaced, it is made anew. A batch that
is still being written by somebody else is not indexed; its ids are read from the tables.
"""

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.session import stage
from tillgrain.sources import files, parts
from tillgrain.sources.files import Ledger

IDS_PER_BUCKET = 1_000_000
MOST_FOLDERS = 64  # of a bucket, before it is written anew
IDS_PER_WORD = 4  # of a filter; a word has 64 bits, and an id sets up to four of them
BITS_OF_AN_ID = 4
LEAST_FOLDERS = 256  # that buckets may have whatever their size
IDS_PER_FOLDER = 250_000
MOST_PICKED = 64  # cells that a look-up names one by one
BASE = "base"


class IdIndex:
    """Which ids the tables hold. A batch of a writer that is not atomic has a name that starts with
    `unsure`, and counts as written once it is marked done."""

    def __init__(
        self,
        spark: SparkSession,
        tables: list[str],
        path: str,
        key: str,
        unsure: str,
        ids_per_bucket: int = IDS_PER_BUCKET,
        most_folders: int = MOST_FOLDERS,
    ):
        self.spark, self.tables, self.path, self.key, self.unsure = spark, tables, path, key, unsure
        self.ids_per_bucket, self.most_folders = ids_per_bucket, most_folders
        self.ledger = Ledger(spark, f"{path}/_generations")

    # ---- batches that are done -----------------------------------------------------------------

    def is_done(self, batch: str) -> bool:
        return files.exists(self.spark, f"{self.path}/_done/{batch}")

    def mark_done(self, batch: str) -> None:
        files.write_once(self.spark, f"{self.path}/_done/{batch}", True)

    # ---- what the index is made of -------------------------------------------------------------

    def refresh(self, own: str) -> None:
        """Bring the index up to the tables, but for a batch that is about to be written."""
        visible = {name for table in self.tables for name in parts.batches(self.spark, table)} - {own}
        done = set(files.names(self.spark, f"{self.path}/_done"))
        written = {n for n in visible if n in done or not n.startswith(self.unsure)}
        self.loose = sorted(visible - written)
        number, generation = self.ledger.latest()
        if generation is not None and "cells" in generation:  # others have files of another form
            self._use(generation)
            added = set(files.names(self.spark, self._covered()))
            held = added | set(generation["base"])
            if held <= written and len(added) < self.most_folders:
                lacking = {name: self._ids_of([name]) for name in sorted(written - held)}
                n_ids = generation["n_ids"] + sum(
                    [files.read(self.spark, f"{self._covered()}/{n}") for n in added]
                    + [ids.count() for ids in lacking.values()]
                )
                # Known before any is added: ids without room would all go through too few buckets.
                if n_ids <= self.cells * self.ids_per_bucket:
                    for name, ids in lacking.items():
                        self.add(name, ids)
                    return
        self._rebuild(number, written)

    def _rebuild(self, number: int, written: set[str]) -> None:
        ids = stage(self._ids_of(sorted(written)), "ids")
        n_ids, cells, folders = ids.count(), 1, LEAST_FOLDERS
        while cells * self.ids_per_bucket < 2 * n_ids:
            cells *= 2
        while folders * IDS_PER_FOLDER < 2 * n_ids:
            folders *= 2
        generation = {
            "name": uuid.uuid4().hex,
            "cells": cells,
            "buckets": min(cells, folders),
            "words": max(1, self.ids_per_bucket // IDS_PER_WORD),
            "base": sorted(written),
            "n_ids": n_ids,
        }
        past = self.ledger.latest()[1]
        self._use(generation)
        self._write(BASE, ids)
        if not self.ledger.put(number + 1, generation):
            raise parts.Conflict(self.path)
        if past is not None and number > 1:
            files.delete(self.spark, f"{self.path}/{self.ledger.read(number - 1)['name']}")

    def _use(self, generation: dict) -> None:
        self.root = f"{self.path}/{generation['name']}"
        self.cells, self.buckets, self.words = (generation[k] for k in ("cells", "buckets", "words"))

    def _covered(self) -> str:
        return f"{self.root}/_covered"

    def _ids_of(self, names: list[str]) -> DataFrame:
        """Ids of batches of the tables."""
        folders = []
        for table in self.tables:
            own = set(parts.batches(self.spark, table))
            folders.append([f"{table}/{parts.BATCH}={n}" for n in names if n in own])
        schema = f"{self.key} string"
        found = [self.spark.read.schema(schema).parquet(*some) for some in folders if some]
        none = self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, found, none)

    # ---- buckets and filters -------------------------------------------------------------------

    def _cell(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.cells)).cast("int")

    def _bucket(self) -> Column:
        return F.floor(self._cell() / F.lit(self.cells // self.buckets)).cast("int")

    def _word(self) -> Column:
        return F.pmod(F.xxhash64(self.key, F.lit(1)), F.lit(self.words)).cast("int")

    def _mask(self) -> Column:
        """The bits of an id in its word; several may fall together."""
        digest = F.xxhash64(self.key, F.lit(2))
        bits = (F.shiftrightunsigned(digest, 6 * i).bitwiseAND(F.lit(63)) for i in range(BITS_OF_AN_ID))
        ones = (F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int")) for bit in bits)
        return reduce(Column.bitwiseOR, ones)

    def add(self, batch: str, ids: DataFrame) -> None:
        """Add the ids of a batch; the folders it has already are replaced."""
        self._write(batch, ids)
        # Told last: a batch that is not covered is added again.
        files.write_once(self.spark, f"{self._covered()}/{batch}", ids.count())

    def _write(self, batch: str, ids: DataFrame) -> None:
        dealt = ids.select(
            self.key, self._bucket().alias("bucket"), F.lit(batch).alias("batch"), self._cell().alias("cell")
        )
        words = dealt.groupBy("bucket", "batch", "cell", self._word().alias("word")).agg(
            F.bit_or(self._mask()).alias("mask")
        )
        for kind, rows in (("ids", dealt.select("bucket", "batch", "cell", self.key)), ("filters", words)):
            # Rebalanced by bucket: few files in a folder, and no task with more than its share.
            placed = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "batch", "cell")
            writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("bucket", "batch").parquet(f"{self.root}/{kind}")

    def _read(self, kind: str, buckets: list[int]) -> DataFrame:
        schema = {"ids": f"cell int, {self.key} string", "filters": "cell int, word int, mask long"}[kind]
        held = set(files.names(self.spark, f"{self.root}/{kind}"))
        folders = [f"{self.root}/{kind}/bucket={b}" for b in buckets if f"bucket={b}" in held]
        schema = f"{schema}, bucket int, batch string"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(*folders)

    # ---- looking up ----------------------------------------------------------------------------

    def _picked(self, ids: DataFrame) -> Column:
        """Whether a row of the index is in a cell of the ids, if these are in a few cells of large buckets."""
        if self.cells == self.buckets:
            return F.lit(True)
        cells = ids.select(self._cell()).distinct().limit(MOST_PICKED + 1).collect()
        # Not isin: of more than ten values that would look for those between the least and the largest.
        return F.lit(True) if len(cells) > MOST_PICKED else reduce(
            Column.__or__, [F.col("cell") == r[0] for r in cells], F.lit(False)
        )

    def folders_with(self, ids: DataFrame, own: str) -> list[tuple[int, str]]:
        """(bucket, batch) of the folders that may hold some of the ids, by their filters.

        Brings as many rows as there are folders in the buckets of the ids, at most.
        """
        touched = [r["bucket"] for r in ids.select(self._bucket().alias("bucket")).distinct().collect()]
        filters = self._read("filters", sorted(touched)).where(F.col("batch") != own)
        probes = ids.select(
            self._cell().alias("cell"), self._word().alias("word"), self._mask().alias("bits")
        ).distinct()
        hits = filters.where(self._picked(ids)).join(probes, ["cell", "word"])
        hits = hits.where(F.col("mask").bitwiseAND(F.col("bits")) == F.col("bits"))
        return sorted((r["bucket"], r["batch"]) for r in hits.select("bucket", "batch").distinct().collect())

    def candidates(self, ids: DataFrame, own: str) -> DataFrame:
        """All of the given ids that the tables hold, own batch apart, and others besides."""
        folders = [f"{self.root}/ids/bucket={b}/batch={name}" for b, name in self.folders_with(ids, own)]
        known = self._ids_of(self.loose)
        if folders:
            stored = self.spark.read.schema(f"cell int, {self.key} string").parquet(*folders)
            known = known.unionByName(stored.where(self._picked(ids)).select(self.key))
        return known
