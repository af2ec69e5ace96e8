"""Tables that change in whole sets of files, while readers see either all of a change or none.

A ledger beside the files names the current ones. A reader looks it up once and then reads the files it
names, which stay until the change after the next one.
"""

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillgrain.sources import files
from tillgrain.sources.files import Ledger

BATCH = "batch_id"  # the folder of a batch below a table; not a column of the table
SET = "set-"  # how the batch that replaces all others is named; visible while it is the current one
PART_SET = "part_set"
PART = "part"  # a column that only says which part a row is in; not a column of the table


class Conflict(RuntimeError):
    """Somebody else has changed the table meanwhile; nothing was changed."""


class Versions:
    """The ledger of a table. An entry names a set that replaces batches, or the parts of the table, and
    the folders that were current before it, which the next entry deletes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ledger = Ledger(spark, f"{path}/_versions")
        self.number, entry = self.ledger.latest()
        empty = {"set": None, "retired": [], "parts": {}, "state": None, "past": []}
        self.entry: dict[str, Any] = entry or empty

    def publish(self, new_folder: str, past: list[str], **entry: Any) -> None:
        """Make an entry the current one; raises Conflict, and takes the new folder away, if there has
        been another one since this object looked."""
        content = {"set": None, "retired": [], "parts": {}, "state": None, "past": past} | entry
        if not self.ledger.put(self.number + 1, content):
            files.delete(self.spark, f"{self.path}/{new_folder}")
            raise Conflict(self.path)
        for folder in self.entry["past"]:
            files.delete(self.spark, f"{self.path}/{folder}")

    def folders(self) -> list[str] | None:
        """The folders that the table consists of; None if none was ever replaced or is about to be, so
        that all that is there belongs to it."""
        if self.entry["parts"]:
            return list(self.entry["parts"].values())
        named = self._named()
        if not self.number and not any(n.startswith(SET) for n in named):
            return None
        return [f"{BATCH}={n}" for n in self._visible(named)]

    def batches(self) -> list[str]:
        """Names of the batches that belong to the table."""
        return [] if self.entry["parts"] else self._visible(self._named())

    def _named(self) -> list[str]:
        prefix = f"{BATCH}="
        found = files.names(self.spark, self.path)
        return [n.removeprefix(prefix) for n in found if n.startswith(prefix)]

    def _visible(self, named: list[str]) -> list[str]:
        hidden = set(self.entry["retired"])
        return [n for n in named if n == self.entry["set"] or not (n.startswith(SET) or n in hidden)]


def batches(spark: SparkSession, path: str) -> list[str]:
    return Versions(spark, path).batches()


def replace_all(df: DataFrame, path: str) -> None:
    """Replace all that a table has now by the rows of df.

    Batches that others add while this runs stay. Raises Conflict if another replacement came first.
    """
    versions = Versions(df.sparkSession, path)
    replaced = versions.batches()
    past = [f"{BATCH}={n}" for n in replaced] + list(versions.entry["parts"].values())
    name = f"{SET}{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{BATCH}={name}")
    # Names stay listed when their folders have gone, so that no batch ever comes back.
    retired = {n for n in replaced if not n.startswith(SET)} | set(versions.entry["retired"])
    versions.publish(f"{BATCH}={name}", past, set=name, retired=sorted(retired))


class Parts:
    """A table in parts by the value of one column. An update replaces some of them, and the state that
    says what the table is made of, at once; the files of all other parts stay as they are."""

    def __init__(self, spark: SparkSession, path: str, column: str, schema: T.StructType):
        self.spark, self.path, self.column, self.schema = spark, path, column, schema
        self.refresh()

    def refresh(self) -> None:
        self.versions = Versions(self.spark, self.path)
        self.parts: dict[str, str] = self.versions.entry["parts"]
        self.state: Any = self.versions.entry["state"]

    def read(self, values: list[str] | None = None) -> DataFrame:
        """Rows of the parts with these values, by default of all parts."""
        wanted = self.parts if values is None else [v for v in values if v in self.parts]
        folders = [f"{self.path}/{self.parts[v]}" for v in wanted]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        stored = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)
        return stored.select(*self.schema.names)

    def replace(self, df: DataFrame | list[DataFrame], values: list[str], state: Any) -> None:
        """Replace the parts with these values by the rows of df, which have no other values. Several
        frames are written one after the other, and become current together.

        Raises Conflict if the table was changed since this object looked it up.
        """
        folder, prefix = f"{PART_SET}={uuid.uuid4().hex}", f"{self.column}="
        for rows in df if isinstance(df, list) else [df]:
            rows.write.mode("append").partitionBy(self.column).parquet(f"{self.path}/{folder}")
        written = files.names(self.spark, f"{self.path}/{folder}")
        replaced = set(values)
        parts = {v: f for v, f in self.parts.items() if v not in replaced}
        past = [f for v, f in self.parts.items() if v in replaced]
        past += [f"{BATCH}={n}" for n in self.versions.batches()]
        parts |= {n.removeprefix(prefix): f"{folder}/{n}" for n in written if n.startswith(prefix)}
        retired = [n for n in self.versions.batches() if not n.startswith(SET)] + self.versions.entry["retired"]
        self.versions.publish(folder, past, parts=parts, state=state, retired=sorted(retired))
        self.refresh()
