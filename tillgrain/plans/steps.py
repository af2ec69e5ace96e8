"""What a run has done already, so that one that failed goes on where it stopped.

A run is known by the files it was started on. Each step leaves an entry with a fingerprint of what it
read and a note of what it made. A run that is started again on the same files, after one that did not
get to its end, takes a step as done if its entry is there and what it reads is still the same: a step
that is repeated makes new files, so all steps after it are repeated too. Gates are not steps; they are
asked again every time.
"""

import hashlib
import json
from typing import Any

from pyspark.sql import SparkSession

from tillgrain.sources import files, parts
from tillgrain.sources.files import Ledger


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of the files at or below a path."""
    system, target = files.file_system(spark, path)
    if not system.exists(target):
        return []
    found, listing = [], system.listFiles(target, True)
    while listing.hasNext():
        entry = listing.next()
        found.append((entry.getPath().toUri().getPath(), entry.getLen(), entry.getModificationTime()))
    return sorted(found)


def version_of(spark: SparkSession, path: str) -> list:
    """What a lake table consists of now."""
    versions = parts.Versions(spark, path)
    return [versions.number, versions.folders() or versions.batches()]


def fingerprint(*described: Any) -> str:
    return hashlib.sha256(json.dumps(described).encode()).hexdigest()


class Steps:
    """The entries of one run below a folder."""

    def __init__(self, spark: SparkSession, folder: str, started_on: str):
        self.spark, runs = spark, Ledger(spark, f"{folder}/runs")
        number, last = runs.latest()
        if last != started_on or files.exists(spark, f"{folder}/{number}/complete"):
            number = runs.claim(started_on)
        self.number, self.folder = number, f"{folder}/{number}"

    def made(self, step: str, read: str) -> Any:
        """What the step has made of what it reads now; None if it is to be done."""
        path = f"{self.folder}/{step}-{read}"
        return files.read(self.spark, path) if files.exists(self.spark, path) else None

    def note(self, step: str, read: str, made: Any) -> None:
        files.write_once(self.spark, f"{self.folder}/{step}-{read}", made)

    def complete(self) -> None:
        files.write_once(self.spark, f"{self.folder}/complete", True)
