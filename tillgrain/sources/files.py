"""Small files of the driver beside the tables: listing, and numbered entries that are claimed once.

An entry is written aside and then moved to its place, which fails if the place is taken: of several
writers just one gets a number, and no reader sees half an entry. File systems of clusters do this
with a rename, local folders with a link.
"""

import json
import os
import uuid
from typing import Any

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = file_system(spark, path)
    return files.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    files, target = file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    files, target = file_system(spark, path)
    files.delete(target, True)


def write_once(spark: SparkSession, path: str, content: Any) -> bool:
    """Write content as JSON, unless there is a file at the path; whether it was written."""
    files, target = file_system(spark, path)
    if files.exists(target):
        return False
    files.mkdirs(target.getParent())
    aside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = files.create(aside)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    try:
        if files.getUri().getScheme() != "file":
            # False, or an error where the file system says why.
            return files.rename(aside, target) if not files.exists(target) else False
        try:
            os.link(aside.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        except OSError:  # a mount without links
            return files.rename(aside, target) if not files.exists(target) else False
        return True
    finally:
        files.delete(aside, False)


def read(spark: SparkSession, path: str) -> Any:
    files, target = file_system(spark, path)
    stream = files.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


class Ledger:
    """Numbered entries in a folder, from 1 on, each written once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:010d}"

    def numbers(self) -> list[int]:
        return [int(name) for name in names(self.spark, self.folder) if name.isdigit()]

    def claim(self, content: Any, at_least: int = 1) -> int:
        """Write the next entry and return its number, which nobody else has."""
        number = max([at_least - 1, *self.numbers()]) + 1
        while not write_once(self.spark, self._path(number), content):
            number += 1
        return number

    def put(self, number: int, content: Any) -> bool:
        """Write the entry of a number, unless it is there; whether it was written."""
        return write_once(self.spark, self._path(number), content)

    def read(self, number: int) -> Any:
        return read(self.spark, self._path(number))

    def latest(self) -> tuple[int, Any]:
        """The last entry with its number; (0, None) if there is none."""
        taken = self.numbers()
        return (taken[-1], self.read(taken[-1])) if taken else (0, None)
