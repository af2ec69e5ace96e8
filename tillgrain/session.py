"""Session settings and the shared folder in which long plans are cut."""

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "tillgrain", **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local session without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="tillgrain-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


class _Scopes(threading.local):
    """Scopes of one thread: what another one stages, a stream's batch say, is not its to delete."""

    def __init__(self) -> None:
        self.open: list[list[str]] = []


_scopes = _Scopes()


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes.open:
        _scopes.open[-1].append(path)
    return path


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was staged within it; nothing that reads on may be left by then."""
    _scopes.open.append([])
    try:
        yield
    finally:
        for path in _scopes.open.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_release_lock = threading.Lock()
_releasing: Counter[str] = Counter()
_set_before: dict[str, str | None] = {}


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Every job within deletes its shuffle files when it ends; else they stay until the driver happens to
    collect its garbage, and a chain of jobs has the files of all of them on disk.

    For jobs that run once: a DataFrame that is collected again makes its shuffles again. Scopes of a
    session may overlap, in threads too; the last one to end restores the setting.
    """
    session = spark._jsparkSession.sessionUUID()
    with _release_lock:
        if not _releasing[session]:
            _set_before[session] = spark.conf.get(RELEASE, None)
            spark.conf.set(RELEASE, "true")
        _releasing[session] += 1
    try:
        yield
    finally:
        with _release_lock:
            _releasing[session] -= 1
            if not _releasing[session]:
                del _releasing[session]
                before = _set_before.pop(session)
                spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


# Rows that a job exchanges at once where it may go in rounds, so that its shuffle files have a bound.
ROWS_AT_ONCE = 20_000_000


def rounds_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_AT_ONCE))


def slices(df: DataFrame, key: str, number: int) -> list[DataFrame]:
    """All rows of df, cut by a hash of a column: those of the same value are in the same slice."""
    own = F.pmod(F.xxhash64(key), F.lit(number))
    return [df.where(own == i) for i in range(number)] if number > 1 else [df]


def stage_rounds(frames: list[DataFrame], label: str) -> DataFrame:
    """Stage several frames of the same columns, one after the other, as one."""
    spark = frames[0].sparkSession
    path = scratch_path(spark, label)
    for df in frames:
        with releasing(spark):
            df.write.mode("append").parquet(path)
    return spark.read.schema(frames[0].schema).parquet(path)


def stage(df: DataFrame, label: str, *partition_columns: str) -> DataFrame:
    """Write df to the shared folder and read it back.

    The result survives the loss of executors, is not computed again by later actions, and stays
    columnar, so readers still prune columns and partitions.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_columns).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
