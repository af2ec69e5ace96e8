"""The corpus pipeline: documents through five operators of tillgrain.llm, one stage after the other.

Every stage reads what its predecessor kept, as Parquet in the shared folder, decides over all of it,
and returns the columns of documents (the last one its digests). Nothing is dropped but what a stage
rejects: texts without a language, all documents of a near-duplicate group but the one with the
smallest id, documents with passages of the benchmark. Secrets are masked in the text, the document
stays. Null texts have no language and go in the first stage.
"""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.llm import bpe, decontaminate, langid, secrets, simhash
from tillgrain.llm.common import by_crc, table
from tillgrain.llm.queries import tokenizer_path
from tillgrain.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keeping_columns(function: Stage) -> Stage:
    """The stage with all columns of its input as they were named.

    Columns that documents do not have by themselves are renamed meanwhile, so that none is taken for,
    or replaced by, a result of the operator that has the same name.
    """

    @wraps(function)
    def stage_of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: f"_extra_{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        found = function(spark, docs.withColumnsRenamed(aside), sf_dir)
        return found.withColumnsRenamed({new: old for old, new in aside.items()})

    return stage_of


@keeping_columns
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; learned as in op7, from the documents the CRC does not hold out."""
    held_out = F.coalesce(by_crc(F.col("doc_id"), 3) == 1, F.lit(False))
    model = langid.learn(docs.where(~held_out).select("text", "lang"))
    predicted = langid.predict(docs, model)
    return predicted.where(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


@keeping_columns
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, and of equal ids the smallest text hash.

    A null id counts as larger than all others. Of rows that repeat an id and a text one stays.
    """
    keyed = docs.withColumn("_text_hash", F.xxhash64("text"))
    found = simhash.near_duplicates(keyed.select("doc_id", "text", "_text_hash"), ["_text_hash"])
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "_text_hash")
    first = found.groupBy("root").agg(F.min(order).alias("first"))
    first = first.select(F.col("first.doc_id").alias("_id"), F.col("first._text_hash").alias("_hash"))
    stays = keyed["doc_id"].eqNullSafe(first["_id"]) & (keyed["_text_hash"] == first["_hash"])
    kept = keyed.join(first, stays, "left_semi").dropDuplicates(["doc_id", "_text_hash"])
    return kept.select(*docs.columns)


@keeping_columns
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontaminate.decontaminate(docs, items)
    return found.where(~F.col("contaminated")).select(*docs.columns)


@keeping_columns
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked and n_chars counted anew where the text changed."""
    found = secrets.scan_secrets(docs).withColumn("text", secrets.redact(F.col("text"), F.col("spans")))
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars).select(*docs.columns)


def bpe_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with the number of tokens and the digests of ids and decoded text."""
    return bpe.digests(docs, tokenizer_path(spark), keep=["doc_id"])


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mask_secrets", mask_secrets),
    ("bpe_coding", bpe_coding),
]
# SQL can express neither fingerprints and their components nor BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
