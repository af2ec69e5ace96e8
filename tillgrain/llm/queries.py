"""The operators applied to their whole tables, with production parameters."""

import os
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.llm import alignment, bpe, decontaminate, html, langid, licenses, lm, phrases, quality, secrets, sharding, simhash, urls
from tillgrain.llm.common import by_crc, table
from tillgrain.llm.oracle import ORACLE  # noqa: F401


def tokenizer_path(
    spark: SparkSession, setting: str = "tillgrain.tokenizer", usual: str = "word_bpe_49k.json"
) -> str:
    """The tokenizer file: the one that the session's setting names, or an installed vocabulary."""
    named = spark.conf.get(setting, None)
    if named:
        return named
    folder = os.path.dirname(find_spec("public_tokenizers").origin)
    return os.path.join(folder, usual)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(documents(spark, sf_dir))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.digests(documents(spark, sf_dir))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan_licenses(documents(spark, sf_dir), keep=["doc_id"])
    return scanned.drop("matches")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(documents(spark, sf_dir), keep=["doc_id"])
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, "base_failed", "kept")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontaminate.decontaminate(documents(spark, sf_dir), items, keep=["doc_id"])
    return found.drop("spans", "items")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"), ["page_id", "url"])


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(by_crc(F.col("doc_id"), 3) == 1, F.lit(False))
    model = langid.learn(docs.where(~held_out))
    predicted = langid.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(documents(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), tokenizer_path(spark), keep=["doc_id"])


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digests(documents(spark, sf_dir))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digests(table(spark, sf_dir, "documents", "text", "lang"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = tokenizer_path(spark, "tillgrain.tokenizer_a", "byte_bpe_50k.json")
    b = tokenizer_path(spark, "tillgrain.tokenizer_b", "piece_bpe_32k.model")
    return alignment.digests(documents(spark, sf_dir), a, b, keep=["doc_id"])


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages", "page_id", "url"), keep=["page_id"])


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_lm": op2_lm,
    "op3_licenses": op3_licenses,
    "op4_quality": op4_quality,
    "op5_decontaminate": op5_decontaminate,
    "op6_html": op6_html,
    "op7_langid": op7_langid,
    "op8_secrets": op8_secrets,
    "op9_bpe": op9_bpe,
    "op10_sharding": op10_sharding,
    "op11_phrases": op11_phrases,
    "op12_alignment": op12_alignment,
    "op13_urls": op13_urls,
}

