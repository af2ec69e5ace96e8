import json
import os

import pytest

from tillgrain import schemas
from tillgrain.operators import bronze
from tillgrain.sources import feed, lake, logs

HEADER = ",".join(schemas.RAW_TRANSACTIONS.names)


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


GOOD = "t1,CUST000001,Books,2,5.0,10.0,upi,2026-01-01T00:00:00"


def test_bronze_keeps_rows_as_received_with_lineage(spark, tmp_path):
    drop(tmp_path / "raw", "a.csv", GOOD, "t2,,Books,N/A,x,10.0,upi,soon")
    bronze.ingest(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), ingested_at="now")
    rows = lake.read_table(spark, str(tmp_path / "bronze")).orderBy("transaction_id").collect()
    assert rows[1]["customer_id"] is None
    assert rows[1]["quantity"] == "N/A"
    assert rows[1]["unit_price"] is None  # a malformed number is NULL, the row is kept
    assert {r["_ingested_at"] for r in rows} == {"now"}
    assert all(r["_source_file"].endswith("/raw/a.csv") for r in rows)


def test_append_stores_a_replay_twice_unless_seen_files_are_skipped(spark, tmp_path):
    raw, stored = tmp_path / "raw drop", str(tmp_path / "bronze")
    drop(raw, "a.csv", GOOD)
    for _ in range(2):
        bronze.ingest(spark, str(raw), stored)
    assert lake.read_table(spark, stored).count() == 2
    drop(raw, "b c.csv", GOOD.replace("t1", "t2"))
    for _ in range(2):
        bronze.ingest(spark, str(raw), stored, skip_seen_files=True)
    ids = [r["transaction_id"] for r in lake.read_table(spark, stored).collect()]
    assert sorted(ids) == ["t1", "t1", "t2"]


def test_missing_table_and_missing_format(spark, tmp_path):
    with pytest.raises(lake.TableMissing):
        lake.read_table(spark, str(tmp_path / "nothing"))
    with pytest.raises(Exception, match="(?i)delta"):
        lake.overwrite_table(spark.range(1), str(tmp_path / "t"), "delta")


def test_gold_views(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "category_sales"))
    spark.range(4).write.parquet(str(tmp_path / "customer_features"))
    lake.register_gold_views(spark, str(tmp_path))
    assert spark.sql("SELECT count(*) FROM customer_features").first()[0] == 4


def test_rows_with_an_all_null_column(spark):
    assert lake.rows(spark, [(1, None)], "a int, b string").dtypes == [("a", "int"), ("b", "string")]


def test_log_leaves_absent_keys_out_and_reads_them_as_null(spark, tmp_path):
    path = str(tmp_path / "log")
    full = ("2026-01-01T00:00:00+00:00", 0.95, 10, 9, 0.9, 1, True, 1.5, None)
    short = ("2026-01-02T00:00:00+00:00", 0.6, 10, 6, None, None, None, None, "quality_gate")
    for record in (full, short):
        logs.append_log(lake.rows(spark, [record], schemas.METRICS_HISTORY).coalesce(1), path)
    lines = [
        json.loads(line)
        for name in sorted(os.listdir(path))
        if name.endswith(".json")
        for line in open(f"{path}/{name}")
    ]
    assert len(lines) == 2
    assert sorted("model_roc_auc" in line for line in lines) == [False, True]
    read = logs.read_log(spark, path, schemas.METRICS_HISTORY).orderBy("timestamp").collect()
    assert [r["model_roc_auc"] for r in read] == [0.9, None]
    assert str(read[0]["timestamp"])[:10] == "2026-01-01"


def test_log_of_jsonl_file_with_blank_lines(spark, tmp_path):
    (tmp_path / "h.jsonl").write_text('{"timestamp": "2026-08-09T20:13:24.122583+00:00"}\n\n')
    read = logs.read_log(spark, str(tmp_path / "h.jsonl"), schemas.METRICS_HISTORY)
    assert [str(r["timestamp"]) for r in read.collect()] == ["2026-08-09 20:13:24.122583"]


def test_missing_or_empty_log_is_empty(spark, tmp_path):
    assert logs.read_log(spark, str(tmp_path / "no"), schemas.QUERY_LOG).count() == 0
    (tmp_path / "empty.jsonl").write_text("")
    assert logs.read_log(spark, str(tmp_path / "empty.jsonl"), schemas.QUERY_LOG).count() == 0


def test_dirt_breaks_about_the_fraction_in_five_ways(spark):
    clean = lake.rows(
        spark,
        [(f"t{i}", "CUST000001", "Books", "1", 5.0, 5.0, "upi", "2026-01-01") for i in range(4000)],
        schemas.RAW_TRANSACTIONS,
    )
    dirty = feed.with_dirt(clean, 0.25)
    broken = {
        "category": dirty.where("product_category IS NULL").count(),
        "amount": dirty.where("transaction_amount < 0").count(),
        "customer": dirty.where("customer_id IS NULL").count(),
        "quantity": dirty.where("quantity = 'N/A'").count(),
        "copies": dirty.count() - 4000,
    }
    assert all(140 < n < 260 for n in broken.values()), broken


def test_shuffled_is_a_permutation_and_repeatable(spark):
    rows = spark.range(100).selectExpr("string(id) AS k")
    first = [r["k"] for r in feed.shuffled(rows, "k").collect()]
    assert first == [r["k"] for r in feed.shuffled(rows.repartition(9), "k").collect()]
    assert first != sorted(first, key=int) and set(first) == {str(i) for i in range(100)}


def test_long_customer_keys_are_not_cut(spark):
    from pyspark.sql import functions as F

    codes = spark.range(1).select(
        feed.customer_code(F.lit(7)).alias("a"), feed.customer_code(F.lit(12345678)).alias("b")
    )
    assert tuple(codes.first()) == ("CUST000007", "CUST12345678")
