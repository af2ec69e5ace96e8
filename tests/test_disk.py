"""What the batches of a lake leave on disk on their way: shuffle files, drops, exchanges."""

import os
import time
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tests.test_versions import CUSTOMERS, bronze_row, compare_gold, silver_batch
from tillgrain import schemas, session
from tillgrain.operators import silver
from tillgrain.plans import catalog, flow, incremental
from tillgrain.session import RELEASE, releasing, shared_folder
from tillgrain.sources import lake, parts
from tillgrain.sources.parts import Parts
from tillgrain.streaming import ingest


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in blocks.mkString(" ").split() if name.startswith("shuffle_")}


def left_after(spark, job):
    """Shuffle files that a job leaves; they are taken away aside from it."""
    before = shuffle_files(spark)
    job()
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


@pytest.fixture
def lake_of_rows(spark, tmp_path):
    tables = flow.Lake(str(tmp_path))
    (tmp_path / "customers.csv").write_text(CUSTOMERS)
    for i in range(2):
        rows = [
            bronze_row(f"{i}-{k}", 0.5 * k, f"2026-01-0{1 + k % 2}", f"CUST00000{k % 5}", f"C{k % 3}")
            for k in range(40)
        ]
        silver_batch(spark, tables, f"b{i}", *rows)
    return tables


@contextmanager
def uncoalesced(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name)


def update(spark, tables):
    incremental.update_gold(spark, f"{tables.root}/customers.csv", tables, buckets=2)


def test_an_update_of_gold_leaves_no_shuffle_files(spark, lake_of_rows):
    assert not left_after(spark, lambda: update(spark, lake_of_rows))
    compare_gold(spark, lake_of_rows)


def test_a_batch_of_silver_leaves_no_shuffle_files(spark, tmp_path):
    path = lambda name: str(tmp_path / name)

    def run(name, *rows):
        lake.write_batch(lake.rows(spark, list(rows), schemas.BRONZE_TRANSACTIONS), path("bronze"), name)
        ingest.stream_silver(spark, path("bronze"), path("clean"), path("bad"), path("c")).awaitTermination()

    assert not left_after(spark, lambda: run("0", bronze_row("a"), bronze_row(None), bronze_row("x", -1.0)))
    again = [bronze_row(k) for k in ("a", "b", "b", None, None, "x")]
    assert not left_after(spark, lambda: run("1", *again))
    assert sorted(str(r[0]) for r in lake.read_table(spark, path("clean")).collect()) == ["None", "a", "b"]
    assert [r[0] for r in lake.read_table(spark, path("bad")).collect()] == ["x"]


def test_a_null_id_that_is_new_is_kept_beside_replays(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    for i, keys in enumerate((["a", "c"], ["a", None, None, "b"])):
        rows = lake.rows(spark, [bronze_row(k) for k in keys], schemas.BRONZE_TRANSACTIONS)
        lake.write_batch(rows, path("bronze"), str(i))
        ingest.stream_silver(spark, path("bronze"), path("clean"), path("bad"), path("c")).awaitTermination()
    assert sorted(str(r[0]) for r in lake.read_table(spark, path("clean")).collect()) == ["None", "a", "b", "c"]


def test_releasing_restores_the_setting(spark):
    before = spark.conf.get(RELEASE, None)
    first, second = releasing(spark), releasing(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(RELEASE) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(RELEASE, None) == before


def test_parts_are_merged_with_one_exchange_in_pieces(spark, lake_of_rows, monkeypatch):
    monkeypatch.setattr(incremental, "ROWS_PER_PIECE", 4)
    # Else the few rows of this test are all written by one task.
    monkeypatch.setattr(incremental, "releasing", uncoalesced)
    plans, real = {}, Parts.replace

    def seen(self, df, values, state):
        for rows in df if isinstance(df, list) else [df]:
            plans.setdefault(self.path, []).append(rows._jdf.queryExecution().executedPlan().toString())
        return real(self, df, values, state)

    monkeypatch.setattr(Parts, "replace", seen)
    update(spark, lake_of_rows)
    silver_batch(spark, lake_of_rows, "late", bronze_row("late", 2.0, "2026-01-01", "CUST000001", "C1"))
    update(spark, lake_of_rows)
    compare_gold(spark, lake_of_rows)
    for path in (lake_of_rows.purchases, lake_of_rows.customer_purchases):
        assert all(plan.count("Exchange") == 1 for plan in plans[path]), plans[path]
    days = Parts(spark, lake_of_rows.purchases, parts.PART, incremental.PURCHASES)
    written = os.listdir(f"{days.path}/{days.parts['2026-01-01']}")
    assert sum(f.endswith(".parquet") for f in written) > 1


def test_jobs_go_in_rounds_with_the_same_results(spark, tmp_path, monkeypatch):
    """A large day, a large customer, replays and null ids, at most seven rows at once."""
    monkeypatch.setattr(session, "ROWS_AT_ONCE", 7)
    monkeypatch.setattr(incremental, "ROWS_PER_PIECE", 3)
    written, real = [], Parts.replace
    monkeypatch.setattr(Parts, "replace", lambda s, df, *a: (written.append((s.path, df)), real(s, df, *a))[1])
    tables = flow.Lake(str(tmp_path))
    (tmp_path / "customers.csv").write_text(CUSTOMERS)
    raw = [
        bronze_row(f"{k}", 0.5 * k, "2026-01-01" if k % 3 else f"2026-02-0{1 + k % 4}", f"CUST00000{k % 4 or 1}", f"C{k % 9}")
        for k in range(60)
    ]
    raw += [bronze_row(None), bronze_row("bad", -1.0)]
    for i, rows in enumerate((raw[:35], [*raw[20:], *raw[:5], bronze_row(None)])):
        lake.write_batch(lake.rows(spark, rows, schemas.BRONZE_TRANSACTIONS), tables.bronze, str(i))
        ingest.stream_silver(
            spark, tables.bronze, tables.silver, tables.quarantine, str(tmp_path / "c")
        ).awaitTermination()
        update(spark, tables)
        compare_gold(spark, tables)
    clean, bad = silver.clean_transactions(lake.rows(spark, raw, schemas.BRONZE_TRANSACTIONS))
    for path, want in ((tables.silver, clean), (tables.quarantine, bad)):
        got = lake.read_table(spark, path)
        rows = lambda df: sorted(map(tuple, df.select(*want.columns).collect()), key=repr)
        assert rows(got) == rows(want)
    for path in (tables.purchases, tables.customer_purchases):
        assert all(len(df) > 1 for p, df in written if p == path)


def test_a_drop_is_not_kept_beside_bronze(spark, tmp_path):
    tables = flow.Lake(str(tmp_path))
    days = [f"{1992 + k % 6}-05-01" if k % 7 else "not-a-date" for k in range(120)]
    raw = [bronze_row(f"{k % 90}", 1.0 * k, days[k])[: len(schemas.RAW_TRANSACTIONS)] for k in range(120)]
    rows = lake.rows(spark, raw, schemas.RAW_TRANSACTIONS)
    root = shared_folder(spark).removeprefix("file:")
    kept = lambda: {
        os.path.relpath(d, root)
        for d, _, names in os.walk(root)
        if any(n.endswith(".parquet") for n in names) and os.path.relpath(d, root).startswith("dealt-")
    }
    before = kept()
    for i in catalog._months_to_bronze(rows, tables):
        assert {d.rpartition("=")[2] for d in kept() - before} <= {str(j) for j in range(i + 1, 3)}
    assert kept() == before
    stored = lake.read_table(spark, tables.bronze).select(*schemas.RAW_TRANSACTIONS.names)
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(raw, key=repr)
    drops = lake.read_table(spark, tables.bronze).groupBy("transaction_id").agg(F.countDistinct("_source_file"))
    assert {r[1] for r in drops.collect()} == {1}  # copies come together
    assert silver.dedup_transactions(stored).count() == 90
