"""Ledgers, tables replaced at once, the index of ids, incremental Gold."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from tillgrain import schemas
from tillgrain.operators import bronze, gold, silver
from tillgrain.plans import flow, incremental
from tillgrain.sources import files, id_index, lake, parts
from tillgrain.sources.files import Ledger
from tillgrain.sources.id_index import IdIndex
from tillgrain.sources.parts import Conflict, Parts
from tillgrain.streaming import ingest


def ids_of(df):
    return sorted(r[0] for r in df.select(df.columns[0]).collect())


# ---- ledgers


def test_an_entry_is_written_once_and_numbers_are_claimed_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.latest() == (0, None) and ledger.claim("a") == 1 and ledger.claim({"b": [1, None]}) == 2
    assert not ledger.put(2, "other") and ledger.latest() == (2, {"b": [1, None]})
    assert ledger.put(7, "c") and ledger.claim("d") == 8 and ledger.claim("e", at_least=20) == 20
    assert ledger.numbers() == [1, 2, 7, 8, 20] and ledger.read(1) == "a"
    assert not [n for n in os.listdir(tmp_path / "ledger") if n.startswith(".") and not n.endswith(".crc")]


def test_claims_at_the_same_time_are_all_different(spark, tmp_path):
    ledger, got = Ledger(spark, str(tmp_path / "ledger")), []
    threads = [threading.Thread(target=lambda: got.extend(ledger.claim(i) for i in range(5))) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == list(range(1, 31))


# ---- tables replaced at once


def test_a_reader_sees_one_set_before_while_and_after_a_table_is_replaced(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    lake.write_batch(spark.range(3).coalesce(1), path, "a")
    lake.write_batch(spark.range(3, 5).coalesce(1), path, "b")
    early = lake.read_table(spark, path)
    seen, publish = [], parts.Versions.publish

    def between(self, *args, **kwargs):
        seen.append(ids_of(lake.read_table(spark, path)))  # the new rows are written, nothing else is done
        publish(self, *args, **kwargs)
        seen.append(ids_of(lake.read_table(spark, path)))

    monkeypatch.setattr(parts.Versions, "publish", between)
    lake.overwrite_table(spark.range(10, 12), path)
    assert seen == [[0, 1, 2, 3, 4], [10, 11]]
    assert ids_of(early) == [0, 1, 2, 3, 4]  # what was looked up before can still be read
    lake.overwrite_table(spark.range(20, 21), path)
    assert seen[2:] == [[10, 11], [20]]
    assert sorted(n for n in os.listdir(path) if n.startswith("batch_id=")) == sorted(
        f"batch_id={n}" for n in {parts.batches(spark, path)[0], *[files.read(spark, f"{path}/_versions/0000000001")["set"]]}
    )


def test_a_job_that_dies_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    lake.overwrite_table(spark.range(3), path)
    monkeypatch.setattr(parts.Versions, "publish", lambda *a, **k: (_ for _ in ()).throw(KeyError()))
    with pytest.raises(KeyError):
        lake.overwrite_table(spark.range(9), path)
    monkeypatch.undo()
    assert ids_of(lake.read_table(spark, path)) == [0, 1, 2]
    lake.overwrite_table(spark.range(1), path)
    assert ids_of(lake.read_table(spark, path)) == [0]


def test_of_two_replacements_one_is_refused_and_batches_added_meanwhile_stay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    lake.write_batch(spark.range(2), path, "old")
    publish = parts.Versions.publish

    def late(self, *args, **kwargs):
        monkeypatch.setattr(parts.Versions, "publish", publish)
        lake.write_batch(spark.range(7, 8), path, "meanwhile")
        lake.overwrite_table(spark.range(5, 6), path)
        publish(self, *args, **kwargs)

    monkeypatch.setattr(parts.Versions, "publish", late)
    with pytest.raises(Conflict):
        lake.overwrite_table(spark.range(9), path)
    assert ids_of(lake.read_table(spark, path)) == [5]  # the inner one has seen "meanwhile" and replaced it
    lake.write_batch(spark.range(3, 4), path, "later")
    assert ids_of(lake.read_table(spark, path)) == [3, 5]
    lake.write_batch(spark.range(2), path, "old")  # a retry of what was replaced does not come back
    assert ids_of(lake.read_table(spark, path)) == [3, 5]


def test_parts_are_replaced_one_by_one(spark, tmp_path):
    schema = "k int, v string"
    path = str(tmp_path / "t")
    table = Parts(spark, path, "k", spark.createDataFrame([], schema).schema)
    assert table.read().count() == 0
    table.replace(spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], schema), ["1", "2"], "first")
    one = table.parts["1"]
    other = Parts(spark, path, "k", table.schema)
    table.replace(spark.createDataFrame([(2, "d"), (3, "e")], schema), ["2", "3"], ["second"])
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "d"), (3, "e")]
    assert table.state == ["second"] and table.parts["1"] == one
    assert [tuple(r) for r in table.read(["2", "9"]).collect()] == [(2, "d")]
    with pytest.raises(Conflict):
        other.replace(spark.createDataFrame([(1, "z")], schema), ["1"], "third")
    assert sorted(r["v"] for r in lake.read_table(spark, path).collect()) == ["a", "d", "e"]
    table.replace(spark.createDataFrame([], schema), ["1"], "fourth")
    assert sorted(table.parts) == ["2", "3"]
    lake.overwrite_table(spark.createDataFrame([(8, "x")], schema), path)
    assert [r["v"] for r in lake.read_table(spark, path).collect()] == ["x"]
    again = Parts(spark, path, "k", table.schema)
    assert again.parts == {} and again.state is None
    again.replace(spark.createDataFrame([(5, "y")], schema), ["5"], "fifth")
    assert [r["v"] for r in lake.read_table(spark, path).collect()] == ["y"]


# ---- the index of ids


def key_frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "transaction_id string")


def index_of(spark, tmp_path, **bounds):
    tables = [str(tmp_path / "clean"), str(tmp_path / "bad")]
    return IdIndex(spark, tables, str(tmp_path / "ids"), "transaction_id", "stream-", **bounds)


def known(index, keys, own="stream-x-9"):
    index.refresh(own)
    asked = key_frame(index.spark, keys)
    found = {r[0] for r in index.candidates(asked, own).collect()}
    return {k for k in keys if k in found}


def test_index_knows_the_ids_of_all_batches_but_the_own_one(spark, tmp_path):
    index = index_of(spark, tmp_path, ids_per_bucket=40, most_folders=3)
    assert known(index, ["a", None]) == set()
    for i in range(6):
        keys = [f"k{i}-{j}" for j in range(30)] + ([None] if i == 2 else [])
        lake.write_batch(key_frame(spark, keys[:20]), str(tmp_path / "clean"), f"stream-x-{i}")
        lake.write_batch(key_frame(spark, keys[20:]), str(tmp_path / "bad"), f"stream-x-{i}")
        if i != 3:  # a batch whose stream ended before it was done
            index.mark_done(f"stream-x-{i}")
        asked = [f"k{i}-0", f"k{i}-29", f"k{i + 1}-0", "k0-7", None]
        assert known(index, asked, f"stream-x-{i + 1}") == {f"k{i}-0", f"k{i}-29", "k0-7"} | ({None} if i > 1 else set())
    assert index.buckets >= 4 and index.loose == ["stream-x-3"]
    assert known(index, ["k3-3", "k4-3"], "stream-x-3") == {"k4-3"}  # what it wrote itself is not known to it


def test_index_is_made_anew_when_the_tables_are_replaced(spark, tmp_path):
    index = index_of(spark, tmp_path)
    for table, keys in (("clean", ["a", "b"]), ("bad", ["c"])):
        lake.write_batch(key_frame(spark, keys), str(tmp_path / table), "stream-x-0")
    index.mark_done("stream-x-0")
    assert known(index, ["a", "c", "d"]) == {"a", "c"}
    lake.overwrite_table(key_frame(spark, ["d"]), str(tmp_path / "clean"))
    lake.overwrite_table(key_frame(spark, []), str(tmp_path / "bad"))
    assert known(index, ["a", "c", "d"]) == {"d"}


def bytes_looked_up(index, keys):
    """Bytes of the filters that a look-up of new ids scans, and of the ids it then reads."""
    index.refresh("stream-x-new")
    asked = key_frame(index.spark, keys)
    buckets = sorted({r[0] for r in asked.select(index._bucket()).collect()})
    scan = index._read("filters", buckets)
    folders = index.folders_with(asked, "stream-x-new")
    size = lambda paths: sum(os.path.getsize(p.removeprefix("file:")) for p in paths)
    found = [f"{index.root}/ids/bucket={b}/batch={n}" for b, n in folders]
    return size(scan.inputFiles()), sum(size(index.spark.read.parquet(f).inputFiles()) for f in found)


def test_what_a_batch_reads_does_not_grow_with_the_history(spark, tmp_path):
    read = {}
    for n in (4_000, 64_000):
        folder = tmp_path / str(n)
        index = index_of(spark, folder, ids_per_bucket=1_000)
        rows = spark.range(n).selectExpr("concat('history-', id) AS transaction_id")
        lake.write_batch(rows, str(folder / "clean"), "stream-x-0")
        lake.write_batch(key_frame(spark, []), str(folder / "bad"), "stream-x-0")
        index.mark_done("stream-x-0")
        read[n] = bytes_looked_up(index, ["new-1", "new-2"])
        whole = sum(os.path.getsize(p.removeprefix("file:")) for p in lake.read_table(spark, str(folder / "clean")).inputFiles())
        assert sum(read[n]) < whole / 3 or n == 4_000
        assert known(index, [f"history-{n - 1}", "new-1"]) == {f"history-{n - 1}"}
    assert sum(read[64_000]) < 1.5 * sum(read[4_000])


def test_filters_keep_a_new_batch_from_reading_ids(spark, tmp_path):
    index = index_of(spark, tmp_path, ids_per_bucket=10_000)
    lake.write_batch(spark.range(20_000).selectExpr("string(id) AS transaction_id"), str(tmp_path / "clean"), "stream-x-0")
    lake.write_batch(key_frame(spark, []), str(tmp_path / "bad"), "stream-x-0")
    index.mark_done("stream-x-0")
    index.refresh("stream-x-1")
    hits = sum(bool(index.folders_with(key_frame(spark, [f"new-{i}"]), "stream-x-1")) for i in range(40))
    assert hits <= 3
    assert index.folders_with(key_frame(spark, ["77"]), "stream-x-1") != []


def test_ids_without_room_do_not_go_through_too_few_buckets(spark, tmp_path, monkeypatch):
    index = index_of(spark, tmp_path, ids_per_bucket=100)
    index.refresh("stream-x-0")  # made of no ids, so one bucket is enough
    assert index.buckets == 1
    lake.write_batch(spark.range(5_000).selectExpr("string(id) AS transaction_id"), str(tmp_path / "clean"), "stream-x-0")
    index.mark_done("stream-x-0")
    added = []
    monkeypatch.setattr(IdIndex, "add", lambda self, batch, ids: added.append((batch, self.buckets)))
    assert known(index, ["77", "new"]) == {"77"}
    assert added == [] and index.buckets >= 100


def test_many_small_buckets_share_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_index, "LEAST_FOLDERS", 4)
    monkeypatch.setattr(id_index, "IDS_PER_FOLDER", 2_000)
    index = index_of(spark, tmp_path, ids_per_bucket=50)
    rows = spark.range(10_000).selectExpr("nullif(string(id), '5') AS transaction_id")
    lake.write_batch(rows, str(tmp_path / "clean"), "stream-x-0")
    index.mark_done("stream-x-0")
    assert known(index, ["77", None, "5", "new"]) == {"77", None}  # in a few cells, named one by one
    folders = [n for n in os.listdir(index.root.removeprefix("file:") + "/ids") if n.startswith("bucket=")]
    assert len(folders) <= 16 and index.cells * 50 >= 2 * 10_000
    asked = [str(i) for i in range(9_000, 11_000)]
    assert known(index, asked) == set(asked[:1_000])
    lake.write_batch(key_frame(spark, asked[1_000:]), str(tmp_path / "clean"), "stream-x-1")
    index.mark_done("stream-x-1")
    assert known(index, [*asked, "12000"]) == set(asked)


def test_a_batch_is_read_once_when_it_is_stored(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def file_of(key):
        read.add(1)
        return f"file-{key[-1]}"

    batch = spark.range(40).select(F.col("id").cast("string").alias("k")).withColumn("_source_file", file_of("k"))
    bronze.store_batch(batch, str(tmp_path / "t"), "b")
    assert read.value == 40
    assert spark.read.parquet(lake.manifest_path(str(tmp_path / "t"))).count() == 10
    none = lake.other_batches(spark, str(tmp_path / "missing"), "", lake.MANIFEST)
    joined = batch.join(none, F.col("_source_file") == F.col("file"), "left_anti")
    assert "SortMergeJoin" not in joined._jdf.queryExecution().toString()


# ---- streams


def bronze_row(key, amount=1.0, day="2026-01-01", customer="CUST000001", category="Toys"):
    return (key, customer, category, "1", amount, amount, "cash", day, "2026-09-01", "f")


def add_bronze(spark, path, name, *rows):
    lake.write_batch(lake.rows(spark, list(rows), schemas.BRONZE_TRANSACTIONS), path, name)


def run_silver(spark, tmp_path, bronze="bronze", checkpoint="c", **bounds):
    path = lambda name: str(tmp_path / name)
    ingest.stream_silver(
        spark, path(bronze), path("clean"), path("bad"), path(checkpoint), **bounds
    ).awaitTermination()


def drop(folder, name, *keys):
    folder.mkdir(exist_ok=True)
    lines = [",".join(schemas.RAW_TRANSACTIONS.names)]
    lines += [f"{k},CUST000001,Books,2,5.0,10.0,upi,2026-01-01T00:00:00" for k in keys]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_two_streams_and_a_lost_checkpoint_keep_every_row(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    for stream, keys in (("one", "ab"), ("two", "cd")):
        drop(tmp_path / stream, "f.csv", *keys)
        ingest.stream_bronze(spark, path(stream), path("bronze"), path(f"c-{stream}")).awaitTermination()
    assert ids_of(lake.read_table(spark, path("bronze"))) == ["a", "b", "c", "d"]
    os.rename(tmp_path / "c-one", tmp_path / "lost")
    os.rename(tmp_path / "one" / "f.csv", tmp_path / "purged.csv")
    drop(tmp_path / "one", "g.csv", "e")
    ingest.stream_bronze(spark, path("one"), path("bronze"), path("c-one")).awaitTermination()
    assert ids_of(lake.read_table(spark, path("bronze"))) == ["a", "b", "c", "d", "e"]
    # A checkpoint that is lost while the files are still there: the manifest knows them.
    os.rename(tmp_path / "c-one", tmp_path / "lost too")
    ingest.stream_bronze(spark, path("one"), path("bronze"), path("c-one")).awaitTermination()
    assert ids_of(lake.read_table(spark, path("bronze"))) == ["a", "b", "c", "d", "e"]


def test_two_silver_streams_and_a_lost_checkpoint_keep_every_id_once(spark, tmp_path):
    clean = str(tmp_path / "clean")
    add_bronze(spark, str(tmp_path / "one"), "0", bronze_row("a"), bronze_row("b"), bronze_row(None))
    add_bronze(spark, str(tmp_path / "two"), "0", bronze_row("b"), bronze_row("c"), bronze_row("x", -1.0))
    run_silver(spark, tmp_path, "one", "c1")
    run_silver(spark, tmp_path, "two", "c2")
    rows = lake.read_table(spark, clean)
    assert sorted(r[0] or "" for r in rows.collect()) == ["", "a", "b", "c"]
    os.rename(tmp_path / "c1", tmp_path / "lost")
    add_bronze(spark, str(tmp_path / "one"), "1", bronze_row("d"), bronze_row("x"), bronze_row(None))
    run_silver(spark, tmp_path, "one", "c1")
    assert sorted(r[0] or "" for r in lake.read_table(spark, clean).collect()) == ["", "a", "b", "c", "d"]
    assert ids_of(lake.read_table(spark, str(tmp_path / "bad"))) == ["x"]


def test_a_batch_that_is_repeated_leaves_the_same_rows(spark, tmp_path, monkeypatch):
    """The stream ends after the clean table, after the quarantine, and after the note that all is done."""
    for step, after in (("write_batch", 1), ("write_batch", 2), ("mark_done", 1)):
        folder = tmp_path / f"{step}{after}"
        add_bronze(spark, str(folder / "bronze"), "0", bronze_row("a"), bronze_row("x", -1.0))
        run_silver(spark, folder)
        add_bronze(spark, str(folder / "bronze"), "1", bronze_row("b"), bronze_row("y", -1.0), bronze_row("a"))
        owner, calls = (lake, []) if step == "write_batch" else (IdIndex, [])
        real = getattr(owner, step)

        def ending(*args, **kwargs):
            real(*args, **kwargs)
            calls.append(1)
            if len(calls) == after:
                raise RuntimeError("lost")

        monkeypatch.setattr(owner, step, ending)
        with pytest.raises(Exception, match="lost"):
            run_silver(spark, folder)
        monkeypatch.undo()
        # Meanwhile another stream goes on, over the half batch.
        add_bronze(spark, str(folder / "other"), "0", bronze_row("c"), bronze_row("a"))
        run_silver(spark, folder, "other", "c2", ids_per_bucket=1)
        run_silver(spark, folder)
        assert ids_of(lake.read_table(spark, str(folder / "clean"))) == ["a", "b", "c"]
        assert ids_of(lake.read_table(spark, str(folder / "bad"))) == ["x", "y"]


# ---- incremental Gold


CUSTOMERS = "customer_id,signup_date,region,age\nCUST000001,2020-01-01,NORTH,30\nCUST000003,2021-01-01,SOUTH,\n"


def compare_gold(spark, tables):
    everything = lake.read_table(spark, tables.silver)
    customers = lake.read_customers(spark, f"{tables.root}/customers.csv")
    for name, want in (
        ("category_sales", gold.category_sales(everything)),
        ("customer_features", gold.customer_features(everything, customers)),
    ):
        got = lake.read_table(spark, f"{tables.gold}/{name}")
        assert set(got.columns) == set(want.columns)
        rows = lambda df: sorted((tuple(r) for r in df.select(*sorted(want.columns)).collect()), key=repr)
        assert rows(got) == rows(want), name


def silver_batch(spark, tables, name, *rows):
    clean, _ = silver.clean_transactions(lake.rows(spark, list(rows), schemas.BRONZE_TRANSACTIONS))
    lake.write_batch(clean, tables.silver, name)


def test_gold_after_each_batch_equals_gold_from_all_of_silver(spark, tmp_path):
    tables = flow.Lake(str(tmp_path))
    (tmp_path / "customers.csv").write_text(CUSTOMERS)
    update = lambda: incremental.update_gold(spark, f"{tables.root}/customers.csv", tables, buckets=4)
    days = Parts(spark, tables.purchases, parts.PART, incremental.PURCHASES)
    batches = [
        [bronze_row(f"a{i}", 1.1 * i, f"2026-01-0{1 + i % 3}", f"CUST00000{i % 4}") for i in range(12)],
        [bronze_row("b1", 5.0, "2026-02-01", "CUST000001"), bronze_row("b2", 2.5, "2026-02-01", "CUST000009", "Books")],
        [bronze_row("c1", 0.01, "2026-01-02", "CUST000001", "Books"), bronze_row("c2", None, "2026-06-01", "CUST000003")],
    ]
    for i, rows in enumerate(batches):
        silver_batch(spark, tables, f"b{i}", *rows)
        update()
        compare_gold(spark, tables)
        before, sales_before = dict(days.parts), _sales(spark, tables).parts
        days.refresh()
        if i == 2:  # a late row for the second of January, and a day in June
            changed = {d for d in days.parts if before.get(d) != days.parts[d]}
            assert changed == {"2026-01-02", "2026-06-01"}
            assert set(days.parts) == {"2026-01-01", "2026-01-02", "2026-01-03", "2026-02-01", "2026-06-01"}
            assert {sales_before[d].split("/")[0] for d in changed} != {sales_before["2026-01-01"].split("/")[0]}
    numbers = days.versions.number, _sales(spark, tables).versions.number
    update()  # nothing new
    days.refresh()
    assert (days.versions.number, _sales(spark, tables).versions.number) == numbers
    compare_gold(spark, tables)


def _sales(spark, tables):
    return Parts(spark, f"{tables.gold}/category_sales", parts.PART, incremental.SALES)


def test_an_update_that_ended_half_way_counts_nothing_twice(spark, tmp_path, monkeypatch):
    tables = flow.Lake(str(tmp_path))
    (tmp_path / "customers.csv").write_text(CUSTOMERS)
    update = lambda: incremental.update_gold(spark, f"{tables.root}/customers.csv", tables, buckets=4)
    silver_batch(spark, tables, "b0", bronze_row("a", 1.0), bronze_row("b", 2.0, "2026-03-01"))
    update()
    for i, ends_after in enumerate((1, 3)):
        silver_batch(spark, tables, f"c{i}", bronze_row(f"c{i}", 3.0), bronze_row(f"d{i}", 4.0, customer="CUST000003"))
        calls, replace = [], Parts.replace

        def ending(self, *args):
            replace(self, *args)
            calls.append(1)
            if len(calls) == ends_after:
                raise RuntimeError("lost")

        monkeypatch.setattr(Parts, "replace", ending)
        with pytest.raises(RuntimeError, match="lost"):
            update()
        monkeypatch.undo()
        update()
        compare_gold(spark, tables)


def test_gold_is_made_anew_when_silver_is_replaced(spark, tmp_path):
    tables = flow.Lake(str(tmp_path))
    (tmp_path / "customers.csv").write_text(CUSTOMERS)
    update = lambda: incremental.update_gold(spark, f"{tables.root}/customers.csv", tables, buckets=4)
    silver_batch(spark, tables, "b0", bronze_row("a", 1.0), bronze_row("b", 2.0, "2026-03-01"))
    update()
    clean, _ = silver.clean_transactions(
        lake.rows(spark, [bronze_row("a", 1.5), bronze_row("z", 9.0, "2026-04-01")], schemas.BRONZE_TRANSACTIONS)
    )
    lake.overwrite_table(clean, tables.silver)
    update()
    compare_gold(spark, tables)
    flow.write_gold(spark, f"{tables.root}/customers.csv", tables)  # the whole at once, then on from there
    compare_gold(spark, tables)
    silver_batch(spark, tables, "b1", bronze_row("q", 1.0))
    update()
    compare_gold(spark, tables)
