import pytest

from tillgrain import schemas
from tillgrain.operators import monitor, registry
from tillgrain.plans import flow
from tillgrain.sources import lake, logs
from tillgrain.streaming import ingest

RUN = "run_id string, timestamp string, pipeline_duration_seconds double, failed_step string"
QUALITY = "run_id string, total_rows bigint, fully_passing_rows bigint, overall_score double"
MODEL = "run_id string, model_version int, roc_auc double, passed boolean"


def history(spark, runs, quality, model):
    return monitor.run_records(
        lake.rows(spark, runs, RUN), lake.rows(spark, quality, QUALITY), lake.rows(spark, model, MODEL)
    )


def test_run_record_merges_both_reports(spark):
    record = history(
        spark,
        [("r", "2026-01-01", 12.345, None)],
        [("r", 1000, 950, 0.95)],
        [("r", 3, 0.88, True)],
    )
    assert record.columns == schemas.METRICS_HISTORY.names
    row = record.first()
    assert (row["dq_overall_score"], row["dq_total_rows"]) == (0.95, 1000)
    assert (row["model_roc_auc"], row["model_version"], row["model_gate_passed"]) == (0.88, 3, True)
    assert row["pipeline_duration_seconds"] == 12.35


def test_run_record_without_a_model_report(spark):
    row = history(spark, [("r", "2026-01-01", 1.0, None)], [("r", 500, 300, 0.6)], []).first()
    assert row["dq_overall_score"] == 0.6
    assert row["model_roc_auc"] is None


def test_kpis(spark):
    runs = history(
        spark,
        [("a", "2026-01-01", 1.0, None), ("b", "2026-01-03", 1.0, None), ("c", "2026-01-02", 1.0, None)],
        [("a", 10, 8, 0.8), ("b", 10, 9, 0.9), ("c", 10, 9, 0.95)],
        [("a", 1, 0.7, False), ("c", 2, 0.8, True)],
    )
    assert tuple(monitor.run_kpis(runs).first()) == (3, 0.9, None, 1, 1)
    newest = [r["timestamp"] for r in monitor.newest_first(runs).collect()]
    assert newest == ["2026-01-03", "2026-01-02", "2026-01-01"]
    none = monitor.run_kpis(history(spark, [], [], [])).first()
    assert tuple(none) == (0, None, None, 0, 0)


def raw_lines(n, bad=0):
    """n transactions of 60 customers over 150 days; the first `bad` lack a category."""
    for i in range(n):
        c = i % 60
        day = (i * 7) % 150 if c % 3 else (i * 7) % 60
        category = "" if i < bad else ("Books", "Toys", "Fashion")[i % 3]
        month, dom = 1 + day // 30, 1 + day % 28
        yield (
            f"t{i},CUST{c:06d},{category},{1 + i % 5},9.99,{(1 + i % 5) * 9.99:.2f},upi,"
            f"2026-{month:02d}-{dom:02d}T10:00:00"
        )


@pytest.fixture
def drop(tmp_path):
    def write(n, bad=0, name="a.csv"):
        raw = tmp_path / "raw"
        raw.mkdir(exist_ok=True)
        header = ",".join(schemas.RAW_TRANSACTIONS.names)
        (raw / name).write_text("\n".join([header, *raw_lines(n, bad)]) + "\n")
        customers = tmp_path / "customers.csv"
        customers.write_text(
            "customer_id,signup_date,region,age\n"
            + "".join(
                f"CUST{c:06d},2025-01-01,{('North', 'South')[c % 2]},{20 + c if c % 9 else ''}\n"
                for c in range(60)
            )
        )
        return str(raw), str(customers)

    return write


def records(spark, tables):
    return logs.read_log(spark, tables.history, schemas.METRICS_HISTORY).orderBy("timestamp").collect()


def test_full_run_then_second_model_and_baseline(spark, drop, tmp_path):
    raw, customers = drop(1200)
    tables = flow.Lake(str(tmp_path / "lake"))
    flow.run(spark, raw, customers, tables, min_auc=0.0)
    assert lake.read_table(spark, tables.silver).count() == 1200
    assert lake.read_table(spark, tables.quarantine).count() == 0
    assert lake.read_table(spark, f"{tables.gold}/customer_features").count() == 60
    (record,) = records(spark, tables)
    assert record["dq_overall_score"] == 1.0 and record["model_version"] == 1
    assert record["model_gate_passed"] is True and record["failed_step"] is None
    assert record["pipeline_duration_seconds"] > 0
    model, version = flow.load_production(spark, tables)
    assert version == 1 and len(model.pipeline.stages) == 3

    flow.register_baseline(spark, tables)
    runs = flow.model_runs(spark, tables)
    assert runs.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.MODEL_RUNS]
    history = registry.promotion_history(runs).orderBy("version").collect()
    assert [(r["version"], r["promoted"]) for r in history] == [(1, True), (2, False)]
    assert history[1]["roc_auc"] == 0.5 and history[1]["model_path"] is None
    assert len(history[0]["importances"]) == 7 and history[0]["n_training_rows"] == 60
    assert flow.load_production(spark, tables)[1] == 1

    # Training on the same rows gives the same AUC, which is not strictly better.
    flow.train(spark, tables)
    assert flow.load_production(spark, tables)[1] == 1


def test_quality_gate_stops_the_run_and_is_recorded(spark, drop, tmp_path):
    raw, customers = drop(100, bad=30)
    tables = flow.Lake(str(tmp_path / "lake"))
    with pytest.raises(flow.GateFailed):
        flow.run(spark, raw, customers, tables)
    (record,) = records(spark, tables)
    assert (record["dq_overall_score"], record["dq_total_rows"]) == (0.7, 100)
    assert record["model_roc_auc"] is None
    assert record["failed_step"] == "quality_gate"
    with pytest.raises(lake.TableMissing):
        lake.read_table(spark, tables.silver)


def test_an_error_is_recorded_too(spark, drop, tmp_path):
    raw, _ = drop(50)
    tables = flow.Lake(str(tmp_path / "lake"))
    with pytest.raises(Exception):
        flow.run(spark, raw, str(tmp_path / "no customers"), tables)
    (record,) = records(spark, tables)
    assert record["failed_step"] == "gold" and record["dq_overall_score"] == 1.0


def test_history_can_be_left_out(spark, drop, tmp_path):
    raw, customers = drop(100, bad=30)
    tables = flow.Lake(str(tmp_path / "lake"))
    with pytest.raises(flow.GateFailed):
        flow.run(spark, raw, customers, tables, keep_history=False)
    assert records(spark, tables) == []


def test_no_production_model(spark, tmp_path):
    with pytest.raises(LookupError):
        flow.load_production(spark, flow.Lake(str(tmp_path)))


def test_silver_counts(spark, drop, tmp_path):
    from tillgrain.operators import bronze

    raw, _ = drop(100, bad=30)
    tables = flow.Lake(str(tmp_path / "lake"))
    for _ in range(2):
        bronze.ingest(spark, raw, tables.bronze)
    assert flow.write_silver(spark, tables) == {"clean_rows": 70, "quarantined_rows": 30}
    assert lake.read_table(spark, tables.silver).dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.SILVER_TRANSACTIONS
    ]
    assert lake.read_table(spark, tables.quarantine).columns == schemas.QUARANTINE.names


def test_streams_take_each_file_and_id_once(spark, drop, tmp_path):
    raw, _ = drop(100, bad=10)
    path = lambda name: str(tmp_path / name)

    def run():
        ingest.stream_bronze(spark, raw, path("bronze"), path("c1")).awaitTermination()
        ingest.stream_silver(
            spark, path("bronze"), path("clean"), path("bad"), path("c2")
        ).awaitTermination()
        return (
            lake.read_table(spark, path("bronze")).count(),
            lake.read_table(spark, path("clean")).count(),
            lake.read_table(spark, path("bad")).count(),
        )

    assert run() == (100, 90, 10)
    assert run() == (100, 90, 10)
    drop(110, bad=10, name="b.csv")  # a replay of the first hundred, and ten new ones
    assert run() == (210, 100, 10)


def test_late_and_unstamped_rows_are_not_lost(spark, tmp_path):
    from tillgrain.operators import bronze

    path = lambda name: str(tmp_path / name)
    stamps = [("a", "2026-08-30"), ("b", "2026-08-30"), ("c", "2026-08-01"), ("d", "2026-08-01")]
    stamps += [("e", "2026-08-01"), ("g", None), (None, None), ("a", "2026-08-01"), (None, "2026-09-01")]
    for i, (key, stamp) in enumerate(stamps):
        row = (key, "CUST000001", "Toys", "1", 1.0, 1.0, "cash", "2026-01-01", stamp, f"f{i}")
        batch = lake.rows(spark, [row], schemas.BRONZE_TRANSACTIONS)
        bronze.store_batch(batch, path("bronze"), f"b{i}")
        ingest.stream_silver(
            spark, path("bronze"), path("clean"), path("bad"), path("c")
        ).awaitTermination()
    clean = lake.read_table(spark, path("clean")).collect()
    assert sorted(r["transaction_id"] or "" for r in clean) == ["", "a", "b", "c", "d", "e", "g"]
    assert lake.read_table(spark, path("bad")).count() == 0


def test_stream_and_batch_share_a_bronze_table(spark, drop, tmp_path):
    from tillgrain.operators import bronze

    raw, _ = drop(100)
    path = lambda name: str(tmp_path / name)
    ingest.stream_bronze(spark, raw, path("bronze"), path("c")).awaitTermination()
    bronze.ingest(spark, raw, path("bronze"), skip_seen_files=True)
    assert lake.read_table(spark, path("bronze")).count() == 100
    drop(20, name="b.csv")
    bronze.ingest(spark, raw, path("bronze"), skip_seen_files=True)
    ingest.stream_bronze(spark, raw, path("bronze"), path("c")).awaitTermination()
    assert lake.read_table(spark, path("bronze")).count() == 120


def test_what_is_staged_within_a_scope_is_deleted(spark):
    import os

    from tillgrain import session

    kept = session.stage(spark.range(3), "kept")
    with session.staging(spark):
        path = session.scratch_path(spark, "gone")
        spark.range(3).write.parquet(path)
        assert os.path.exists(path)
    assert not os.path.exists(path) and kept.count() == 3


def done_by(monkeypatch):
    """Which steps of the flow are done, in order."""
    done = []
    for step in ("write_silver", "write_gold", "train"):
        real = getattr(flow, step)
        monkeypatch.setattr(flow, step, lambda *a, _s=step, _r=real, **k: done.append(_s) or _r(*a, **k))
    return done


def test_a_run_that_failed_goes_on_where_it_stopped(spark, drop, tmp_path, monkeypatch):
    raw, customers = drop(600)
    tables = flow.Lake(str(tmp_path / "lake"))
    done = done_by(monkeypatch)
    with pytest.raises(flow.GateFailed):
        flow.run(spark, raw, customers, tables, min_auc=1.01)
    assert done == ["write_silver", "write_gold", "train"]
    flow.run(spark, raw, customers, tables, min_auc=0.0)
    assert done == ["write_silver", "write_gold", "train"]
    assert lake.read_table(spark, tables.bronze).count() == 600
    assert flow.model_runs(spark, tables).count() == 1
    assert [r["failed_step"] for r in records(spark, tables)] == ["model_gate", None]
    # The run is complete: another one starts from the beginning, and a plain append stores a replay.
    flow.run(spark, raw, customers, tables, min_auc=0.0)
    assert done[3:] == ["write_silver", "write_gold", "train"]
    assert lake.read_table(spark, tables.bronze).count() == 1200


def test_a_step_is_repeated_if_what_it_reads_has_changed(spark, drop, tmp_path, monkeypatch):
    from tillgrain.operators import bronze

    raw, customers = drop(600)
    tables = flow.Lake(str(tmp_path / "lake"))
    done = done_by(monkeypatch)
    train = flow.train
    monkeypatch.setattr(flow, "train", lambda *a, **k: (_ for _ in ()).throw(MemoryError("lost")))
    with pytest.raises(MemoryError):
        flow.run(spark, raw, customers, tables, min_auc=0.0)
    assert done == ["write_silver", "write_gold"]
    monkeypatch.setattr(flow, "train", train)
    other = tmp_path / "other"
    other.mkdir()
    lines = [",".join(schemas.RAW_TRANSACTIONS.names), *list(raw_lines(605))[600:]]
    (other / "b.csv").write_text("\n".join(lines) + "\n")
    bronze.ingest(spark, str(other), tables.bronze)  # Bronze grows meanwhile
    flow.run(spark, raw, customers, tables, min_auc=0.0)
    assert done == ["write_silver", "write_gold", "write_silver", "write_gold", "train"]
    assert lake.read_table(spark, tables.silver).count() == 605


def test_a_new_file_in_the_drop_is_another_run(spark, drop, tmp_path):
    raw, customers = drop(100, bad=30)
    tables = flow.Lake(str(tmp_path / "lake"))
    with pytest.raises(flow.GateFailed):
        flow.run(spark, raw, customers, tables, skip_seen_files=True)
    with pytest.raises(flow.GateFailed):
        flow.run(spark, raw, customers, tables, skip_seen_files=True)
    assert lake.read_table(spark, tables.bronze).count() == 100
    drop(500, name="b.csv")
    flow.run(spark, raw, customers, tables, min_auc=0.0, skip_seen_files=True)
    assert lake.read_table(spark, tables.bronze).count() == 600


def test_bronze_that_ended_between_batch_and_entry_is_stored_once(spark, drop, tmp_path, monkeypatch):
    from tillgrain.operators import bronze

    raw, customers = drop(600)
    tables = flow.Lake(str(tmp_path / "lake"))
    real = bronze.ingest

    def ending(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(bronze, "ingest", ending)
    with pytest.raises(RuntimeError):
        flow.run(spark, raw, customers, tables)
    monkeypatch.undo()
    flow.run(spark, raw, customers, tables, min_auc=0.0)
    assert lake.read_table(spark, tables.bronze).count() == 600


def test_interleaved_trainings_leave_two_versions_and_two_models(spark, drop, tmp_path, monkeypatch):
    from tillgrain.operators import bronze, forest

    raw, customers = drop(1200)
    tables = flow.Lake(str(tmp_path / "lake"))
    bronze.ingest(spark, raw, tables.bronze)
    flow.write_silver(spark, tables)
    flow.write_gold(spark, customers, tables)
    fit, nested = forest.fit_churn_model, []

    def fitting(train):
        if not nested:  # while the first training fits, a second one starts and ends
            nested.append(True)
            flow.train(spark, tables)
        return fit(train)

    monkeypatch.setattr(forest, "fit_churn_model", fitting)
    flow.train(spark, tables)
    runs = flow.model_runs(spark, tables).orderBy("version").collect()
    assert [r["version"] for r in runs] == [1, 2]
    assert len({r["model_path"] for r in runs}) == 2
    assert runs[0]["logged_at"] > runs[1]["logged_at"]  # the first to claim was the last to end
    # Both are equally good: in the order of the claims the first one is promoted, the second is not.
    assert flow.load_production(spark, tables)[1] == 1
    assert all(forest.ChurnModel.load(spark, r["model_path"]).n_regions == 2 for r in runs)
    # A training that ends without a run leaves its number behind.
    flow.claim_version(spark, tables, flow.MODEL_NAME)
    flow.train(spark, tables)
    assert flow.model_runs(spark, tables).agg({"version": "max"}).first()[0] == 4
