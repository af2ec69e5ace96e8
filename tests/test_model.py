import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillgrain.operators import evaluation, explain, features, forest, registry
from tillgrain.sources import lake

SYNTHETIC = (
    "customer_id string, total_transactions bigint, lifetime_value double, "
    "avg_transaction_value double, distinct_categories_purchased bigint, "
    "days_since_last_purchase bigint, customer_tenure_days bigint, region string, age double, "
    "churned int"
)


def synthetic_rows(n, seed):
    rng = np.random.default_rng(seed)
    transactions = rng.integers(1, 20, n)
    tenure = rng.integers(0, 700, n)
    risk = -0.01 * tenure - 0.3 * transactions + rng.normal(0, 5, n)
    churned = risk > np.median(risk)
    return [
        (
            f"CUST{i:04d}",
            int(transactions[i]),
            float(rng.uniform(50, 10000)),
            float(rng.uniform(10, 500)),
            int(rng.integers(1, 8)),
            int(rng.integers(0, 200)),
            int(tenure[i]),
            str(rng.choice(["North", "South", "East", "West"])),
            float(rng.integers(18, 75)),
            int(churned[i]),
        )
        for i in range(n)
    ]


def synthetic(spark, n=200, seed=0):
    return lake.rows(spark, synthetic_rows(n, seed), SYNTHETIC)


def scored(spark, pairs):
    return lake.rows(spark, pairs, "score double, churned int")


def brute_auc(pairs):
    wins = [
        1.0 if p > n else 0.5 if p == n else 0.0
        for p, label in pairs
        if label == 1
        for n, other in pairs
        if other == 0
    ]
    return sum(wins) / len(wins)


@pytest.mark.parametrize("digits", [1, 2, 9])
def test_auc_equals_counting_all_pairs(spark, digits):
    rng = random.Random(digits)
    pairs = [(round(rng.random(), digits), int(rng.random() < 0.3)) for _ in range(600)]
    auc = evaluation.roc_auc(scored(spark, pairs)).first()[0]
    assert auc == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_by_group_with_one_hot_score(spark):
    rng = random.Random(5)
    rows = [("a", 0.5 if i % 3 else rng.random(), i % 2) for i in range(300)]
    rows += [("b", float(i), 1) for i in range(5)]
    result = evaluation.roc_auc(
        lake.rows(spark, rows, "g string, score double, churned int"), by=["g"]
    )
    auc = {r["g"]: r["roc_auc"] for r in result.collect()}
    assert auc["a"] == pytest.approx(brute_auc([(s, c) for g, s, c in rows if g == "a"]))
    assert auc["b"] is None  # only one label


def test_metrics_and_zero_denominators(spark):
    rows = scored(spark, [(0.9, 1), (0.8, 0), (0.5, 1), (0.1, 0), (0.2, 0)])
    m = evaluation.classification_metrics(rows).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (1, 1, 1, 2)
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.5, 0.5, 0.5, 0.6)
    none = evaluation.classification_metrics(scored(spark, [(0.1, 0)])).first()
    assert (none["precision"], none["recall"], none["f1"], none["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_majority_baseline_is_no_better_than_chance(spark):
    rows = scored(spark, [(0.0, int(i % 7 == 0)) for i in range(300)])
    auc = evaluation.roc_auc(evaluation.majority_scores(rows)).first()[0]
    assert auc == 0.5
    assert auc < registry.DEFAULT_MIN_AUC


def test_split_is_exact_stratified_and_layout_free(spark):
    rows = synthetic(spark, 203).withColumn("churned", F.when(F.col("age") > 60, 1).otherwise(0))
    split = {r["customer_id"]: r for r in features.stratified_split(rows).collect()}
    assert len(split) == 203
    for label in (0, 1):
        group = [r for r in split.values() if r["churned"] == label]
        assert sum(r["is_test"] for r in group) == math.ceil(0.2 * len(group))
    again = features.stratified_split(rows.repartition(11)).collect()
    assert all(split[r["customer_id"]]["is_test"] == r["is_test"] for r in again)


def test_encoding_fills_age_with_the_median_and_codes_regions(spark):
    rows = lake.rows(
        spark,
        [("a", "South", 10.0), ("b", None, None), ("c", "East", 20.0), ("d", "South", 35.0)],
        "customer_id string, region string, age double",
    )
    encoded = {r["customer_id"]: r for r in features.encode_features(rows).collect()}
    assert encoded["b"]["age"] == 20.0
    assert encoded["b"]["region"] == "UNKNOWN"
    assert [encoded[c]["region_encoded"] for c in "abcd"] == [1, 2, 0, 1]
    even = lake.rows(spark, [("a", "x", 1.0), ("b", "x", 2.0), ("c", "x", None)], rows.schema)
    assert features.encode_features(even).where("customer_id = 'c'").first()["age"] == 1.5


def test_class_weights_balance(spark):
    rows = scored(spark, [(0.0, 1)] * 2 + [(0.0, 0)] * 6)
    weights = {r["churned"]: r["weight"] for r in features.class_weights(rows).collect()}
    assert weights == {1: 2.0, 0: pytest.approx(8 / 12)}
    on_rows = features.with_class_weights(rows).select("churned", "weight").distinct().collect()
    assert {r["churned"]: r["weight"] for r in on_rows} == weights
    one_class = features.with_class_weights(rows.where("churned = 1")).first()
    assert one_class["weight"] == 1.0


def test_leaky_column_is_no_feature_and_is_flagged(spark):
    assert features.LEAKY_COLUMN not in features.FEATURES
    with pytest.raises(ValueError):
        features.check_features((*features.FEATURES, features.LEAKY_COLUMN))
    rows = synthetic(spark).withColumn(
        "churned", (F.col("days_since_last_purchase") > 60).cast("int")
    )
    checked = evaluation.leakage_check(rows, ["age", "days_since_last_purchase"]).collect()
    assert {r["feature"]: r["leaks"] for r in checked} == {
        "age": False,
        "days_since_last_purchase": True,
    }


def test_forest_beats_chance_and_is_stored_with_its_encoding(spark, tmp_path):
    split = features.stratified_split(synthetic(spark, 400, seed=1)).persist()
    model = forest.fit_churn_model(split.where("not is_test"))
    importances = forest.importances(model)
    assert list(importances) == list(features.FEATURES)
    assert sum(importances.values()) == pytest.approx(1.0)
    assert forest.importance_table(model, split).count() == 7
    model.save(str(tmp_path / "m"))
    stored = forest.ChurnModel.load(spark, str(tmp_path / "m"))
    # A region never seen, a missing region and a missing age are scored too.
    odd = split.where("is_test").withColumns(
        {
            "region": F.when(F.col("age") > 60, "Nowhere").when(F.col("age") > 30, F.col("region")),
            "age": F.when(F.col("age") > 40, F.col("age")),
        }
    )
    test = forest.score_customers(stored, split.where("is_test"))
    assert forest.score_customers(stored, odd).where("churn_risk_score IS NULL").count() == 0
    auc = evaluation.roc_auc(test, "churn_risk_score").first()[0]
    assert 0.6 < auc <= 1.0
    metrics = evaluation.classification_metrics(test, "churn_risk_score").first()
    assert 0 <= metrics["precision"] <= 1 and 0 <= metrics["recall"] <= 1
    top = forest.highest_risk(test, 5).collect()
    assert len(top) == 5
    assert [r["churn_risk_score"] for r in top] == sorted(
        (r["churn_risk_score"] for r in top), reverse=True
    )
    split.unpersist()


def test_forest_takes_more_regions_than_bins(spark):
    rows = synthetic(spark, 200).withColumn(
        "region", F.concat(F.lit("r"), F.substring("customer_id", 7, 2))
    )
    model = forest.fit_churn_model(rows)
    assert forest.score_customers(model, rows).count() == 200


RUNS = "model_name string, version int, roc_auc double, promotable boolean"


def test_promotion_is_strict_and_skips_baselines(spark):
    runs = lake.rows(
        spark,
        [("m", 1, 0.91, True), ("m", 2, 0.99, False), ("m", 3, 0.92, True), ("m", 4, 0.92, True)],
        RUNS,
    )
    history = registry.promotion_history(runs).orderBy("version").collect()
    assert [r["promoted"] for r in history] == [True, False, True, False]
    production = registry.production_models(runs).first()
    assert (production["version"], production["roc_auc"]) == (3, 0.92)
    assert registry.next_version(runs, "m").first()[0] == 5
    assert registry.next_version(runs, "other").first()[0] == 1


def test_missing_auc_in_production_is_replaced_and_never_replaces(spark):
    runs = lake.rows(
        spark, [("m", 1, None, True), ("m", 2, 0.6, True), ("m", 3, None, True)], RUNS
    )
    history = registry.promotion_history(runs).orderBy("version").collect()
    assert [r["promoted"] for r in history] == [True, True, False]


@pytest.mark.parametrize(("auc", "passed"), [(0.75, True), (0.7499, False), (None, False)])
def test_model_gate(spark, auc, passed):
    gate = registry.model_gate(lake.rows(spark, [("m", 1, auc, True)], RUNS)).first()
    assert gate.asDict() == {
        "model_name": "m",
        "model_version": 1,
        "roc_auc": auc,
        "threshold": 0.75,
        "passed": passed,
    }


def test_no_production_model_means_no_report(spark):
    assert registry.model_gate(lake.rows(spark, [("m", 1, 0.9, False)], RUNS)).count() == 0


IMPORTANCES = dict(zip(features.FEATURES, (0.3, 0.1, 0.1, 0.1, 0.2, 0.1, 0.1)))


def test_explanations_equal_a_loop_over_customers(spark):
    encoded = features.encode_features(synthetic(spark, 60)).persist()
    rows = [r.asDict() for r in encoded.collect()]
    values = {f: np.array([float(r[f]) for r in rows]) for f in features.FEATURES}
    label = np.array([r["churned"] for r in rows])
    z_expected, p_expected = {}, {}
    for i, r in enumerate(rows):
        z, p = [], []
        for f in features.FEATURES:
            v, x = values[f], values[f][i]
            z.append((f, IMPORTANCES[f] * (x - v.mean()) / (v.std(ddof=1) + 1e-9)))
            churned, stayed = v[label == 1].mean(), v[label == 0].mean()
            nearer = abs(x - stayed) - abs(x - churned)
            p.append((f, IMPORTANCES[f] * nearer / (abs(churned - stayed) + 1e-9)))
        z_expected[r["customer_id"]] = sorted(z, key=lambda c: -abs(c[1]))[:4]
        p_expected[r["customer_id"]] = sorted(p, key=lambda c: -abs(c[1]))[:3]
    for explained, expected in (
        (explain.zscore_factors(encoded, IMPORTANCES), z_expected),
        (explain.profile_factors(encoded, IMPORTANCES), p_expected),
    ):
        for r in explained.collect():
            got = [(f["feature"], f["weight"]) for f in r["factors"]]
            want = expected[r["customer_id"]]
            assert [f for f, _ in got] == [f for f, _ in want]
            assert [w for _, w in got] == pytest.approx([w for _, w in want])
    encoded.unpersist()


def test_equal_weights_keep_feature_order(spark):
    encoded = features.encode_features(synthetic(spark, 20))
    nothing = dict.fromkeys(features.FEATURES, 0.0)
    first = explain.zscore_factors(encoded, nothing).first()["factors"]
    assert [f["feature"] for f in first] == list(features.FEATURES[:4])


def test_risk_bands_and_half_percentages(spark):
    scores = lake.rows(spark, [(0.6,), (0.59,), (0.3,), (0.29,)], "s double")
    bands = [r[0] for r in scores.select(explain.risk_band(F.col("s"))).collect()]
    assert bands == ["high", "moderate", "moderate", "low"]
    encoded = features.encode_features(synthetic(spark, 20)).withColumn(
        "churn_risk_score", F.lit(0.625)
    )
    answer = explain.risk_answers(encoded, IMPORTANCES).first()["answer"]
    assert " has a 62% churn risk score, which is high. The biggest factors are: " in answer


def test_rows_without_key_or_label_stay_in_the_split_and_in_the_metrics(spark):
    values = [(f"c{i}", i % 2) for i in range(20)] + [(None, 1), ("x", None)]
    rows = lake.rows(spark, values, "customer_id string, churned int")
    assert features.stratified_split(rows).count() == 22
    scored = lake.rows(spark, [(0.9, 1), (0.1, 0), (None, 1)], "score double, churned int")
    assert evaluation.classification_metrics(scored).first()["unscored_rows"] == 1
    grouped = scored.selectExpr("*", "CASE WHEN churned = 1 THEN NULL ELSE 'g' END AS kind")
    assert evaluation.roc_auc(grouped, by=["kind"]).count() == 2


# ---- medians and dictionaries of any size


def slow_median(pairs):
    values = sorted((v for v, n in pairs if v is not None and (n or 0) > 0 for _ in range(n)), key=lambda v: (v != v, v))
    if not values:
        return None
    return (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2


@pytest.mark.parametrize("few", [1, 7, 100_000])
def test_medians_equal_sorting(spark, few):
    import random

    from tillgrain.operators.selection import medians

    rng, rows = random.Random(few), []
    shapes = {
        "wide": lambda: rng.random() * 1e9,
        "tied": lambda: float(rng.randint(0, 3)),
        "one": lambda: 5.0,
        "null": lambda: None,
        "nan": lambda: rng.choice([float("nan"), 1.0, 2.0, float("inf"), -float("inf"), None]),
        None: lambda: rng.gauss(0, 1),
    }
    for name, make in shapes.items():
        rows += [(name, "x" if i % 2 else None, make(), rng.choice([1, 1, 2, 5, 0, -1, None])) for i in range(301)]
    df = spark.createDataFrame(rows, "g string, h string, v double, w int").repartition(5)
    for by in ([], ["g"], ["g", "h"]):
        for weight in (None, "w"):
            found = medians(df, "v", by, weight, few=few, borders=8).collect()
            want = {}
            for g, h, v, w in rows:
                key = tuple({"g": g, "h": h}[b] for b in by)
                want.setdefault(key, []).append((v, w if weight else 1))
            got = {tuple(r[b] for b in by): r["median"] for r in found}
            expected = {k: slow_median(p) for k, p in want.items()}
            assert {k: repr(v) for k, v in got.items()} == {k: repr(v) for k, v in expected.items()}, (by, weight)


def test_median_of_as_many_values_as_rows_takes_rounds(spark):
    from tillgrain.operators.selection import medians

    df = spark.range(200_001).selectExpr("sqrt(id) * pow(-1, id) AS v")
    want = sorted(float(r[0]) for r in df.collect())[100_000]
    assert medians(df, "v", few=500, borders=16).first()["median"] == want
    assert [tuple(r) for r in medians(df.limit(0), "v").collect()] == [(None,)]


def test_a_large_dictionary_is_numbered_without_a_window_over_all(spark):
    from pyspark.sql import functions as F

    df = spark.range(200_000).select(
        F.when(F.col("id") % 1000 != 7, F.concat(F.lit("r"), F.col("id") % 100_003)).alias("region")
    )
    codes = features.region_codes(df)
    plan = codes._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    rows = codes.collect()
    names = sorted({r["region"] or "UNKNOWN" for r in df.distinct().collect()})
    assert {r["region"]: r["region_encoded"] for r in rows} == {n: i for i, n in enumerate(names)}


def test_unseen_regions_share_the_code_after_the_last(spark):
    codes = spark.createDataFrame([("A", 0), ("UNKNOWN", 1)], "region string, region_encoded int")
    df = spark.createDataFrame([(1, "A"), (2, None), (3, "new"), (4, "newer")], "k int, region string")
    found = features.with_codes(df, codes, unseen=2).orderBy("k").collect()
    assert [(r["region"], r["region_encoded"]) for r in found] == [("A", 0), ("UNKNOWN", 1), ("new", 2), ("newer", 2)]
