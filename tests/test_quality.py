from tests.test_silver import bronze
from tillgrain import schemas
from tillgrain.operators import quality
from tillgrain.sources import lake


def report(df):
    return quality.quality_report(df)


def test_every_rule_and_the_conjunction_are_counted(spark):
    rows = bronze(
        spark,
        {},
        {"customer_id": None, "quantity": "N/A"},
        {"product_category": None},
        {"transaction_amount": -1.0},
    )
    total = quality.overall(report(rows)).first()
    assert tuple(total) == (4, 1, 0.25)
    rules = {r["rule"]: tuple(r)[1:] for r in quality.rule_report(report(rows)).collect()}
    assert rules == {
        "not_null_customer_id": (3, 1, 0.75),
        "not_null_product_category": (3, 1, 0.75),
        "non_negative_amount": (3, 1, 0.75),
        "valid_quantity": (3, 1, 0.75),
    }


def test_null_fails_a_rule_and_timestamps_are_not_checked(spark):
    rows = bronze(spark, {"transaction_amount": None}, {"transaction_ts": "garbage"})
    assert quality.overall(report(rows)).first()["fully_passing_rows"] == 1


def test_a_line_break_after_the_digits_fails(spark):
    rows = bronze(spark, {"quantity": "12\n"}, {"quantity": "99999999999"})
    assert quality.overall(report(rows)).first()["fully_passing_rows"] == 1


def test_empty_input_scores_zero_and_fails_the_gate(spark):
    empty = lake.rows(spark, [], schemas.BRONZE_TRANSACTIONS)
    verdict = quality.quality_gate(report(empty)).first()
    assert (verdict["total_rows"], verdict["overall_score"], verdict["passed"]) == (0, 0.0, False)
    assert quality.rule_report(report(empty)).count() == 0


def test_a_score_equal_to_the_threshold_passes(spark):
    rows = bronze(spark, *[{}] * 9, {"customer_id": None})
    assert quality.quality_gate(report(rows), 0.90).first()["passed"]
    assert not quality.quality_gate(report(rows), 0.91).first()["passed"]


def test_rules_can_be_replaced(spark):
    from pyspark.sql import functions as F

    rules = {"big": lambda: F.col("transaction_amount") > 100}
    rows = bronze(spark, {}, {"transaction_amount": 1.0})
    assert quality.rule_report(quality.quality_report(rows, rules), rules).first()["passing_rows"] == 1


def incident_rows(spark):
    return bronze(
        spark,
        *[
            {"transaction_id": f"tx-{i}", "transaction_amount": -5.0 if i % 50 == 0 else 5.0}
            for i in range(2000)
        ],
    )


def test_incident_hits_about_the_fraction_and_the_same_rows_in_any_layout(spark):
    rows = incident_rows(spark)
    hit = {
        r["transaction_id"]
        for r in quality.inject_incident(rows, 0.3).where("product_category IS NULL").collect()
    }
    again = {
        r["transaction_id"]
        for r in quality.inject_incident(rows.repartition(7), 0.3)
        .where("product_category IS NULL")
        .collect()
    }
    assert hit == again
    assert 0.25 < len(hit) / 2000 < 0.35


def test_incident_turns_signs_both_ways(spark):
    rows = incident_rows(spark)
    after = quality.inject_incident(rows, 1.0)
    assert after.where("transaction_amount > 0").count() == 40
    assert after.columns == rows.columns


def test_incident_report_shows_the_gate_failing(spark):
    rows = bronze(spark, *[{"transaction_id": f"tx-{i}"} for i in range(1000)])
    verdicts = {r["batch"]: r for r in quality.incident_report(rows, 0.3).collect()}
    assert verdicts["before"]["passed"] and verdicts["before"]["overall_score"] == 1.0
    assert not verdicts["after"]["passed"]
    alone = quality.overall(report(quality.inject_incident(rows, 0.3))).first()
    assert verdicts["after"]["overall_score"] == alone["overall_score"]
