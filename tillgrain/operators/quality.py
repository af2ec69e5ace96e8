"""Data-quality scoring of Bronze, its gate, and the fault injection that exercises the gate."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.functions.numeric import hash_fraction, share
from tillgrain.functions.rules import QUALITY_RULES, Rules

DEFAULT_THRESHOLD = 0.90


def quality_report(
    df: DataFrame, rules: Rules = QUALITY_RULES, by: Sequence[str] = ()
) -> DataFrame:
    """Score every rule and their conjunction in one pass, one row per group of `by`.

    The counts are added up inside each task first, so a group of any size costs one row per task
    in the exchange. Without `by` an empty input still gives one row, scored 0.0.
    """
    predicates = {name: rule() for name, rule in rules.items()}
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(reduce(and_, predicates.values())).alias("fully_passing_rows"),
        *[F.count_if(p).alias(_passing(name)) for name, p in predicates.items()],
    )
    return counts.select(
        *by,
        "total_rows",
        "fully_passing_rows",
        share(F.col("fully_passing_rows"), F.col("total_rows")).alias("overall_score"),
        *[_passing(name) for name in rules],
    )


def overall(report: DataFrame) -> DataFrame:
    return report.drop(*[c for c in report.columns if c.endswith("__passing")])


def rule_report(
    report: DataFrame, rules: Rules = QUALITY_RULES, by: Sequence[str] = ()
) -> DataFrame:
    """One row per rule of a quality report; none for an empty input."""
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(_passing(name)).alias("passing_rows"))
            for name in rules
        ]
    )
    return (
        report.where(F.col("total_rows") > 0)
        .select(*by, "total_rows", F.inline(entries))
        .select(
            *by,
            "rule",
            "passing_rows",
            (F.col("total_rows") - F.col("passing_rows")).alias("failing_rows"),
            share(F.col("passing_rows"), F.col("total_rows")).alias("pass_rate"),
        )
    )


def quality_gate(report: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Add the verdict: a score equal to the threshold passes."""
    return (
        overall(report)
        .withColumn("threshold", F.lit(threshold))
        .withColumn("passed", F.col("overall_score") >= F.lit(threshold))
    )


def _corrupted(bad: Column, column: str, fault: Column) -> Column:
    return F.when(bad, fault).otherwise(F.col(column)).alias(column)


# Text columns only: numbers would have to be printed first.
_ROLL_COLUMNS = (
    "transaction_id",
    "customer_id",
    "product_category",
    "quantity",
    "payment_method",
    "transaction_ts",
)


def inject_incident(df: DataFrame, bad_fraction: float = 0.30) -> DataFrame:
    """Null the category and turn the sign of the amount on about bad_fraction of the rows.

    Whether a row is hit depends on its content alone, so a retried task or another layout hits
    the same rows.
    """
    bad = hash_fraction(*_ROLL_COLUMNS) < bad_fraction
    faults = {
        "product_category": F.lit(None).cast("string"),
        "transaction_amount": -F.col("transaction_amount"),
    }
    return df.select(*[_corrupted(bad, c, faults[c]) if c in faults else c for c in df.columns])


def incident_report(
    df: DataFrame, bad_fraction: float = 0.30, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Gate verdicts of a batch before and after an incident, from one scan of the batch."""
    bad = hash_fraction(*_ROLL_COLUMNS) < bad_fraction

    def variant(name: str, hit: Column) -> Column:
        return F.struct(
            F.lit(name).alias("batch"),
            _corrupted(hit, "product_category", F.lit(None).cast("string")),
            _corrupted(hit, "transaction_amount", -F.col("transaction_amount")),
        )

    both = df.select(
        "customer_id",
        "quantity",
        F.inline(F.array(variant("before", F.lit(False)), variant("after", bad))),
    )
    return quality_gate(quality_report(both, by=["batch"]), threshold)


def _passing(rule: str) -> str:
    return f"{rule}__passing"
