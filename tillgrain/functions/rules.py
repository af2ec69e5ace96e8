"""The two rule sets: pass rules for the quality score, failure reasons for the quarantine."""

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillgrain.functions.parsing import DIGITS_ONLY, parse_quantity, parse_timestamp

Rules = dict[str, Callable[[], Column]]

# A rule that evaluates to NULL counts as failed: count_if skips NULL.
QUALITY_RULES: Rules = {
    "not_null_customer_id": lambda: F.col("customer_id").isNotNull(),
    "not_null_product_category": lambda: F.col("product_category").isNotNull(),
    "non_negative_amount": lambda: F.col("transaction_amount") >= 0,
    "valid_quantity": lambda: F.col("quantity").rlike(DIGITS_ONLY),
}

# A NULL amount gives no reason here although it fails the quality rule above.
FAILURE_REASONS: Rules = {
    "null_customer_id": lambda: F.col("customer_id").isNull(),
    "null_product_category": lambda: F.col("product_category").isNull(),
    "invalid_quantity": lambda: parse_quantity(F.col("quantity")).isNull(),
    "negative_amount": lambda: F.col("transaction_amount") < 0,
    "unparseable_timestamp": lambda: parse_timestamp(F.col("transaction_ts")).isNull(),
}


def is_rejected(rules: Rules = FAILURE_REASONS) -> Column:
    """Whether any reason holds: plain conditions, so that a filter on it is compiled."""
    return reduce(or_, [F.coalesce(rule(), F.lit(False)) for rule in rules.values()])


def failure_reasons(rules: Rules = FAILURE_REASONS) -> Column:
    # array_except is compiled, array_compact is interpreted row by row.
    found = F.array(*[F.when(rule(), F.lit(name)) for name, rule in rules.items()])
    return F.array_except(found, F.array(F.lit(None).cast("string")))
