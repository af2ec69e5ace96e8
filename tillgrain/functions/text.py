"""Text predicates and number formats used by reports and answers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_ignoring_case(text: Column, part: Column) -> Column:
    return F.contains(F.lower(text), F.lower(part))


def money_text(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_string("%,.2f", amount))


def preview(text: Column, length: int = 120) -> Column:
    return F.when(
        F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))
    ).otherwise(text)
