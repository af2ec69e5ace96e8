"""Parsing of text columns that yields NULL, never an error, on bad input."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# \z, not $: $ would also accept a line break after the digits.
DIGITS_ONLY = r"^[0-9]+\z"


def parse_quantity(text: Column) -> Column:
    return F.when(text.rlike(DIGITS_ONLY), text.try_cast("int"))


def parse_timestamp(text: Column) -> Column:
    # Without a zone, so that the calendar date does not move with the session's zone.
    return text.try_cast("timestamp_ntz")
