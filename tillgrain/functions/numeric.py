"""Sums, rates and hashes that do not depend on how rows are spread over tasks."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_parts(amount: Column) -> tuple[Column, Column]:
    """(cents, rest) of a sum of a double money column, to be added up further by money_total.

    Whole cents are added as decimals, which is exact in any order. What is left of an amount after
    its cents, and amounts a decimal cannot hold (NaN, infinities, 1e16 and up), are added as
    doubles, so nothing is lost.
    """
    cents = amount.try_cast("decimal(18,2)")
    rest = F.when(cents.isNull(), amount).otherwise(amount - cents.cast("double"))
    return F.sum(cents), F.sum(rest)


def money_total(cents: Column, rest: Column) -> Column:
    """The sum of both parts; NULL when every amount was NULL."""
    return rest + F.coalesce(cents.cast("double"), F.lit(0.0))


def money_sum(amount: Column) -> Column:
    return money_total(*money_parts(amount))


def money_avg(amount: Column) -> Column:
    return F.try_divide(money_sum(amount), F.count(amount))


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole, rounded; 0.0 when there is nothing to divide by."""
    return F.coalesce(F.round(F.try_divide(part, whole), digits), F.lit(0.0))


def hash_fraction(*columns: Column | str) -> Column:
    """A value in [0, 1) fixed by the row's own text, the same under any partitioning."""
    text = F.concat_ws("|", *[F.coalesce(_column(c), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
