"""Exact medians of columns with any number of values, without one buffer that holds them.

What is looked for is the value at a rank. Every round draws borders from a sketch of the values that
are still in question, of a bounded size for each group, counts the rows between the borders in one
pass, and goes on with those between the two borders that the rank falls between. When few enough
values are left in every group they are put in order. A group with few values needs no round.

Weights say how often a value counts. NaN is the largest value; NULL values, and rows of weight 0 or
less or NULL, do not count. A group of such rows only has the median NULL.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.session import stage

BORDERS = 256
ACCURACY = 4096
FEW = 100_000


def medians(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    weight: str | None = None,
    few: int = FEW,
    borders: int = BORDERS,
) -> DataFrame:
    """Columns by, median: the middle value of each group, or the mean of the two in the middle."""
    keys = [f"_by{i}" for i in range(len(by))]
    times = F.lit(1) if weight is None else F.greatest(F.col(weight), F.lit(0))
    rows = df.select(
        *[F.col(b).alias(k) for b, k in zip(by, keys)],
        F.col(column).cast("double").alias("_value"),
        F.coalesce(times.cast("bigint"), F.lit(0)).alias("_times"),
    )
    # Equal values become one row wherever they are in one task, and then for good.
    counted = rows.where("_value IS NOT NULL AND _times > 0").groupBy(*keys, "_value")
    values = stage(counted.agg(F.sum("_times").alias("_times")), "median_values")
    sizes = values.groupBy(*keys).agg(F.sum("_times").alias("_all"), F.count(F.lit(1)).alias("_left"))
    middle = F.array((F.col("_all") + 1).cast("bigint"), (F.col("_all") + 2).cast("bigint"))
    wanted = sizes.withColumn("_rank", F.explode(F.array_distinct(F.transform(middle, lambda x: F.floor(x / 2)))))
    state = wanted.select(
        *keys, "_rank", "_left", F.lit(0).cast("bigint").alias("_below"),
        F.lit(None).cast("double").alias("_low"), F.lit(None).cast("double").alias("_high"),
    )
    state = stage(state, "median_state")
    while (state.agg(F.max("_left")).first()[0] or 0) > few:
        state = stage(_narrowed(values, state, keys, few, borders), "median_state")
    inside = _in_question(values, state, keys)
    order = Window.partitionBy(*keys, "_rank").orderBy("_value")
    upto = inside.withColumn("_upto", F.col("_below") + F.sum("_times").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    at_rank = upto.where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_times") < F.col("_rank")))
    found = at_rank.groupBy(*keys).agg(F.avg("_value").alias("median"))
    if not by:
        return found
    groups = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)]).distinct()
    named = found.withColumnsRenamed({k: f"{k}_found" for k in keys})
    joined = groups.join(named, _same(keys, [f"{k}_found" for k in keys]), "left")
    return joined.select(*[F.col(k).alias(b) for b, k in zip(by, keys)], "median")


def _same(left: list[str], right: list[str]) -> Column:
    """Equal keys, NULL being one."""
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)], F.lit(True))


def _in_question(values: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The values of each group between the borders of each rank; no border is no bound."""
    own = [f"{k}_own" for k in keys]
    above = F.col("_low").isNull() | (F.col("_value") > F.col("_low"))
    upto = F.col("_high").isNull() | (F.col("_value") <= F.col("_high"))
    groups = state.withColumnsRenamed(dict(zip(keys, own)))
    if not keys:  # two rows at most: the ranks
        groups = F.broadcast(groups)
    return values.join(groups, _same(keys, own) & above & upto).drop(*own)


def _narrowed(values: DataFrame, state: DataFrame, keys: list[str], few: int, borders: int) -> DataFrame:
    """The state after a round: nearer borders of the ranks that have more than a few values left."""
    at = [*keys, "_rank"]
    large = state.where(F.col("_left") > few)
    inside = stage(_in_question(values, large, keys), "median_inside")
    shares = F.array(*[F.lit(i / borders) for i in range(1, borders)])
    drawn = inside.groupBy(*at).agg(
        F.array_distinct(F.percentile_approx("_value", shares, ACCURACY)).alias("_borders")
    )
    own = [f"{c}_own" for c in at]
    drawn = drawn.withColumnsRenamed(dict(zip(at, own)))
    placed = inside.join(drawn, _same(at, own)).withColumn(
        # How many borders lie below the value: it is above the last of these, and up to the next.
        "_piece", F.size(F.filter("_borders", lambda b: b < F.col("_value")))
    )
    kept = [*at, "_below", "_low", "_high", "_borders"]
    pieces = placed.groupBy(*kept, "_piece").agg(
        F.sum("_times").alias("_here"), F.count(F.lit(1)).alias("_values")
    )
    before = Window.partitionBy(*at).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counted = pieces.withColumn("_under", F.col("_below") + F.coalesce(F.sum("_here").over(before), F.lit(0)))
    hit = (F.col("_under") < F.col("_rank")) & (F.col("_under") + F.col("_here") >= F.col("_rank"))
    nearer = counted.where(hit).select(
        *at,
        F.col("_values").alias("_left"),
        F.col("_under").alias("_below"),
        F.coalesce(F.get("_borders", F.col("_piece") - 1), "_low").alias("_low"),
        F.coalesce(F.get("_borders", F.col("_piece")), "_high").alias("_high"),
    )
    # A single value needs no further round, whatever the borders are.
    return state.where(F.col("_left") <= few).unionByName(nearer)
