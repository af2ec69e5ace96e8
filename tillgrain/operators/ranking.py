"""Running totals over a global order, without a window that holds all rows in one task."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.session import stage


def running_totals(
    df: DataFrame,
    totals: Sequence[str],
    order: Sequence[str],
    bucket: str,
    within: Sequence[str] = (),
) -> DataFrame:
    """Add running_<t> for each t of totals: its sum up to and including the row.

    bucket must not decrease along the order. Rows are windowed inside (within, bucket) only; what
    comes before a bucket is a window over one row per bucket. The join and the inner window use
    the same keys, so the rows are exchanged once.
    """
    cell = [*within, bucket]
    keys = [f"_cell_{c}" for c in cell]
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*cell)
        .agg(*[F.sum(t).alias(t) for t in totals])
        .select(
            *[F.col(c).alias(k) for c, k in zip(cell, keys)],
            *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"_before_{t}") for t in totals],
        )
    )
    inside = (
        Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    # NULL groups are groups: an equality that is never true for them would lose their rows.
    same_cell = reduce(and_, [df[c].eqNullSafe(offsets[k]) for c, k in zip(cell, keys)])
    return (
        df.join(offsets, same_cell)
        .withColumns({f"running_{t}": F.sum(t).over(inside) + F.col(f"_before_{t}") for t in totals})
        .drop(*keys, *[f"_before_{t}" for t in totals])
    )


def with_range_bucket(df: DataFrame, order: Sequence[str | Column], name: str = "_bucket") -> DataFrame:
    """df staged with a bucket that does not decrease along the order: the partition of a range
    exchange.

    There are as many buckets as the session has shuffle partitions, of about equal size whatever the
    number of rows, and a group that stands first in the order is cut by itself. Staged, because the
    ranges are drawn from a sample and must be the same for everything that reads the buckets.
    """
    ranged = df.repartitionByRange(*order).withColumn(name, F.spark_partition_id())
    return stage(ranged, "range_buckets")


def numbered(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """df with the place of each row in the order, from 1 on.

    Rows are numbered within ranges of the order, and every range goes on where the one before it ends.
    What the driver adds up is one number for each range, of which there are as many as partitions.
    """
    ranged = with_range_bucket(df, order, "_range")
    sizes = {r["_range"]: r["count"] for r in ranged.groupBy("_range").count().collect()}
    if not sizes:
        return ranged.withColumn("_range", F.lit(0).cast("bigint")).withColumnRenamed("_range", name)
    before, pairs = 0, []
    for bucket in sorted(sizes):
        pairs += [F.lit(bucket), F.lit(before).cast("bigint")]
        before += sizes[bucket]
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn(name, within + F.create_map(*pairs)[F.col("_range")]).drop("_range")
