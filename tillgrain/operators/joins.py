"""A lookup join that stays balanced when a few keys hold most of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.session import stage

HEAVY_SHARE = 0.001
BROADCAST_BYTES = 64 * 1024 * 1024


def lookup_join(requests: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """requests left-joined to answers, which has at most one row per key.

    A key with more than HEAVY_SHARE of all keyed requests is heavy. There are fewer than
    1 / HEAVY_SHARE of those, whatever the data; their answers are staged and measured, and broadcast
    up to BROADCAST_BYTES. Beyond it they are joined by exchange, whose skew Spark splits. Other keys,
    none of them large, are exchanged. Requests without a key are not exchanged.
    """
    counts = requests.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_requests")
    )
    total = counts.agg(F.sum("_requests")).scalar()
    heavy = stage(
        counts.where(F.col("_requests") > total * HEAVY_SHARE).select(
            key, F.lit(True).alias("_heavy")
        ),
        "heavy_keys",
    )
    heavy_answers = stage(
        answers.join(F.broadcast(heavy.select(key)), key, "left_semi"), "heavy_answers"
    )
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in answers.columns]
    size = heavy_answers.agg(F.sum(sum(sizes, F.lit(16)))).first()[0] or 0
    marked = requests.join(F.broadcast(heavy), key, "left")
    exchanged = F.col("_heavy").isNull() & F.col(key).isNotNull()
    by_exchange = marked.where(exchanged).join(answers, key, "left")
    found = F.broadcast(heavy_answers) if size <= BROADCAST_BYTES else heavy_answers
    by_broadcast = marked.where(~exchanged).join(found, key, "left")
    return by_exchange.unionByName(by_broadcast).drop("_heavy")
