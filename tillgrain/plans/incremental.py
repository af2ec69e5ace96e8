"""Gold kept up with Silver: what new batches bring is merged into what is stored.

Two tables hold Silver added up, in parts: purchases by day (or by month, where a day is little), and
purchases of customers by bucket. Each names the batches of Silver that it is made of, in the same entry that makes its new parts current, so
an update that is repeated adds nothing twice. An update reads the new batches and the parts that they
fall into, late days included, and writes only these anew. If a batch has gone from Silver because the
table was replaced, all is added up again.

What follows from a part is made anew when the part has changed: category sales of a day, totals of the
customers of a bucket. Recency and churn depend on the latest day of all, so customer_features is a
projection over the totals, written as a whole; nothing is aggregated for customers who bought nothing.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrain import schemas, session
from tillgrain.operators import gold
from tillgrain.plans.flow import Lake
from tillgrain.session import releasing, rounds_for, slices, stage, stage_rounds, staging
from tillgrain.sources import lake, parts
from tillgrain.sources.parts import Parts

DAY = "transaction_date"
PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}
PURCHASES = T.StructType([T.StructField(parts.PART, T.StringType()), *schemas.PURCHASES.fields])
SALES = T.StructType([T.StructField(parts.PART, T.StringType()), *schemas.CATEGORY_SALES.fields])
BUCKET = "bucket"
BUCKETS = 64
ENTRY = ("customer_id", "product_category")
ROWS_PER_PIECE = 250_000  # of a part, that a task merges and writes
PIECE = "_piece"


def update_gold(
    spark: SparkSession, customers: str, tables: Lake, buckets: int = BUCKETS, period: str = "day"
) -> None:
    """Bring category_sales and customer_features up to the stored Silver.

    buckets and period say how large the parts are, and stay what they were when the tables were made.
    """
    with staging(spark), releasing(spark):
        names = parts.batches(spark, tables.silver)
        daily = Parts(spark, tables.purchases, parts.PART, PURCHASES)
        by_customer = Parts(spark, tables.customer_purchases, BUCKET, schemas.CUSTOMER_PURCHASES)
        with staging(spark):  # the news are gone when what follows from them is made
            news = _news(spark, tables, daily.state, names)
            # After an update that ended between the two, they lack different batches.
            news_of_customers = (
                news if by_customer.state == daily.state else _news(spark, tables, by_customer.state, names)
            )
            by_period = news.withColumn(parts.PART, F.date_format(DAY, PERIODS[period]))
            _add_to(daily, names, by_period, (parts.PART, DAY, *ENTRY))
            _add_to(by_customer, names, _by_customer(news_of_customers, buckets), (BUCKET, *ENTRY))
        _derive_sales(spark, tables, daily)
        totals = _derive_totals(spark, tables, by_customer)
        stored = stage(totals.read().drop(BUCKET), "totals")
        today = stored.agg(F.max("last_purchase_ts")).scalar()
        features = gold.features_from(stored, lake.read_customers(spark, customers), today)
        lake.overwrite_table(features, f"{tables.gold}/customer_features")


def _news(spark: SparkSession, tables: Lake, made_of: list[str] | None, names: list[str]) -> DataFrame:
    """Purchases of the batches that a table is not made of yet, of all if it is to be made anew."""
    known = set(made_of or [])
    new = [n for n in names if n not in known] if known <= set(names) else names
    folders = [f"{tables.silver}/{parts.BATCH}={n}" for n in new]
    reader = spark.read.schema(schemas.SILVER_TRANSACTIONS)
    rows = reader.parquet(*folders) if folders else spark.createDataFrame([], schemas.SILVER_TRANSACTIONS)
    return stage_rounds([gold.purchases(s) for s in slices(rows, "customer_id", rounds_for(rows.count()))], "news")


def _by_customer(bought: DataFrame, buckets: int) -> DataFrame:
    """Days are left apart: they are merged together with what is stored."""
    return bought.withColumn(BUCKET, F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("int"))


def _in_pieces(rows: DataFrame, column: str) -> list[DataFrame]:
    """All rows in rounds of a bounded number, each dealt by part and piece: PIECE says which piece of its
    part a row belongs to. All rows of an entry are in one piece, and a piece is in one round."""
    part = F.col(column).cast("string")
    # As many counts as there are parts, and as many pieces as there are large ones.
    counts = sorted(rows.groupBy(part.alias("part")).count().collect(), key=lambda r: str(r["part"]))
    large = [F.lit(x) for p, n in counts if n > ROWS_PER_PIECE for x in (p, -(-n // ROWS_PER_PIECE))]
    pieces = F.coalesce(F.create_map(*large)[part], F.lit(1)) if large else F.lit(1)
    marked = rows.withColumn(PIECE, F.pmod(F.xxhash64(*ENTRY), pieces).cast("int"))
    rounds, room = [], 0
    for p, n in counts:
        own = part.eqNullSafe(F.lit(p))
        if n > session.ROWS_AT_ONCE:
            turns = rounds_for(n)
            rounds += [own & (F.col(PIECE) % turns == i) for i in range(turns)]
            room = 0
        elif n <= room:
            rounds[-1], room = rounds[-1] | own, room - n
        else:
            rounds, room = [*rounds, own], session.ROWS_AT_ONCE - n
    cut = [marked.where(r) for r in rounds] if len(rounds) > 1 else [marked]
    return [rows.repartition(column, PIECE) for rows in cut]


def _add_to(table: Parts, names: list[str], news: DataFrame, keys: tuple[str, ...]) -> None:
    """Merge news into the parts they fall into."""
    if table.state == names:
        return
    # As many values as there are periods in the calendar, or buckets.
    touched = sorted(str(row[0]) for row in news.select(keys[0]).distinct().collect())
    if set(table.state or []) <= set(names):
        stored, replaced = table.read(touched), touched
    else:
        stored, replaced = table.read([]), sorted({*touched, *table.parts})
    both = stored.unionByName(news.select(*stored.columns))
    # Exchanged once, by part and piece: small parts get few files, a large day is spread over several tasks,
    # and what has the same keys is together already when it is merged.
    dealt = _in_pieces(both, keys[0])
    merged = [gold.merged(rows, *keys, PIECE).select(*stored.columns) for rows in dealt]
    table.replace(merged, replaced, names)


def _stale(made: Parts, source: Parts) -> list[str]:
    """Values whose part was made of other files than the source has now."""
    known = made.state or {}
    return sorted(v for v in {*source.parts, *known, *made.parts} if known.get(v) != source.parts.get(v))


def _derive_sales(spark: SparkSession, tables: Lake, daily: Parts) -> None:
    sales = Parts(spark, f"{tables.gold}/category_sales", parts.PART, SALES)
    stale = _stale(sales, daily)
    if stale:
        rows = gold.sales_by(daily.read(stale), parts.PART, DAY, "product_category").select(*SALES.names)
        sales.replace(rows.hint("rebalance", parts.PART), stale, daily.parts)


def _derive_totals(spark: SparkSession, tables: Lake, by_customer: Parts) -> Parts:
    totals = Parts(spark, tables.customer_totals, BUCKET, schemas.CUSTOMER_TOTALS)
    stale = _stale(totals, by_customer)
    if stale:
        rows = gold.totals_by(by_customer.read(stale), BUCKET, "customer_id")
        totals.replace(rows.select(*schemas.CUSTOMER_TOTALS.names).hint("rebalance", BUCKET), stale, by_customer.parts)
    return totals
