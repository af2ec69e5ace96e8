"""Declared schemas of every table the package reads or writes."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_string, _double, _int, _long = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()

# quantity and transaction_ts stay text here: Silver parses them and quarantines what does not parse.
RAW_TRANSACTIONS = _struct(
    transaction_id=_string,
    customer_id=_string,
    product_category=_string,
    quantity=_string,
    unit_price=_double,
    transaction_amount=_double,
    payment_method=_string,
    transaction_ts=_string,
)

BRONZE_TRANSACTIONS = T.StructType(
    RAW_TRANSACTIONS.fields + _struct(_ingested_at=_string, _source_file=_string).fields
)

CUSTOMERS = _struct(customer_id=_string, signup_date=T.DateType(), region=_string, age=_double)

SILVER_TRANSACTIONS = _struct(
    transaction_id=_string,
    customer_id=_string,
    product_category=_string,
    quantity=_int,
    unit_price=_double,
    transaction_amount=_double,
    payment_method=_string,
    transaction_ts=T.TimestampNTZType(),
    _ingested_at=_string,
    _source_file=_string,
)

QUARANTINE = _struct(
    transaction_id=_string,
    customer_id=_string,
    product_category=_string,
    quantity=_string,
    transaction_amount=_double,
    _dq_failures=T.ArrayType(_string),
    _ingested_at=_string,
)

_BOUGHT = dict(
    transactions=_long,
    amounts=_long,
    units=_long,
    cents=T.DecimalType(38, 2),
    rest=_double,
    first_ts=T.TimestampNTZType(),
    last_ts=T.TimestampNTZType(),
)

PURCHASES = _struct(
    transaction_date=T.DateType(), product_category=_string, customer_id=_string, **_BOUGHT
)

CUSTOMER_PURCHASES = _struct(bucket=_int, customer_id=_string, product_category=_string, **_BOUGHT)

CATEGORY_SALES = _struct(
    transaction_date=T.DateType(),
    product_category=_string,
    total_sales=_double,
    total_units=_long,
    distinct_customers=_long,
    transaction_count=_long,
)

CUSTOMER_FEATURES = _struct(
    customer_id=_string,
    total_transactions=_long,
    lifetime_value=_double,
    avg_transaction_value=_double,
    distinct_categories_purchased=_long,
    last_purchase_ts=T.TimestampNTZType(),
    first_purchase_ts=T.TimestampNTZType(),
    days_since_last_purchase=_int,
    customer_tenure_days=_int,
    region=_string,
    age=_double,
    signup_date=T.DateType(),
    churned=_int,
)

CUSTOMER_TOTALS = T.StructType(_struct(bucket=_int).fields + CUSTOMER_FEATURES.fields[:7])

MODEL_RUNS = _struct(
    model_name=_string,
    version=_int,
    logged_at=_string,
    model_type=_string,
    num_trees=_int,
    max_depth=_int,
    min_instances_per_node=_int,
    seed=_long,
    roc_auc=_double,
    precision=_double,
    recall=_double,
    f1=_double,
    accuracy=_double,
    importances=T.ArrayType(_struct(feature=_string, importance=_double)),
    n_training_rows=_long,
    churn_rate=_double,
    promotable=T.BooleanType(),
    model_path=_string,
)

DQ_REPORT = _struct(total_rows=_long, fully_passing_rows=_long, overall_score=_double)

MODEL_REPORT = _struct(
    model_name=_string,
    model_version=_int,
    roc_auc=_double,
    threshold=_double,
    passed=T.BooleanType(),
)

METRICS_HISTORY = _struct(
    timestamp=_string,
    dq_overall_score=_double,
    dq_total_rows=_long,
    dq_fully_passing_rows=_long,
    model_roc_auc=_double,
    model_version=_int,
    model_gate_passed=T.BooleanType(),
    pipeline_duration_seconds=_double,
    failed_step=_string,
)

QUERY_LOG = _struct(
    timestamp=_string,
    question=_string,
    agent_used=_string,
    matched_intent=_string,
    answer_preview=_string,
)
