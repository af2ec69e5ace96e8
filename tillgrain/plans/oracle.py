"""The queries of plans.catalog in ANSI SQL over the same tables, for DuckDB."""

FEATURES = (
    ("total_transactions", 0.25),
    ("lifetime_value", 0.2),
    ("avg_transaction_value", 0.15),
    ("distinct_categories_purchased", 0.1),
    ("customer_tenure_days", 0.15),
    ("age", 0.1),
    ("region_encoded", 0.05),
)
QUALITY_RULES = {
    "not_null_customer_id": "customer_id IS NOT NULL",
    "not_null_product_category": "product_category IS NOT NULL",
    "non_negative_amount": "transaction_amount >= 0",
    "valid_quantity": "regexp_matches(quantity, '^[0-9]+$')",
}
_all_pass = " AND ".join(f"({p})" for p in QUALITY_RULES.values())
_raw = (
    "transaction_id, customer_id, product_category, quantity, unit_price, transaction_amount, "
    "payment_method, transaction_ts"
)


def _code(key: str) -> str:
    return f"'CUST' || lpad({key}::VARCHAR, greatest(6, length({key}::VARCHAR))::INTEGER, '0')"


def _hash(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE)"


# Common table expressions, each after those it uses.
_ctes = {
    "feed": f"""
        SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
               CASE WHEN b <> 0 THEN {_code("o_custkey")} END AS customer_id,
               CASE WHEN b <> 1 THEN p_type END AS product_category,
               CASE WHEN b = 2 THEN 'N/A' ELSE l_quantity::INTEGER::VARCHAR END AS quantity,
               p_retailprice AS unit_price,
               CASE WHEN b = 3 THEN -l_extendedprice ELSE l_extendedprice END AS transaction_amount,
               o_orderpriority AS payment_method,
               CASE WHEN b = 4 THEN 'not-a-date' ELSE l_shipdate::DATE::VARCHAR END AS transaction_ts,
               strftime(l_shipdate, '%Y-%m') AS batch
        FROM (SELECT *, (l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 100 AS b FROM lineitem)
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey""",
    "custs": f"""
        SELECT {_code("c_custkey")} AS customer_id,
               DATE '1992-01-01' + (c_custkey % 1000)::INTEGER AS signup_date,
               n_name AS region,
               CASE WHEN c_custkey % 67 <> 0 THEN (18 + c_custkey % 53)::DOUBLE END AS age
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "deduped": f"""
        SELECT {_raw} FROM (
            SELECT *, row_number() OVER (
                PARTITION BY transaction_id
                ORDER BY transaction_ts NULLS LAST, customer_id NULLS LAST,
                         product_category NULLS LAST, quantity NULLS LAST,
                         transaction_amount NULLS LAST, unit_price NULLS LAST,
                         payment_method NULLS LAST) AS copy
            FROM feed)
        WHERE copy = 1""",
    "tagged": """
        SELECT *, concat_ws(',',
            CASE WHEN customer_id IS NULL THEN 'null_customer_id' END,
            CASE WHEN product_category IS NULL THEN 'null_product_category' END,
            CASE WHEN qty IS NULL THEN 'invalid_quantity' END,
            CASE WHEN transaction_amount < 0 THEN 'negative_amount' END,
            CASE WHEN ts IS NULL THEN 'unparseable_timestamp' END) AS reasons
        FROM (SELECT *,
                     CASE WHEN regexp_matches(quantity, '^[0-9]+$')
                          THEN TRY_CAST(quantity AS INTEGER) END AS qty,
                     TRY_CAST(transaction_ts AS TIMESTAMP) AS ts
              FROM deduped)""",
    "clean": """
        SELECT transaction_id, customer_id, product_category, qty AS quantity, unit_price,
               transaction_amount, payment_method, ts AS transaction_ts
        FROM tagged WHERE reasons = ''""",
    "sales": """
        SELECT transaction_ts::DATE AS transaction_date, product_category,
               sum(transaction_amount::DECIMAL(18, 2))::DOUBLE AS total_sales,
               sum(quantity)::BIGINT AS total_units,
               count(DISTINCT customer_id) AS distinct_customers,
               count(transaction_id) AS transaction_count
        FROM clean GROUP BY ALL""",
    "features": """
        SELECT customer_id, total_transactions, lifetime_value,
               lifetime_value / total_transactions AS avg_transaction_value,
               distinct_categories_purchased, last_purchase_ts, first_purchase_ts,
               days AS days_since_last_purchase,
               date_diff('day', first_purchase_ts::DATE, last_purchase_ts::DATE)::INTEGER
                   AS customer_tenure_days,
               region, age, signup_date, CASE WHEN days > 60 THEN 1 ELSE 0 END AS churned
        FROM (SELECT *, date_diff('day', last_purchase_ts::DATE,
                            (SELECT max(transaction_ts)::DATE FROM clean))::INTEGER AS days
              FROM (SELECT customer_id, count(transaction_id) AS total_transactions,
                           sum(transaction_amount::DECIMAL(18, 2))::DOUBLE AS lifetime_value,
                           count(DISTINCT product_category) AS distinct_categories_purchased,
                           max(transaction_ts) AS last_purchase_ts,
                           min(transaction_ts) AS first_purchase_ts
                    FROM clean GROUP BY customer_id))
        LEFT JOIN custs USING (customer_id)""",
    "encoded": """
        SELECT f.* EXCLUDE (region, age), coalesce(f.region, 'UNKNOWN') AS region,
               coalesce(f.age, (SELECT median(age) FROM features)) AS age, region_encoded
        FROM features f JOIN (
            SELECT region, (row_number() OVER (ORDER BY region) - 1)::INTEGER AS region_encoded
            FROM (SELECT DISTINCT coalesce(region, 'UNKNOWN') AS region FROM features)) codes
        ON coalesce(f.region, 'UNKNOWN') = codes.region""",
    "scored": """
        SELECT *, round(1.0::DOUBLE / (1.0::DOUBLE + total_transactions / 10.0::DOUBLE), 6) AS score
        FROM encoded""",
    "long": "UNION ALL".join(
        f""" SELECT customer_id, churned, {i} AS position, '{f}' AS feature,
               {f}::DOUBLE AS value, {w}::DOUBLE AS importance FROM encoded """
        for i, (f, w) in enumerate(FEATURES)
    ),
    "stats": """
        SELECT feature, avg(value) AS mean, stddev_samp(value) AS std FROM long GROUP BY feature""",
    "profiles": """
        SELECT feature, avg(value) FILTER (churned = 1) AS churned_avg,
               avg(value) FILTER (churned = 0) AS retained_avg
        FROM long GROUP BY feature""",
    "zscores": """
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(weight) DESC, position)
                      AS factor_rank
        FROM (SELECT long.*, importance * (value - mean) / (std + 1e-9::DOUBLE) AS weight
              FROM long JOIN stats USING (feature))""",
    "leanings": """
        SELECT *, CASE WHEN weight > 0 THEN 'typical of customers who churn'
                       ELSE 'typical of customers who stay' END AS direction,
               row_number() OVER (PARTITION BY customer_id ORDER BY abs(weight) DESC, position)
                   AS factor_rank
        FROM (SELECT long.*,
                     importance * (abs(value - retained_avg) - abs(value - churned_avg))
                         / (abs(churned_avg - retained_avg) + 1e-9::DOUBLE) AS weight
              FROM long JOIN profiles USING (feature))""",
    "risk": """
        SELECT customer_id, score AS churn_risk_score, band AS risk_band,
               'Customer ' || customer_id || ' has a ' || printf('%.0f', score * 100)
               || '% churn risk score, which is ' || band || '. The biggest factors are: '
               || phrases || '.' AS answer
        FROM (SELECT *, CASE WHEN score >= 0.6 THEN 'high' WHEN score >= 0.3 THEN 'moderate'
                             ELSE 'low' END AS band FROM scored)
        JOIN (SELECT customer_id,
                     string_agg(label || ' (' || direction || ')', ', ' ORDER BY factor_rank) AS phrases
              FROM leanings JOIN (VALUES
                  ('customer_tenure_days', 'how long they''ve been a customer'),
                  ('lifetime_value', 'their total lifetime spend'),
                  ('total_transactions', 'how many purchases they''ve made'),
                  ('distinct_categories_purchased', 'how many different categories they buy from'),
                  ('avg_transaction_value', 'their average order size'),
                  ('age', 'their age'),
                  ('region_encoded', 'their region')) labels(feature, label) USING (feature)
              WHERE factor_rank <= 3 GROUP BY customer_id) USING (customer_id)""",
    "asked": f"""
        SELECT 'c-' || c_custkey AS question_id, CASE c_custkey % 4
                   WHEN 0 THEN 'Why is customer ' || {_code("c_custkey")} || ' high risk?'
                   WHEN 1 THEN 'Is ' || lower({_code("c_custkey")}) || ' likely to churn?'
                   WHEN 2 THEN 'Show customer ' || {_code("c_custkey")}
                   ELSE 'why did ' || {_code("c_custkey")} || '1 leave' END AS question
        FROM customer
        UNION ALL
        SELECT 'p-' || p_partkey, CASE p_partkey % 10
                   WHEN 0 THEN 'What is the total sales for ' || p_type || '?'
                   WHEN 1 THEN 'How many distinct customers bought ' || p_type || '?'
                   WHEN 2 THEN 'how much did we sell in ' || p_name
                   WHEN 3 THEN 'What were the top ' || p_size || ' selling categories?'
                   WHEN 4 THEN 'best categories'
                   WHEN 5 THEN 'What is the churn rate?'
                   WHEN 6 THEN 'What is the total revenue?'
                   WHEN 7 THEN 'total sales for   ?'
                   WHEN 8 THEN 'Total sales of  ' || substr(p_type, 1, 3) || '  '
                   ELSE 'how many customers purchased ' || lower(substr(p_type, 2, 1)) END
        FROM part
        UNION ALL
        SELECT 't-' || conv_id || '-' || turn, text FROM conversations WHERE role = 'user'""",
    "routed": r"""
        SELECT question_id, question,
               CASE WHEN explain THEN 'churn_explainer' ELSE 'text_to_sql' END AS agent_used,
               CASE WHEN explain THEN 'customer_risk_explanation' ELSE report END AS intent,
               CASE WHEN explain THEN cid END AS customer_id,
               CASE WHEN NOT explain AND report = 'top_categories'
                    THEN coalesce(nullif(regexp_extract(t, 'top\s+(\d+)', 1), ''), '5') END AS top_n,
               CASE WHEN explain THEN NULL
                    WHEN report = 'category_total' THEN nullif(trim(
                        CASE WHEN for_total THEN regexp_extract(t, 'total sales (?:for|in|of)\s+([a-z &]+)', 1)
                             ELSE regexp_extract(t, 'how much.*sell.*(?:in|for)\s+([a-z &]+)', 1) END), '')
                    WHEN report = 'category_customers' THEN nullif(trim(regexp_extract(
                        t, 'how many (?:distinct )?customers.*(?:bought|purchased)\s+([a-z &]+)', 1)), '')
               END AS category
        FROM (SELECT *, cid <> '' AND (contains(low, 'risk') OR contains(low, 'why')
                        OR contains(low, 'likely to churn')) AS explain,
                     CASE WHEN regexp_matches(t, 'top\s+(\d+)?.*(selling|sales).*categor')
                            OR regexp_matches(t, '(best|top).*categor') THEN 'top_categories'
                          WHEN for_total OR in_total THEN 'category_total'
                          WHEN contains(t, 'churn rate')
                            OR (contains(t, 'how many') AND contains(t, 'churn')) THEN 'churn_rate'
                          WHEN contains(t, 'total revenue') OR contains(t, 'total sales')
                            OR contains(t, 'how much did we sell') THEN 'total_revenue'
                          WHEN regexp_matches(t, 'how many (?:distinct )?customers.*(?:bought|purchased)\s+([a-z &]+)')
                            THEN 'category_customers'
                          ELSE 'unmatched' END AS report
              FROM (SELECT *,
                           regexp_matches(t, 'total sales (?:for|in|of)\s+([a-z &]+)') AS for_total,
                           regexp_matches(t, 'how much.*sell.*(?:in|for)\s+([a-z &]+)') AS in_total
                    FROM (SELECT question_id, question, lower(question) AS low,
                                 regexp_replace(lower(question), '^\s+|\s+$', '', 'g') AS t,
                                 upper(regexp_extract(question, '(?i)(CUST[0-9]{6})', 1)) AS cid
                          FROM asked)))""",
    "by_category": """
        SELECT product_category, sum(total_sales::DECIMAL(18, 2))::DOUBLE AS total_sales,
               sum(total_units)::BIGINT AS total_units,
               sum(distinct_customers)::BIGINT AS approx_distinct_customers
        FROM sales GROUP BY product_category""",
    "slots": """
        SELECT slot, intent, product_category, total_sales, total_units, approx_distinct_customers
        FROM (SELECT *, row_number() OVER (PARTITION BY slot, intent ORDER BY
                        CASE WHEN intent = 'category_total' THEN total_sales
                             ELSE approx_distinct_customers END DESC, product_category) AS pick
              FROM (SELECT DISTINCT category AS slot, intent FROM routed WHERE category IS NOT NULL)
              JOIN by_category ON contains(lower(product_category), slot))
        WHERE pick = 1""",
    "ranked": """
        SELECT *, row_number() OVER (ORDER BY total_sales DESC, product_category) AS rank
        FROM by_category""",
    "tops": """
        SELECT top_n, 'Top ' || top_n || ' categories by total sales:' || chr(10)
               || coalesce(string_agg(rank || '. ' || product_category || ' — $'
                    || format('{:,.2f}', total_sales) || ' (' || total_units || ' units)', chr(10)
                    ORDER BY rank), '') AS answer
        FROM (SELECT DISTINCT top_n FROM routed WHERE top_n IS NOT NULL)
        LEFT JOIN ranked ON rank <= top_n::INTEGER GROUP BY top_n""",
    "answered": """
        SELECT question_id, question, agent_used,
               CASE WHEN routed.intent IN ('category_total', 'category_customers')
                         AND slots.slot IS NULL THEN 'unmatched' ELSE routed.intent END AS matched_intent,
               CASE WHEN routed.intent = 'churn_rate' THEN 'customer_features'
                    WHEN routed.intent IN ('top_categories', 'category_total', 'total_revenue',
                                           'category_customers') THEN 'category_sales'
               END AS source_table,
               CASE routed.intent
                   WHEN 'top_categories' THEN 'SELECT product_category, SUM(total_sales) AS '
                       || 'total_sales, SUM(total_units) AS total_units FROM category_sales GROUP BY '
                       || 'product_category ORDER BY total_sales DESC, product_category LIMIT '
                       || routed.top_n
                   WHEN 'category_total' THEN 'SELECT product_category, SUM(total_sales) AS '
                       || 'total_sales, SUM(total_units) AS total_units FROM category_sales WHERE '
                       || 'lower(product_category) LIKE ''%' || category
                       || '%'' GROUP BY product_category ORDER BY total_sales DESC, '
                       || 'product_category LIMIT 1'
                   WHEN 'churn_rate' THEN 'SELECT COUNT(*) AS total_customers, SUM(churned) AS '
                       || 'churned_customers, ROUND(AVG(churned) * 100, 1) AS churn_rate_pct '
                       || 'FROM customer_features'
                   WHEN 'total_revenue' THEN
                       'SELECT SUM(total_sales) AS total_revenue FROM category_sales'
                   WHEN 'category_customers' THEN 'SELECT product_category, '
                       || 'SUM(distinct_customers) AS approx_distinct_customers FROM category_sales '
                       || 'WHERE lower(product_category) LIKE ''%' || category
                       || '%'' GROUP BY product_category ORDER BY approx_distinct_customers DESC, '
                       || 'product_category LIMIT 1'
               END AS sql,
               CASE routed.intent
                   WHEN 'customer_risk_explanation' THEN coalesce(risk.answer,
                       'I don''t have a record for customer ' || routed.customer_id
                       || '. Check the ID -- customer IDs look like CUST000279.')
                   WHEN 'churn_rate' THEN (SELECT sum(churned) || ' of ' || count(*)
                       || ' customers are flagged as churned ('
                       || round(avg(churned) * 100, 1) || '%).' FROM features)
                   WHEN 'total_revenue' THEN (SELECT 'Total revenue across all categories: $'
                       || format('{:,.2f}', sum(total_sales::DECIMAL(18, 2))::DOUBLE) || '.' FROM sales)
                   WHEN 'top_categories' THEN tops.answer
                   WHEN 'unmatched' THEN 'I don''t have a query pattern for that yet. I can answer '
                       || 'questions about: top selling categories, total sales/revenue, sales for a '
                       || 'specific category, and overall churn rate. For customer-specific risk '
                       || 'questions, ask "why is customer <ID> high risk" instead.'
                   ELSE CASE
                       WHEN slots.slot IS NULL THEN 'I couldn''t find a category matching '''
                           || coalesce(array_to_string(list_transform(string_split(category, ' '),
                                  lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), ' '), '') || '''.'
                       WHEN routed.intent = 'category_total' THEN product_category || ': $'
                           || format('{:,.2f}', total_sales) || ' in total sales ('
                           || total_units || ' units).'
                       ELSE 'Roughly ' || approx_distinct_customers || ' distinct customers '
                           || '(summed across days -- see note) bought ' || product_category || '.'
                   END
               END AS answer
        FROM routed
        LEFT JOIN slots ON routed.category = slots.slot AND routed.intent = slots.intent
        LEFT JOIN tops ON routed.top_n = tops.top_n
        LEFT JOIN risk ON routed.customer_id = risk.customer_id""",
    "log": """
        SELECT question, agent_used, matched_intent,
               CASE WHEN length(answer) > 120 THEN substr(answer, 1, 120) || '...'
                    ELSE answer END AS answer_preview
        FROM answered""",
    "batches": f"""
        SELECT batch, count(*) AS total_rows, count(*) FILTER ({_all_pass}) AS fully_passing_rows,
               round(count(*) FILTER ({_all_pass}) / count(*), 4) AS overall_score
        FROM feed GROUP BY batch""",
    "monthly": """
        SELECT year(transaction_ts) * 12 + month(transaction_ts) AS version, customer_id,
               -count(*) AS score, any_value(f.churned) AS churned
        FROM clean JOIN features f USING (customer_id) GROUP BY 1, 2""",
    "runs": """
        SELECT 'churn-model' AS model_name, version::INTEGER AS version,
               round(sum(pos * (below + 0.5::DOUBLE * neg)) / nullif(sum(pos) * sum(neg), 0), 6) AS roc_auc,
               version % 5 <> 0 AS promotable
        FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY version ORDER BY score
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
              FROM (SELECT version, score, count(*) FILTER (churned = 1) AS pos,
                           count(*) FILTER (churned = 0) AS neg
                    FROM monthly GROUP BY version, score))
        GROUP BY version""",
    "promotions": """
        SELECT *, promotable AND (production_auc_before IS NULL
                                  OR coalesce(roc_auc > production_auc_before, false)) AS promoted
        FROM (SELECT *, max(CASE WHEN promotable THEN roc_auc END) OVER (
                            ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                        AS production_auc_before
              FROM runs)""",
    "production": """
        SELECT model_name, version, roc_auc FROM promotions WHERE promoted
        ORDER BY version DESC LIMIT 1""",
    "history": """
        SELECT batch || '-01T00:00:00+00:00' AS timestamp, overall_score AS dq_overall_score,
               total_rows AS dq_total_rows, fully_passing_rows AS dq_fully_passing_rows,
               roc_auc AS model_roc_auc, version AS model_version,
               roc_auc >= 0.5 AS model_gate_passed,
               round(total_rows / 7.0::DOUBLE, 2) AS pipeline_duration_seconds,
               CASE WHEN overall_score < 0.96 THEN 'quality_gate' END AS failed_step
        FROM batches LEFT JOIN runs
        ON overall_score >= 0.96
           AND batch = printf('%04d-%02d', (version - 1) // 12, (version - 1) % 12 + 1)""",
}


def _with(*needed: str) -> str:
    """The WITH clause of the expressions needed; unused ones before them cost nothing."""
    names = list(_ctes)
    last = max(names.index(n) for n in needed)
    return "WITH " + ",\n".join(f"{n} AS ({_ctes[n]})" for n in names[: last + 1]) + "\n"


def _score(rows: str) -> str:
    return f"""
        count(*) AS total_rows, count(*) FILTER ({_all_pass}) AS fully_passing_rows,
        round(count(*) FILTER ({_all_pass}) / count(*), 4) AS overall_score
        FROM {rows}"""


def _auc(rows: str) -> str:
    """AUC of rows(score, churned)."""
    return f"""
        SELECT sum(pos * (below + 0.5::DOUBLE * neg)) / nullif(sum(pos) * sum(neg), 0) AS roc_auc
        FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
              FROM (SELECT score, count(*) FILTER (churned = 1) AS pos,
                           count(*) FILTER (churned = 0) AS neg
                    FROM ({rows}) GROUP BY score))"""


_roll = _hash(
    "concat_ws('|', transaction_id, coalesce(customer_id, ''), coalesce(product_category, ''), "
    "quantity, payment_method, transaction_ts)"
)
_corrupted = f"""
    (SELECT transaction_id, customer_id,
            CASE WHEN {_roll} >= 0.3::DOUBLE THEN product_category END AS product_category,
            quantity, unit_price,
            CASE WHEN {_roll} < 0.3::DOUBLE THEN -transaction_amount ELSE transaction_amount END
                AS transaction_amount,
            payment_method, transaction_ts
     FROM feed)"""
_received = _with("feed") + f"SELECT {_raw}, true AS has_time, true AS has_file FROM feed"
_leaks = "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, ({_auc(f'SELECT {c} AS score, churned FROM encoded')}) AS auc"
    for c in (*[f for f, _ in FEATURES], "days_since_last_purchase")
)

_BOTH_SILVER = (
    _with("tagged")
    + """
        SELECT transaction_id, customer_id, product_category, quantity, transaction_amount,
               CASE WHEN reasons = '' THEN unit_price END AS unit_price,
               CASE WHEN reasons = '' THEN payment_method END AS payment_method,
               CASE WHEN reasons = '' THEN ts END AS transaction_ts, reasons AS _dq_failures
        FROM tagged"""
)

ORACLE: dict[str, str] = {
    "bronze_feed": _with("feed") + f"SELECT {_raw} FROM feed",
    "dirty_feed": _with("feed")
    + f"""
        SELECT transaction_id,
               CASE WHEN issue = 2 THEN NULL ELSE customer_id END AS customer_id,
               CASE WHEN issue = 0 THEN NULL ELSE product_category END AS product_category,
               CASE WHEN issue = 4 THEN 'N/A' ELSE quantity END AS quantity, unit_price,
               CASE WHEN issue = 1 THEN -abs(transaction_amount) ELSE transaction_amount END
                   AS transaction_amount,
               payment_method, transaction_ts
        FROM (SELECT *, floor({_hash("transaction_id")} / 0.05::DOUBLE * 5) AS issue FROM feed)
        JOIN (VALUES (1), (2)) copies(copy) ON copy = 1 OR issue = 3""",
    "customers_csv": _with("custs") + "SELECT * FROM custs",
    "bronze_ingest": _received,
    "bronze_replay": _with("feed")
    + f"SELECT {_score('(SELECT * FROM feed UNION ALL SELECT * FROM feed)')}",
    "stream_bronze": _received,
    "dq_rule_report": _with("feed")
    + " UNION ALL ".join(
        f"""
        SELECT '{name}' AS rule, count(*) FILTER ({p}) AS passing_rows,
               count(*) - count(*) FILTER ({p}) AS failing_rows,
               round(count(*) FILTER ({p}) / count(*), 4) AS pass_rate FROM feed"""
        for name, p in QUALITY_RULES.items()
    ),
    "dq_overall": _with("feed") + f"SELECT {_score('feed')}",
    "dq_gate": _with("feed")
    + f"""
        SELECT *, 0.9::DOUBLE AS threshold, overall_score >= 0.9 AS passed
        FROM (SELECT {_score("feed")})""",
    "dq_by_batch": _with("batches") + "SELECT * FROM batches",
    "dq_report_json": _with("feed")
    + f"""
        SELECT *, 0.9::DOUBLE AS threshold, overall_score >= 0.9 AS passed
        FROM (SELECT {_score("feed")})""",
    "shuffled_feed": _with("feed") + f"SELECT {_raw} FROM feed",
    "corrupt_rows": _with("feed") + f"SELECT * FROM {_corrupted}",
    "incident_report": _with("feed")
    + f"""
        SELECT *, 0.9::DOUBLE AS threshold, overall_score >= 0.9 AS passed
        FROM (SELECT 'before' AS batch, {_score("feed")}
              UNION ALL SELECT 'after', {_score(_corrupted)})""",
    "incident_gate": _with("feed")
    + f"""
        SELECT *, 0.9::DOUBLE AS threshold, overall_score >= 0.9 AS passed
        FROM (SELECT {_score(_corrupted)})""",
    "dedup_transactions": _with("deduped") + "SELECT * FROM deduped",
    "silver_clean": _with("clean") + "SELECT * FROM clean",
    "silver_quarantine": _with("tagged")
    + """
        SELECT transaction_id, customer_id, product_category, quantity, transaction_amount,
               reasons AS _dq_failures
        FROM tagged WHERE reasons <> ''""",
    "silver_flow": _with("tagged")
    + """
        SELECT input_rows, clean_rows, quarantined_rows,
               round(clean_rows / input_rows, 4) AS clean_share,
               round(quarantined_rows / input_rows, 4) AS quarantined_share
        FROM (SELECT (SELECT count(*) FROM feed) AS input_rows,
                     count(*) FILTER (reasons = '') AS clean_rows,
                     count(*) FILTER (reasons <> '') AS quarantined_rows FROM tagged)""",
    "quarantine_reasons": _with("tagged")
    + """
        SELECT reason, count(*) AS rows
        FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM tagged WHERE reasons <> '')
        GROUP BY reason""",
    "stored_silver": _with("tagged")
    + """
        SELECT transaction_id, customer_id, product_category, transaction_amount,
               reasons <> '' AS quarantined
        FROM tagged""",
    "stream_dedup": _BOTH_SILVER,
    "silver_incremental": _BOTH_SILVER,
    "two_streams_silver": _BOTH_SILVER,
    "two_streams_bronze": _received,
    "stream_and_batch": _received,
    "category_sales": _with("sales") + "SELECT * FROM sales",
    "customer_features": _with("features") + "SELECT * FROM features",
    "gold_incremental": _with("sales") + "SELECT * FROM sales",
    "features_incremental": _with("features") + "SELECT * FROM features",
    "churn_summary": _with("features")
    + """
        SELECT count(*) AS total_customers, sum(churned)::BIGINT AS churned_customers,
               round(avg(churned) * 100, 1) AS churn_rate_pct FROM features""",
    "total_revenue": _with("sales")
    + "SELECT sum(total_sales::DECIMAL(18, 2))::DOUBLE AS total_revenue FROM sales",
    "top_categories": _with("by_category")
    + """
        SELECT product_category, total_sales, total_units FROM by_category
        ORDER BY total_sales DESC, product_category LIMIT 5""",
    "category_total": _with("by_category")
    + """
        SELECT product_category, total_sales, total_units FROM by_category
        WHERE lower(product_category) LIKE '%m%'""",
    "category_customers": _with("by_category")
    + """
        SELECT product_category, approx_distinct_customers FROM by_category
        WHERE lower(product_category) LIKE '%ar%'""",
    "gold_views": _with("features")
    + """
        SELECT 'category_sales' AS source, count(*) AS rows,
               sum(transaction_count)::BIGINT AS measure FROM sales
        UNION ALL SELECT 'customer_features', count(*), sum(churned)::BIGINT FROM features""",
    "features_encoded": _with("encoded")
    + f"SELECT customer_id, {', '.join(f for f, _ in FEATURES)}, region, churned FROM encoded",
    "label_stats": _with("features")
    + "SELECT count(*) AS n_rows, round(avg(churned), 4) AS churn_rate FROM features",
    "class_weights": _with("features")
    + """
        SELECT churned, count(*) AS n_rows,
               (SELECT count(*) FROM features)
                   / ((SELECT count(DISTINCT churned) FROM features) * count(*)) AS weight
        FROM features GROUP BY churned""",
    "weighted_rows": _with("features")
    + """
        SELECT customer_id, churned, (SELECT count(*) FROM features)
                   / ((SELECT count(DISTINCT churned) FROM features)
                      * count(*) OVER (PARTITION BY churned)) AS weight
        FROM features""",
    "train_test_split": _with("features")
    + """
        SELECT customer_id, churned,
               row_number() OVER (PARTITION BY churned ORDER BY md5(customer_id), customer_id)
                   <= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY churned)) AS is_test
        FROM features""",
    "roc_auc": _with("scored")
    + f"SELECT round(roc_auc, 9) AS roc_auc FROM ({_auc('SELECT score, churned FROM scored')})",
    "classification_metrics": _with("scored")
    + """
        SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
               coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
               coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
               coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0.0) AS accuracy
        FROM (SELECT count(*) FILTER (score > 0.2 AND churned = 1) AS tp,
                     count(*) FILTER (score > 0.2 AND churned = 0) AS fp,
                     count(*) FILTER (score <= 0.2 AND churned = 1) AS fn,
                     count(*) FILTER (score <= 0.2 AND churned = 0) AS tn,
                     count(*) FILTER (score IS NULL OR churned IS NULL) AS unscored_rows FROM scored)""",
    "baseline_auc": _with("features")
    + _auc(
        """SELECT (SELECT CASE WHEN avg(churned) > 0.5 THEN 1.0 ELSE 0.0 END FROM features) AS score,
                  churned FROM features"""
    ),
    "leakage_check": _with("encoded")
    + f"""
        SELECT feature, round(greatest(auc, 1 - auc), 9) AS single_feature_auc,
               greatest(auc, 1 - auc) >= 0.999 AS leaks
        FROM ({_leaks})""",
    "promotion_history": _with("promotions") + "SELECT * FROM promotions",
    "production_model": _with("production") + "SELECT * FROM production",
    "model_gate": _with("production")
    + """
        SELECT model_name, version AS model_version, roc_auc, 0.75::DOUBLE AS threshold,
               coalesce(roc_auc >= 0.75, false) AS passed FROM production""",
    "feature_stats": _with("stats")
    + "SELECT feature, round(mean, 4) AS mean, round(std, 4) AS std FROM stats",
    "reference_profiles": _with("profiles")
    + """
        SELECT feature, round(churned_avg, 4) AS churned_avg,
               round(retained_avg, 4) AS retained_avg FROM profiles""",
    "explain_zscore": _with("zscores")
    + """
        SELECT customer_id, factor_rank::INTEGER AS factor_rank, feature,
               round(value, 6) AS value, round(weight, 6) AS weight,
               CASE WHEN weight > 0 THEN 'increases' ELSE 'decreases' END AS direction
        FROM zscores WHERE factor_rank <= 4""",
    "explain_profile": _with("leanings")
    + """
        SELECT customer_id, factor_rank::INTEGER AS factor_rank, feature,
               round(value, 6) AS value, round(weight, 6) AS weight, direction
        FROM leanings WHERE factor_rank <= 3""",
    "risk_bands": _with("scored")
    + f"""
        SELECT customer_id, round(score, 4) AS churn_risk_score, {", ".join(f for f, _ in FEATURES)},
               CASE WHEN round(score, 4) >= 0.6 THEN 'high' WHEN round(score, 4) >= 0.3 THEN 'moderate'
                    ELSE 'low' END AS risk_band
        FROM scored""",
    "risk_answers": _with("risk") + "SELECT * FROM risk",
    "route_questions": _with("routed") + "SELECT * EXCLUDE (question) FROM routed",
    "answer_questions": _with("answered") + "SELECT * EXCLUDE (question) FROM answered",
    "lookup_customers": _with("scored")
    + f"""
        SELECT request_id, customer_id, score AS churn_risk_score, total_transactions,
               score IS NOT NULL AS found
        FROM (SELECT o_orderkey AS request_id,
                     CASE WHEN o_orderkey % 3 = 0 THEN 'CUST000001'
                          WHEN o_orderkey % 7 = 0 THEN 'X' || o_custkey
                          ELSE {_code("o_custkey")} END AS customer_id
              FROM orders) LEFT JOIN scored USING (customer_id)""",
    "query_log": _with("log") + "SELECT * FROM log",
    "run_record": _with("history") + "SELECT * FROM history",
    "run_history": _with("history")
    + "SELECT * REPLACE (substr(timestamp, 1, 10) AS timestamp) FROM history",
    "run_kpis": _with("history")
    + """
        SELECT count(*) AS total_runs,
               (SELECT dq_overall_score FROM history ORDER BY timestamp DESC LIMIT 1)
                   AS latest_dq_score,
               (SELECT model_roc_auc FROM history ORDER BY timestamp DESC LIMIT 1)
                   AS latest_model_roc_auc,
               count(*) FILTER (dq_overall_score < 0.96) AS dq_failures,
               count(*) FILTER (NOT model_gate_passed) AS model_failures
        FROM history""",
    "intent_distribution": _with("log")
    + "SELECT matched_intent, count(*) AS queries FROM log GROUP BY matched_intent",
    "unmatched_rate": _with("log")
    + """
        SELECT count(*) AS total_queries,
               round(avg(CASE WHEN matched_intent = 'unmatched' THEN 1.0::DOUBLE
                              ELSE 0.0::DOUBLE END), 9) AS unmatched_rate
        FROM log""",
    "full_run": _with("feed")
    + f"""
        SELECT overall_score AS dq_overall_score, total_rows AS dq_total_rows,
               fully_passing_rows AS dq_fully_passing_rows, 1 AS model_version,
               true AS model_gate_passed, true AS complete
        FROM (SELECT {_score("feed")})""",
    "resumed_run": _with("feed", "clean")
    + """
        SELECT 2::BIGINT AS runs, 1::BIGINT AS failed_at_the_gate, 1::BIGINT AS complete,
               1 AS model_version, (SELECT count(*) FROM feed) AS bronze_rows,
               (SELECT count(*) FROM clean) AS silver_rows, 1::BIGINT AS trained""",
    "highest_risk": _with("scored")
    + """
        SELECT customer_id, region, lifetime_value, days_since_last_purchase,
               score AS churn_risk_score
        FROM scored ORDER BY score DESC, customer_id LIMIT 10""",
    # A fitted forest has no SQL: what must hold of it has.
    "churn_model_properties": _with("features")
    + """
        SELECT count(*) AS rows_scored, true AS scores_in_range, 7::BIGINT AS importances,
               true AS importances_sum_to_one, true AS better_than_chance FROM features""",
    "category_reach_check": _with("clean")
    + """
        SELECT product_category, count(DISTINCT customer_id) AS distinct_customers,
               true AS estimate_within_5_percent
        FROM clean GROUP BY product_category""",
    "production_scores": _with("features")
    + "SELECT customer_id, 1 AS model_version, true AS score_in_range FROM features",
    "production_answers": _with("routed", "features")
    + """
        SELECT question_id, routed.intent = 'customer_risk_explanation' AS asks_for_risk,
               CASE WHEN features.customer_id IS NOT NULL THEN 1 END AS model_version,
               features.customer_id IS NOT NULL AS has_evidence, true AS consistent
        FROM routed LEFT JOIN features ON routed.customer_id = features.customer_id""",
}
