"""DuckDB SQL for the registered queries, written apart from the Spark code.

Each query is a chain of named parts: feeds over the test tables, silver, gold, view.
"""

PLACES = (
    "['New York, NY', 'Boston, MA', 'Los Angeles, CA', 'Phoenix, AZ', 'Miami, FL', "
    "'Denver, CO', 'Chicago, IL', 'Atlanta, GA', 'Austin, TX', 'Seattle, WA']"
)


def pad(expr: str, width: int) -> str:
    text = f"CAST({expr} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"


def half_up(part: str, whole: str, places: int = 2) -> str:
    """100 * part / whole rounded half up, in whole numbers."""
    scale = 10**places
    a = f"(abs(CAST({part} AS HUGEINT)) * {200 * scale} + {whole}) // (2 * {whole})"
    return f"CASE WHEN {whole} <> 0 THEN sign({part}) * CAST({a} AS DOUBLE) / {scale}.0 END"


# ---- feeds -------------------------------------------------------------------------------------

FEEDS = {
    "f_customers": f"""
        SELECT {pad('c_custkey', 5)} AS customer_id,
               CASE c_custkey % 50 WHEN 7 THEN NULL WHEN 8 THEN 'Mono'
                    WHEN 9 THEN 'Mary Ann Last' || c_custkey
                    ELSE 'First' || c_nationkey || ' Last' || c_custkey END AS name,
               CASE WHEN c_custkey % 20 <> 3 THEN 'c' || c_custkey || '@example.com' END AS email,
               CASE WHEN c_custkey % 20 <> 4 THEN '555' || {pad('c_custkey', 7)} END AS phone,
               DATE '2020-01-01' + CAST(c_custkey % 1400 AS INTEGER) AS signup_date,
               CASE WHEN c_custkey % 40 = 5 THEN 'Nowhere'
                    ELSE {PLACES}[c_nationkey % 10 + 1] END AS location
        FROM customer""",
    "f_transactions": f"""
        SELECT {pad('o_orderkey', 6)} AS transaction_id,
               CASE WHEN o_orderkey % 97 = 0 OR o_custkey % 25 = 0 THEN 'GUEST'
                    ELSE {pad('o_custkey', 5)} END AS customer_id,
               CAST(o_orderdate AS DATE) + 8218 AS transaction_date,
               CASE WHEN o_orderkey % 101 <> 0
                    THEN CAST(round(o_totalprice, 2) AS DECIMAL(18, 2)) END AS amount,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'UPI' WHEN '2' THEN 'Credit Card'
                    WHEN '3' THEN 'Debit Card' WHEN '4' THEN 'Cash' WHEN '5' THEN ' Wallet ' END
                    AS payment_method,
               CASE WHEN o_orderkey % 60 = 11 THEN 'Nowhere'
                    ELSE {PLACES}[o_orderkey % 10 + 1] END AS store_location
        FROM orders""",
    "f_support": f"""
        SELECT 'T' || {pad('event_id', 6)} AS ticket_id,
               CASE WHEN event_id % 89 = 0 THEN 'GUEST' ELSE {pad('user_id', 5)} END
                    AS customer_id,
               ts AS created_at,
               CASE WHEN event_id % 53 <> 0
                    THEN ts + to_seconds(CAST(floor(value * 3600) AS BIGINT)) END AS resolved_at,
               CASE WHEN event_id % 31 <> 0
                    THEN ['Billing', 'Delivery', 'Refund', 'Login'][event_id % 4 + 1] END
                    AS issue_type,
               CASE WHEN event_id % 37 <> 0
                    THEN CAST((event_id % 9) / 2.0 + 1 AS DECIMAL(3, 1)) END
                    AS satisfaction_score
        FROM events WHERE event_type = 'error'""",
    "f_web": f"""
        SELECT 's' || event_id AS session_id, {pad('user_id', 5)} AS customer_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS page_views,
               CAST(floor(value) AS BIGINT) AS session_duration,
               ['mobile', 'DESKTOP', 'tablet', 'smart-tv'][event_id % 4 + 1] AS device,
               CASE WHEN event_id % 61 <> 0 THEN CAST(ts AS DATE) END AS interaction_date
        FROM events WHERE event_type IN ('view', 'click')""",
}


# ---- silver ------------------------------------------------------------------------------------


def state_case(code: str, washington: bool) -> str:
    pairs = [
        ("NY", "New York"),
        ("MA", "Massachusetts"),
        ("CA", "California"),
        ("AZ", "Arizona"),
        ("FL", "Florida"),
        ("CO", "Colorado"),
        ("IL", "Illinois"),
        ("GA", "Georgia"),
        ("TX", "Texas"),
    ] + ([("WA", "Washington")] if washington else [])
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs)
    return f"CASE {code} {whens} ELSE 'Unknown' END"


_CODE = r"nullif(regexp_extract(location, ',\s*([A-Z]{2})$', 1), '')"
_STORE_CODE = "trim(split_part(store_location, ',', 2))"

SILVER = {
    "s_customers": rf"""
        SELECT upper(trim(customer_id)) AS customer_id,
               coalesce(string_split(name, ' ')[1], 'Unknown') AS first_name,
               coalesce(string_split(name, ' ')[2], 'Unknown') AS last_name,
               coalesce(email, 'unknown@example.com') AS email,
               coalesce(phone, '0000000000') AS phone,
               coalesce(nullif(regexp_extract(location, '^([^,]+),\s*[A-Z]{{2}}$', 1), ''),
                        'Unknown') AS city,
               coalesce({_CODE}, 'XX') AS state_code,
               {state_case(_CODE, False)} AS state_name,
               signup_date
        FROM f_customers""",
    "s_transactions": f"""
        SELECT trim(transaction_id) AS transaction_id,
               upper(trim(customer_id)) AS customer_id,
               CAST(transaction_date AS TIMESTAMP) AS transaction_date, amount,
               trim(payment_method) AS payment_method,
               trim(split_part(store_location, ',', 1)) AS city,
               {state_case(_STORE_CODE, True)} AS state,
               upper(coalesce(nullif({_STORE_CODE}, ''), 'NA')) AS state_code
        FROM f_transactions
        WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL
          AND transaction_date IS NOT NULL AND amount IS NOT NULL
          AND payment_method IS NOT NULL AND store_location IS NOT NULL""",
    "s_support": """
        SELECT ticket_id, coalesce(upper(trim(customer_id)), 'UNKNOWN') AS customer_id,
               CAST(created_at AS DATE) AS created_at, CAST(resolved_at AS DATE) AS resolved_at,
               CAST(round(datediff('hour', created_at, resolved_at) / 24.0, 2)
                    AS DECIMAL(10, 2)) AS resolution_time_hours,
               coalesce(issue_type, 'Unknown') AS issue_type,
               CAST(coalesce(round(satisfaction_score), 0) AS INTEGER) AS satisfaction_score,
               CASE WHEN satisfaction_score >= 4 THEN 'High'
                    WHEN satisfaction_score >= 2 THEN 'Medium' ELSE 'Low' END
                    AS satisfaction_category
        FROM f_support""",
    "s_web": """
        SELECT upper(session_id) AS session_id, upper(trim(customer_id)) AS customer_id,
               CAST(page_views AS INTEGER) AS page_views,
               CAST(session_duration AS INTEGER) AS session_duration,
               array_to_string(list_transform(
                   regexp_extract_all(device, '([A-Za-z0-9]+|[^A-Za-z0-9]+)'),
                   lambda w: upper(w[1]) || lower(substr(w, 2))), '') AS device,
               CAST(interaction_date AS TIMESTAMP) AS interaction_date,
               CASE WHEN session_duration BETWEEN 1 AND 10 THEN 'Short'
                    WHEN session_duration BETWEEN 11 AND 60 THEN 'Medium'
                    WHEN session_duration BETWEEN 61 AND 120 THEN 'Long'
                    WHEN session_duration BETWEEN 121 AND 180 THEN 'Very Long'
                    ELSE 'Unknown' END AS session_category
        FROM f_web
        WHERE session_id IS NOT NULL AND customer_id IS NOT NULL AND page_views IS NOT NULL
          AND session_duration IS NOT NULL AND device IS NOT NULL
          AND interaction_date IS NOT NULL""",
}

STRICT_SILVER = {
    **SILVER,
    "s_support": """
        SELECT ticket_id, coalesce(customer_id, 'UNKNOWN') AS customer_id,
               CAST(coalesce(created_at, TIMESTAMP '1970-01-01') AS DATE) AS created_at,
               CAST(coalesce(resolved_at, TIMESTAMP '1970-01-01') AS DATE) AS resolved_at,
               CAST(round(coalesce(datediff('hour', created_at, resolved_at) / 24.0, 0), 2)
                    AS DECIMAL(10, 2)) AS resolution_time_hours,
               coalesce(issue_type, 'Unknown') AS issue_type,
               CAST(coalesce(round(satisfaction_score), 0) AS INTEGER) AS satisfaction_score,
               CASE WHEN round(satisfaction_score) >= 4 THEN 'High'
                    WHEN round(satisfaction_score) >= 2 THEN 'Medium' ELSE 'Low' END
                    AS satisfaction_category
        FROM f_support""",
}

# ---- gold: business keys in place of surrogates ------------------------------------------------

GOLD = {
    "dim_date": """
        SELECT DISTINCT d AS dates, CAST(month(d) AS INTEGER) AS months,
               strftime(d, '%b') AS month_name, CAST(quarter(d) AS INTEGER) AS quarters,
               CAST(year(d) AS INTEGER) AS years, strftime(d, '%a') AS days
        FROM (SELECT CAST(transaction_date AS DATE) AS d FROM s_transactions
              UNION ALL SELECT signup_date FROM s_customers
              UNION ALL SELECT created_at FROM s_support
              UNION ALL SELECT resolved_at FROM s_support
              UNION ALL SELECT CAST(interaction_date AS DATE) FROM s_web)
        WHERE d IS NOT NULL""",
    "dim_customers": """
        SELECT customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name,
               email, phone, city, state_code, state_name, signup_date
        FROM s_customers WHERE signup_date IS NOT NULL""",
    "dim_support": """
        SELECT s.ticket_id, s.customer_id, s.created_at AS created_date, s.issue_type,
               s.resolution_time_hours AS resolution_time_days, s.resolved_at AS resolved_date,
               s.satisfaction_category, s.satisfaction_score
        FROM s_support s
        WHERE s.created_at IS NOT NULL
          AND s.customer_id IN (SELECT customer_id FROM dim_customers)""",
    "dim_sessions": """
        SELECT w.session_id, w.customer_id, w.session_duration, w.page_views,
               CAST(w.interaction_date AS DATE) AS interaction_date, w.device AS device_type,
               w.session_category
        FROM s_web w WHERE w.customer_id IN (SELECT customer_id FROM dim_customers)""",
    "fact_transactions": """
        SELECT t.transaction_id, t.customer_id,
               CAST(t.transaction_date AS DATE) AS transaction_date, t.amount,
               t.payment_method, t.city, t.state, t.state_code
        FROM s_transactions t WHERE t.customer_id IN (SELECT customer_id FROM dim_customers)""",
}

STRICT_GOLD = {
    **GOLD,
    "dim_support": GOLD["dim_support"].replace(
        "s.resolution_time_hours AS", "CAST(round(s.resolution_time_hours) AS DECIMAL(10, 2)) AS"
    ),
    "fact_transactions": GOLD["fact_transactions"].replace(
        "t.amount,", "CAST(round(t.amount) AS DECIMAL(18, 2)) AS amount,"
    ),
}

# ---- views -------------------------------------------------------------------------------------

LATEST = "(SELECT max(dates) FROM dim_date)"

VIEWS = {
    "customer_lifetime_value": """
        SELECT c.customer_id, any_value(c.full_name) AS full_name, any_value(c.email) AS email,
               CAST(sum(f.amount) AS DECIMAL(28, 2)) AS customer_lifetime_value,
               min(f.transaction_date) AS first_transaction_date,
               max(f.transaction_date) AS last_transaction_date,
               CAST(max(f.transaction_date) - min(f.transaction_date) AS INTEGER)
                   AS transaction_period_days
        FROM dim_customers c JOIN fact_transactions f USING (customer_id)
        GROUP BY c.customer_id""",
    "customer_activity_status": f"""
        SELECT c.customer_id, c.full_name, c.email, c.city, c.state_name,
               l.last_transaction_date,
               CASE WHEN l.last_transaction_date IS NULL THEN 'Inactive'
                    WHEN l.last_transaction_date < CAST({LATEST} - INTERVAL 3 MONTH AS DATE)
                    THEN 'Dormant' ELSE 'Active' END AS user_category
        FROM dim_customers c
        LEFT JOIN (SELECT customer_id, max(transaction_date) AS last_transaction_date
                   FROM fact_transactions GROUP BY customer_id) l USING (customer_id)""",
    "signups_over_time": """
        SELECT CAST(year(signup_date) AS INTEGER) AS years,
               CAST(month(signup_date) AS INTEGER) AS months,
               strftime(signup_date, '%b') AS month_name, count(customer_id) AS signup_count
        FROM dim_customers GROUP BY ALL""",
    "monthly_churn_and_retention": f"""
        WITH firsts AS (
            SELECT customer_id, date_trunc('month', transaction_date) AS m,
                   date_trunc('month', min(transaction_date) OVER (PARTITION BY customer_id)) AS m0
            FROM fact_transactions),
        monthly AS (
            SELECT m, count(DISTINCT customer_id) AS n_end,
                   count(DISTINCT customer_id) FILTER (WHERE m0 = m) AS n_new
            FROM firsts GROUP BY m),
        lagged AS (SELECT *, lag(n_end) OVER (ORDER BY m) AS n_start FROM monthly)
        SELECT CAST(m AS DATE) AS activity_month, strftime(m, '%Y-%m') AS period,
               strftime(m, '%b') AS month_name, CAST(year(m) AS INTEGER) AS "year",
               CAST(month(m) AS INTEGER) AS month_number, n_start AS customers_at_start,
               n_end AS customers_at_end, n_new AS new_customers,
               n_end - n_new AS retained_customers,
               {half_up('(n_end - n_new)', 'n_start')} AS retention_rate_percent,
               n_start - (n_end - n_new) AS churned_customers,
               {half_up('(n_start - (n_end - n_new))', 'n_start')} AS churn_rate_percentage
        FROM lagged WHERE n_start IS NOT NULL""",
    "churn_rate_by_location": f"""
        WITH seen AS (
            SELECT c.customer_id, c.city, c.state_name, max(f.transaction_date) AS last
            FROM dim_customers c LEFT JOIN fact_transactions f USING (customer_id)
            GROUP BY ALL),
        m AS (SELECT CAST(date_trunc('month', {LATEST}) AS DATE) AS m),
        places AS (
            SELECT city, state_name, count(DISTINCT customer_id) AS n,
                   count(DISTINCT customer_id) FILTER (
                       WHERE last >= m - INTERVAL 3 MONTH AND last < m - INTERVAL 1 MONTH) AS gone
            FROM seen, m GROUP BY city, state_name),
        total AS (SELECT count(*) AS places_with_churn FROM places WHERE gone > 0)
        SELECT city, state_name AS state, n AS total_customers, gone AS churned_customers,
               {half_up('gone', 'n')} AS churn_rate_percentage,
               CASE WHEN gone > 0 THEN {half_up('gone', 'places_with_churn')} END
                   AS location_share_of_total_churn
        FROM places, total""",
    "churned_customers_by_location": f"""
        WITH lasts AS (
            SELECT c.*,
                   (SELECT max(transaction_date) FROM fact_transactions f
                    WHERE f.customer_id = c.customer_id) AS last_t,
                   (SELECT max(interaction_date) FROM dim_sessions s
                    WHERE s.customer_id = c.customer_id) AS last_w,
                   (SELECT max(created_date) FROM dim_support t
                    WHERE t.customer_id = c.customer_id) AS last_s,
                   (SELECT sum(amount) FROM fact_transactions f
                    WHERE f.customer_id = c.customer_id) AS total
            FROM dim_customers c),
        dated AS (
            SELECT *, greatest(signup_date, coalesce(last_t, signup_date),
                               coalesce(last_w, signup_date), coalesce(last_s, signup_date))
                      AS last_activity_date
            FROM lasts)
        SELECT city, state_name AS state, customer_id, full_name, email, phone, signup_date,
               last_activity_date, CAST({LATEST} - last_activity_date AS INTEGER) AS days_inactive,
               if(last_t IS NULL, 'No', 'Yes') AS had_transactions,
               if(last_w IS NULL, 'No', 'Yes') AS had_sessions,
               if(last_s IS NULL, 'No', 'Yes') AS had_support,
               CAST(coalesce(total, 0) AS DECIMAL(28, 2)) AS lifetime_value
        FROM dated WHERE {LATEST} - last_activity_date > 30""",
    "avg_ticket_resolution_time": """
        SELECT issue_type,
               round(CAST(sum(resolved_date - created_date) * 24 AS DOUBLE) / count(*), 6)
                   AS avg_resolution_time_hours,
               round(CAST(sum(resolved_date - created_date) AS DOUBLE) / count(*), 6)
                   AS avg_resolution_time_days,
               count(*) AS ticket_count
        FROM dim_support WHERE resolved_date IS NOT NULL GROUP BY issue_type""",
    "issue_type_by_tickets": f"""
        SELECT issue_type, n AS ticket_count, {half_up('n', 'total', 6)} AS percentage
        FROM (SELECT issue_type, count(*) AS n FROM dim_support GROUP BY issue_type),
             (SELECT count(*) AS total FROM dim_support)""",
    "resolution_ticket_count": """
        SELECT CASE WHEN resolution_time_days > 5 THEN '5+ days'
                    WHEN resolution_time_days > 2 THEN '2-5 days'
                    WHEN resolution_time_days > 1 THEN '1-2 days'
                    WHEN resolution_time_days > 0.5 THEN '12-24 hours'
                    ELSE '0-12 hours' END AS resolution_time_bucket,
               count(*) AS ticket_count
        FROM dim_support
        WHERE satisfaction_score IS NOT NULL AND resolution_time_days IS NOT NULL
        GROUP BY 1""",
    "tickets_over_time": """
        SELECT CAST(year(created_date) AS INTEGER) AS years,
               CAST(month(created_date) AS INTEGER) AS months,
               strftime(created_date, '%b') AS month_name,
               round(CAST(sum(resolution_time_days) AS DOUBLE) / count(resolution_time_days), 6)
                   AS avg_resolution_days,
               count(*) AS ticket_count
        FROM dim_support WHERE resolved_date IS NOT NULL
        GROUP BY 1, 2, 3""",
    "performance_by_session": """
        SELECT session_category, count(*) AS total_sessions,
               round(CAST(sum(session_duration) AS DOUBLE) / count(*), 6) AS avg_duration,
               round(CAST(sum(page_views) AS DOUBLE) / count(*), 6) AS avg_pages,
               count(DISTINCT customer_id) AS unique_users
        FROM dim_sessions GROUP BY session_category""",
    "web_session_count_by_device": """
        SELECT device_type, count(session_id) AS session_count
        FROM dim_sessions GROUP BY device_type""",
    "customer_purchase_frequency_monthly": """
        SELECT customer_id, CAST(year(transaction_date) AS INTEGER) AS years,
               CAST(month(transaction_date) AS INTEGER) AS months,
               count(DISTINCT transaction_id) AS purchase_count
        FROM fact_transactions GROUP BY 1, 2, 3""",
}

# ---- operators ---------------------------------------------------------------------------------

OPERATORS = {
    "ingest_customers": r"""
        SELECT customer_id, name, email, phone, CAST(signup_date AS TIMESTAMP) AS signup_date,
               coalesce(nullif(regexp_extract(location, '^([^,]+),\s*[A-Z]{2}$', 1), ''),
                        'Unknown') AS city,
               coalesce(nullif(regexp_extract(location, ',\s*([A-Z]{2})$', 1), ''),
                        'Unknown') AS state_code
        FROM f_customers""",
    "ingest_transactions": r"""
        SELECT transaction_id, customer_id,
               CAST(transaction_date AS TIMESTAMP) AS transaction_date, amount, payment_method,
               store_location,
               coalesce(nullif(regexp_extract(store_location, '^([^,]+),\s*[A-Z]{2}$', 1), ''),
                        'Unknown') AS city,
               coalesce(nullif(regexp_extract(store_location, ',\s*([A-Z]{2})$', 1), ''),
                        'Unknown') AS state_code
        FROM f_transactions""",
    "ingest_web": """
        SELECT session_id, customer_id, page_views, session_duration, device,
               CAST(interaction_date AS TIMESTAMP) AS interaction_date
        FROM f_web""",
    "ingest_support": "SELECT * FROM f_support",
    "clean_customers": "SELECT * FROM s_customers",
    "clean_transactions": "SELECT * FROM s_transactions",
    "clean_support": "SELECT * FROM s_support",
    "clean_web": "SELECT * FROM s_web",
    **{name: f"SELECT * FROM {name}" for name in GOLD},
    "link_transactions": """
        SELECT t.transaction_id, coalesce(c.customer_id, '-1') AS customer_key
        FROM s_transactions t LEFT JOIN s_customers c ON t.customer_id = c.customer_id""",
    "link_support": """
        SELECT t.ticket_id, coalesce(c.customer_id, '-1') AS customer_key
        FROM s_support t LEFT JOIN s_customers c ON t.customer_id = c.customer_id""",
    "link_support_strict": """
        SELECT t.ticket_id, coalesce(c.customer_id, '0') AS customer_key
        FROM (SELECT ticket_id, coalesce(customer_id, 'UNKNOWN') AS customer_id FROM f_support) t
        LEFT JOIN f_customers c ON t.customer_id = c.customer_id""",
    "link_web": """
        SELECT t.session_id, coalesce(c.customer_id, '-1') AS customer_key
        FROM s_web t LEFT JOIN s_customers c ON t.customer_id = c.customer_id""",
    "ticket_row_numbers": """
        SELECT ticket_id, row_number() OVER (ORDER BY ticket_id) AS ticket_sk FROM dim_support""",
    "session_row_numbers": """
        SELECT session_id, row_number() OVER (ORDER BY session_id) AS session_sk
        FROM dim_sessions""",
    "transaction_surrogates": """
        SELECT count(*) AS row_count, count(DISTINCT transaction_id) AS distinct_keys,
               CAST(1 AS BIGINT) AS smallest
        FROM s_transactions""",
    "upsert_transactions": """
        SELECT s.transaction_id, s.customer_id, s.transaction_date,
               CASE WHEN o.o_orderstatus = 'F' THEN CAST(s.amount + 1 AS DECIMAL(18, 2))
                    ELSE s.amount END AS amount,
               s.payment_method, s.city, s.state, s.state_code,
               CASE WHEN s.transaction_date < DATE '2021-01-01' THEN TIMESTAMP '2024-02-01'
                    ELSE TIMESTAMP '2024-02-02' END AS created_timestamp,
               CASE WHEN s.transaction_date < DATE '2021-01-01' AND o.o_orderstatus <> 'F'
                    THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END
                    AS updated_timestamp,
               CASE WHEN s.transaction_date >= DATE '2021-01-01' THEN 'insert'
                    WHEN o.o_orderstatus = 'F' THEN 'update_postimage' END AS change
        FROM s_transactions s JOIN orders o ON s.transaction_id = """
    + pad("o.o_orderkey", 6),
    "upsert_customers": """
        SELECT customer_id, first_name, last_name, email, '1' || phone AS phone, city, state_code,
               state_name, signup_date,
               CASE WHEN signup_date < DATE '2022-01-01' THEN TIMESTAMP '2024-02-01'
                    ELSE TIMESTAMP '2024-02-02' END AS created_at,
               TIMESTAMP '2024-02-02 12:00:00' AS updated_at,
               CASE WHEN signup_date < DATE '2022-01-01' THEN 'update_postimage'
                    ELSE 'insert' END AS change
        FROM s_customers""",
    "upsert_web": """
        SELECT session_id, customer_id,
               CAST(page_views + (device = 'Mobile')::INTEGER AS INTEGER) AS page_views,
               session_duration, device, interaction_date, session_category,
               CASE WHEN interaction_date < DATE '2024-01-20' THEN TIMESTAMP '2024-02-01'
                    ELSE TIMESTAMP '2024-02-02 12:00:00' END AS created_timestamp,
               TIMESTAMP '2024-02-02 12:00:00' AS updated_timestamp,
               CASE WHEN interaction_date < DATE '2024-01-20' THEN 'update_postimage'
                    ELSE 'insert' END AS change
        FROM s_web""",
    "upsert_support": """
        SELECT ticket_id, customer_id, created_at, resolved_at, resolution_time_hours,
               CASE WHEN satisfaction_score = 0 THEN 'Escalated' ELSE issue_type END AS issue_type,
               satisfaction_score, satisfaction_category,
               CASE WHEN satisfaction_category = 'High' THEN TIMESTAMP '2024-02-01'
                    ELSE TIMESTAMP '2024-02-02' END AS created_timestamp,
               TIMESTAMP '2024-02-02 12:00:00' AS updated_timestamp,
               CASE WHEN satisfaction_category = 'High' THEN 'update_postimage'
                    ELSE 'insert' END AS change
        FROM s_support""",
    "upsert_small_batches": """
        SELECT ticket_id, customer_id, created_at, resolved_at, resolution_time_hours,
               coalesce(issue_type, 'Other') AS issue_type, satisfaction_score, satisfaction_category,
               TIMESTAMP '2024-02-01' AS created_timestamp,
               CASE WHEN CAST(ticket_id[2:] AS BIGINT) % 2 = 0 AND issue_type IS NOT NULL
                    THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS updated_timestamp
        FROM s_support""",
    "change_feed": """
        WITH t AS (SELECT issue_type, CAST(ticket_id[2:] AS BIGINT) % 2 AS half FROM s_support), c AS (
          SELECT 'insert' AS change, CASE WHEN half = 1 THEN coalesce(issue_type, 'Other') ELSE issue_type END
              AS issue_type FROM t
          UNION ALL SELECT 'update_preimage', issue_type FROM t WHERE half = 0 AND issue_type IS NULL
          UNION ALL SELECT 'update_postimage', 'Other' FROM t WHERE half = 0 AND issue_type IS NULL)
        SELECT change, issue_type, count(*) AS row_count FROM c GROUP BY change, issue_type""",
    "keys_after_growth": """
        SELECT count(*) AS row_count, count(*) AS distinct_keys,
               count(*) FILTER (interaction_date < DATE '2024-01-20') AS kept_keys,
               CAST(0 AS BIGINT) AS changed_keys, 64 AS bucket_count
        FROM s_web""",
    "rolled_up_purchases": """
        SELECT s.customer_id, strftime(s.transaction_date, '%Y-%m') AS month, count(*) AS row_count,
               count(DISTINCT CASE WHEN s.payment_method = 'UPI' AND s.transaction_date < DATE '2021-01-01'
                                   THEN 'Cash' ELSE s.payment_method END) AS distinct_count,
               CAST(sum(CASE WHEN o.o_orderstatus = 'F' THEN s.amount + 1 ELSE s.amount END)
                    AS DECIMAL(18, 2)) AS amount
        FROM s_transactions s JOIN orders o ON s.transaction_id = """
    + pad("o.o_orderkey", 6)
    + """
        GROUP BY s.customer_id, strftime(s.transaction_date, '%Y-%m')""",
    "load_policies": """
        WITH n AS (
          SELECT (SELECT count(*) FROM f_customers) AS customers, (SELECT count(*) FROM f_support) AS support,
                 (SELECT count(*) FROM f_customers WHERE CAST(customer_id AS BIGINT) % 10 = 0) AS odd)
        SELECT 'customers' AS feed, 'loaded' AS outcome, 2 * customers - odd AS row_count FROM n
        UNION ALL SELECT 'customers', 'rejected', odd FROM n
        UNION ALL SELECT 'support' AS feed, 'loaded' AS outcome, support AS row_count FROM n
        UNION ALL SELECT 'support', 'rejected', support FROM n
        UNION ALL SELECT 'support', 'quarantined', 1 FROM n
        UNION ALL SELECT 'customers', 'quarantined', 1 FROM n""",
    "raw_history": """
        SELECT session_id, CAST(page_views AS BIGINT) AS page_views,
               CASE WHEN CAST(session_id[2:] AS BIGINT) % 3 = 1 THEN device END AS device,
               CAST(CAST(session_id[2:] AS BIGINT) % 3 AS INTEGER) AS drop_number
        FROM f_web""",
    "run_states": """
        SELECT 'load_transactions' AS task_name, 'SUCCESS' AS status, count(*) AS rows_processed,
               NULL AS error_message FROM f_transactions
        UNION ALL SELECT 'check_amounts', 'ERROR', NULL, count(*) || ' amounts are missing'
        FROM f_transactions WHERE amount IS NULL
        UNION ALL SELECT 'merge_transactions', 'RUNNING', NULL, NULL
        UNION ALL SELECT 'merge_transactions', 'ORPHANED', NULL, NULL""",
    "clock_and_user": """
        SELECT count(*) AS row_count, count(*) AS stamped, count(*) AS signed, CAST(1 AS BIGINT) AS actors
        FROM f_customers""",
    "audit_columns": """
        SELECT * EXCLUDE (signup_date), TIMESTAMP '2024-02-01' AS ingested_at, TIMESTAMP '2024-02-01' AS updated_at,
               'loader' AS created_by, 'loader' AS updated_by
        FROM f_customers""",
    "streamed_run_log": """
        SELECT 'merge_customers' AS task_name, 'SUCCESS' AS status, count(*) AS rows_processed
        FROM f_customers
        UNION ALL SELECT 'merge_web', 'SUCCESS', count(*) FROM f_web
        UNION ALL SELECT 'refresh_customers', 'SUCCESS', count(*) FROM s_customers
        WHERE signup_date IS NOT NULL""",
    "quality_duplicates": """
        SELECT customer_id, count(*) AS row_count FROM s_transactions
        GROUP BY customer_id HAVING count(*) > 1""",
    "quality_orphans": """
        SELECT customer_id, count(*) AS row_count FROM s_transactions
        WHERE customer_id NOT IN (SELECT customer_id FROM s_customers) GROUP BY customer_id""",
    "quality_length": r"""
        SELECT customer_id,
               coalesce(nullif(regexp_extract(location, ',\s*([A-Z]{2})$', 1), ''), 'Unknown')
                   AS state_code,
               'state_code longer than 2' AS reason
        FROM f_customers WHERE NOT regexp_matches(location, ',\s*[A-Z]{2}$')""",
    "quality_not_null": """
        SELECT transaction_id, customer_id, 'amount is null' AS reason
        FROM f_transactions WHERE amount IS NULL""",
}


def _chain(parts: dict[str, str], body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {ctes}\nSELECT * FROM ({body})"


def _needed(parts: dict[str, str], body: str) -> dict[str, str]:
    """The parts that `body` refers to, directly or through other parts, in order."""
    wanted: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in parts:
            if name not in wanted and name in text:
                wanted.add(name)
                todo.append(parts[name])
    return {name: sql for name, sql in parts.items() if name in wanted}


STRICT = [
    "clean_support",
    "dim_date",
    "dim_support",
    "dim_sessions",
    "fact_transactions",
    "customer_lifetime_value",
    "churned_customers_by_location",
    "avg_ticket_resolution_time",
    "resolution_ticket_count",
    "tickets_over_time",
]


def oracle_sql() -> dict[str, str]:
    parts = {**FEEDS, **SILVER, **GOLD}
    strict_parts = {**FEEDS, **STRICT_SILVER, **STRICT_GOLD}
    bodies = {**OPERATORS, **VIEWS}
    out = {name: _chain(_needed(parts, sql), sql) for name, sql in bodies.items()}
    # the streams must end where the batch does
    out["streamed_lifetime_value"] = out["customer_lifetime_value"]
    out["streamed_resolution_count"] = out["resolution_ticket_count"]
    out["streamed_sessions"] = out["performance_by_session"]
    # a view by its SQL name, cut after a full order
    out["top_customers"] = (
        f"SELECT customer_id, customer_lifetime_value FROM ({out['customer_lifetime_value']}) "
        "ORDER BY customer_lifetime_value DESC, customer_id LIMIT 25"
    )
    for name in STRICT:
        sql = bodies[name]
        out[f"{name}_strict"] = _chain(_needed(strict_parts, sql), sql)
    return out
