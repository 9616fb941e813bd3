"""DuckDB oracle SQL for every checked query key.

Written independently of the Spark code: plain SQL over the pre-registered
test tables (lineitem, orders, part, supplier, nation, region, events).
Money follows the same exactness rules (DECIMAL(18,2) inside sums, DOUBLE
out, half-up means from integer cents).
"""

from __future__ import annotations

# Report parameters (FIXTURES.md): months present in the test data.
TX_YEAR, TX_MONTH, TX_PREV_MONTH = "1998", "05", "04"
TX_CATEGORY, TX_SHARE_DAY = "ECONOMY", "16"
EV_YEAR, EV_MONTH, EV_DAY = "2024", "01", "16"
AS_OF = "2001-11-04"
EV_AS_OF, EV_KEEP_DAYS = "2024-01-20", 10
GRANTED_REGION = "ASIA"


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def mean2(s: str, n: str) -> str:
    """round(s / n, 2) half-up from an exact DECIMAL sum, as DOUBLE."""
    return (f"(CAST(SIGN({s}) * ((2 * ABS(CAST(({s}) * 100 AS HUGEINT)) + ({n})) // (2 * ({n}))) AS DOUBLE) / 100.0)")


def pct(a: str, b: str, places: int = 2) -> str:
    return f"(ROUND(CAST({a} AS DOUBLE) * 100.0 / CAST({b} AS DOUBLE), {places}) + 0.0)"


TX_RAW = f"""
tx_raw AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
         l.l_shipdate AS "timestamp",
         'store-' || CAST(l.l_suppkey AS VARCHAR) AS store_id,
         r.r_name AS region,
         'P' || CAST(l.l_partkey AS VARCHAR) AS product_id,
         p.p_name AS product_name,
         p.p_type AS category,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(CAST({dec('p.p_retailprice')} * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS DOUBLE) AS unit_price,
         l.l_discount AS discount_pct,
         CAST(CAST({dec('l.l_extendedprice')} * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
         o.o_orderpriority AS payment_method,
         'cust-' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
         l.l_returnflag = 'R' AS is_return
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

STORE_REGIONS = """(SELECT 'store-' || CAST(s_suppkey AS VARCHAR) AS store_id, r_name AS region
             FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) AS sr"""

EV_RAW = f"""
ev_raw AS (
  SELECT CAST(e.event_id AS VARCHAR) AS transaction_id,
         e.ts AS "timestamp",
         'store-' || CAST(e.user_id AS VARCHAR) AS store_id,
         COALESCE(sr.region, 'Central') AS region,
         'P-' || e.event_type AS product_id,
         e.event_type AS product_name,
         e.event_type AS category,
         CAST(1 AS INTEGER) AS quantity,
         e.value AS unit_price,
         CAST(0.0 AS DOUBLE) AS discount_pct,
         e.value AS total_amount,
         'card' AS payment_method,
         'cust-' || CAST(e.user_id AS VARCHAR) AS customer_id,
         e.event_id % 17 = 0 AS is_return
  FROM events e
  LEFT JOIN {STORE_REGIONS} ON 'store-' || CAST(e.user_id AS VARCHAR) = sr.store_id
)"""

LATEST = ('"timestamp" DESC, product_id DESC, store_id DESC, total_amount DESC, region DESC, product_name DESC, '
          'category DESC, quantity DESC, unit_price DESC, discount_pct DESC, payment_method DESC, customer_id DESC, '
          'is_return DESC')

CLEAN = ('transaction_id IS NOT NULL AND "timestamp" IS NOT NULL AND store_id IS NOT NULL AND product_id IS NOT NULL '
         'AND total_amount IS NOT NULL AND total_amount > 0 AND NOT isnan(total_amount)')


def silver_cte(name: str, src: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn), strftime("timestamp", '%Y') AS year, strftime("timestamp", '%m') AS month,
         strftime("timestamp", '%d') AS day
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY {LATEST}) AS rn
        FROM {src} WHERE {CLEAN})
  WHERE rn = 1
)"""


def gold_ctes(prefix: str, silver: str) -> str:
    amt = dec("total_amount")
    return f"""
{prefix}_product AS (
  SELECT year, month, day, category,
         CAST(SUM({amt}) AS DOUBLE) AS total_revenue,
         CAST(SUM(quantity) AS BIGINT) AS units_sold,
         COUNT(DISTINCT transaction_id) AS transaction_count,
         {mean2(f'SUM({amt})', 'COUNT(total_amount)')} AS avg_order_value,
         'revenue_by_product' AS kpi_type
  FROM {silver} WHERE is_return = false GROUP BY year, month, day, category
),
{prefix}_region AS (
  SELECT year, month, day, region,
         CAST(SUM({amt}) AS DOUBLE) AS total_revenue,
         COUNT(DISTINCT transaction_id) AS transaction_count,
         COUNT(DISTINCT store_id) AS active_stores,
         {mean2(f'SUM({amt})', 'COUNT(total_amount)')} AS avg_order_value,
         'revenue_by_region' AS kpi_type
  FROM {silver} WHERE is_return = false GROUP BY year, month, day, region
),
{prefix}_payment AS (
  SELECT year, month, day, payment_method,
         CAST(SUM({amt}) AS DOUBLE) AS total_revenue,
         COUNT(transaction_id) AS transaction_count,
         'payment_method_split' AS kpi_type
  FROM {silver} WHERE is_return = false GROUP BY year, month, day, payment_method
),
{prefix}_top AS (
  SELECT * FROM (
    SELECT year, month, day, product_id, product_name, category,
           CAST(SUM({amt}) AS DOUBLE) AS total_revenue,
           CAST(SUM(quantity) AS BIGINT) AS units_sold,
           CAST(RANK() OVER (PARTITION BY year, month, day ORDER BY SUM({amt}) DESC) AS INTEGER) AS revenue_rank,
           'top_products' AS kpi_type
    FROM {silver} WHERE is_return = false GROUP BY year, month, day, product_id, product_name, category)
  WHERE revenue_rank <= 10
)"""


def with_tx(body: str) -> str:
    return f"WITH {TX_RAW},{silver_cte('tx', 'tx_raw')},{gold_ctes('g', 'tx')}\n{body}"


def with_ev(body: str) -> str:
    return f"WITH {EV_RAW},{silver_cte('ev', 'ev_raw')},{gold_ctes('ge', 'ev')}\n{body}"


M_TX = f"year = '{TX_YEAR}' AND month = '{TX_MONTH}'"
M_EV = f"year = '{EV_YEAR}' AND month = '{EV_MONTH}'"


def reports() -> dict[str, str]:
    q: dict[str, str] = {}
    q["monthly_category_revenue"] = with_tx(f"""
SELECT category, CAST(SUM({dec('total_revenue')}) AS DOUBLE) AS monthly_revenue,
       CAST(SUM(units_sold) AS BIGINT) AS monthly_units,
       CAST(SUM(transaction_count) AS BIGINT) AS monthly_transactions,
       {mean2(f"SUM({dec('avg_order_value')})", 'COUNT(avg_order_value)')} AS avg_order_value
FROM g_product WHERE {M_TX} GROUP BY category""")
    q["category_daily_trend"] = with_tx(f"""
SELECT year, month, day, total_revenue, units_sold, transaction_count
FROM g_product WHERE {M_TX} AND category = '{TX_CATEGORY}'""")
    q["category_revenue_share"] = with_tx(f"""
SELECT category, total_revenue,
       {pct('total_revenue', f"CAST(SUM({dec('total_revenue')}) OVER () AS DOUBLE)")} AS revenue_share_pct
FROM g_product WHERE {M_TX} AND day = '{TX_SHARE_DAY}'""")
    q["mom_growth"] = with_tx(f"""
, cur AS (SELECT category, CAST(SUM({dec('total_revenue')}) AS DOUBLE) AS revenue FROM g_product WHERE {M_TX} GROUP BY category),
prev AS (SELECT category, CAST(SUM({dec('total_revenue')}) AS DOUBLE) AS revenue FROM g_product
         WHERE year = '{TX_YEAR}' AND month = '{TX_PREV_MONTH}' GROUP BY category)
SELECT c.category, c.revenue AS current_revenue, p.revenue AS previous_revenue,
       ROUND((c.revenue - p.revenue) / p.revenue * 100.0, 2) + 0.0 AS growth_pct
FROM cur c LEFT JOIN prev p USING (category)""").replace("\n, cur AS", ", cur AS")
    q["monthly_region_performance"] = with_tx(f"""
SELECT region, CAST(SUM({dec('total_revenue')}) AS DOUBLE) AS monthly_revenue,
       CAST(SUM(transaction_count) AS BIGINT) AS monthly_transactions,
       MAX(active_stores) AS active_stores,
       {mean2(f"SUM({dec('avg_order_value')})", 'COUNT(avg_order_value)')} AS avg_order_value
FROM g_region WHERE {M_TX} GROUP BY region""")
    q["region_daily_trend"] = with_tx(f"""
SELECT day, region, total_revenue, transaction_count FROM g_region WHERE {M_TX}""")
    q["best_region_per_day"] = with_tx(f"""
SELECT day, region, total_revenue FROM (
  SELECT day, region, total_revenue, RANK() OVER (PARTITION BY day ORDER BY total_revenue DESC) AS rnk
  FROM g_region WHERE {M_TX}) WHERE rnk = 1""")
    q["region_vs_average"] = with_tx(f"""
, daily AS (
  SELECT year, month, day, SUM({dec('total_revenue')}) AS s, COUNT(total_revenue) AS n
  FROM g_region WHERE {M_TX} GROUP BY year, month, day)
SELECT r.day, r.region, r.total_revenue, {mean2('d.s', 'd.n')} AS national_avg,
       ROUND((r.total_revenue - CAST(d.s AS DOUBLE) / d.n) / (CAST(d.s AS DOUBLE) / d.n) * 100.0, 2) + 0.0 AS vs_avg_pct
FROM g_region r JOIN daily d USING (year, month, day)
WHERE r.year = '{TX_YEAR}' AND r.month = '{TX_MONTH}'""").replace("\n, daily AS", ", daily AS")
    amt = dec("total_amount")
    q["amount_outliers"] = with_ev(f"""
, stats AS (
  SELECT category, CAST(SUM({amt}) AS DOUBLE) / COUNT(total_amount) AS mean_amount,
         SQRT(CAST(COUNT(total_amount) * SUM({amt} * {amt}) - SUM({amt}) * SUM({amt}) AS DOUBLE)
              / (CAST(COUNT(total_amount) AS DOUBLE) * (CAST(COUNT(total_amount) AS DOUBLE) - 1.0))) AS std_amount
  FROM ev WHERE {M_EV} GROUP BY category)
SELECT t.transaction_id, t.store_id, t.category, t.total_amount,
       ROUND(s.mean_amount, 2) AS category_mean,
       ROUND((t.total_amount - s.mean_amount) / s.std_amount, 2) AS z_score
FROM ev t JOIN stats s USING (category)
WHERE t.year = '{EV_YEAR}' AND t.month = '{EV_MONTH}' AND t.total_amount > s.mean_amount + 3.0 * s.std_amount
ORDER BY z_score DESC, t.transaction_id LIMIT 50""").replace("\n, stats AS", ", stats AS")
    q["store_volume_drop"] = with_ev(f"""
, dsc AS (SELECT store_id, day, COUNT(*) AS daily_transactions FROM ev WHERE {M_EV} GROUP BY store_id, day),
sa AS (SELECT store_id, AVG(daily_transactions) AS avg_daily FROM dsc GROUP BY store_id)
SELECT dsc.store_id, dsc.day, dsc.daily_transactions, ROUND(sa.avg_daily, 1) AS store_avg,
       {pct('dsc.daily_transactions', 'sa.avg_daily', 1)} AS pct_of_avg
FROM dsc JOIN sa USING (store_id) WHERE dsc.daily_transactions < sa.avg_daily * 0.5""").replace("\n, dsc AS", ", dsc AS")
    q["return_rate_spikes"] = with_ev(f"""
SELECT * FROM (
  SELECT store_id, day, COUNT(*) AS total_transactions,
         CAST(SUM(CASE WHEN is_return = true THEN 1 ELSE 0 END) AS BIGINT) AS returns,
         {pct('SUM(CASE WHEN is_return = true THEN 1 ELSE 0 END)', 'COUNT(*)')} AS return_rate_pct
  FROM ev WHERE {M_EV} GROUP BY store_id, day) WHERE return_rate_pct > 10""")
    q["hourly_volume"] = with_ev(f"""
SELECT CAST(HOUR("timestamp") AS INTEGER) AS hour_of_day, COUNT(*) AS transaction_count,
       CAST(SUM({amt}) AS DOUBLE) AS total_revenue
FROM ev WHERE {M_EV} AND day = '{EV_DAY}' GROUP BY HOUR("timestamp")""")
    q["month_transaction_count"] = with_tx(f"SELECT COUNT(*) AS total_transactions FROM tx WHERE {M_TX}")
    q["customer_patterns"] = with_tx(f"""
SELECT customer_id, COUNT(DISTINCT transaction_id) AS orders, CAST(SUM({amt}) AS DOUBLE) AS total_spend,
       COUNT(DISTINCT category) AS distinct_categories,
       CAST(MIN("timestamp") AS DATE) AS first_purchase, CAST(MAX("timestamp") AS DATE) AS last_purchase
FROM tx WHERE is_return = false GROUP BY customer_id""")
    q["transaction_trend"] = with_tx("""
SELECT year, month, day, COUNT(*) AS transaction_count FROM tx WHERE is_return = false GROUP BY year, month, day""")
    return q


def kpis() -> dict[str, str]:
    return {
        "kpi_revenue_by_product": with_tx("SELECT * FROM g_product"),
        "kpi_revenue_by_region": with_tx("SELECT * FROM g_region"),
        "kpi_payment_method_split": with_tx("SELECT * FROM g_payment"),
        "kpi_top_products": with_tx("SELECT * FROM g_top"),
        "preview_revenue_by_product": with_tx("SELECT * FROM g_product ORDER BY total_revenue DESC, year, month, day, category LIMIT 5"),
        "preview_revenue_by_region": with_tx("SELECT * FROM g_region ORDER BY total_revenue DESC, year, month, day, region LIMIT 5"),
        "preview_payment_method_split": with_tx(
            "SELECT * FROM g_payment ORDER BY transaction_count DESC, year, month, day, payment_method LIMIT 5"),
        "preview_top_products": with_tx("SELECT * FROM g_top ORDER BY year, month, day, revenue_rank, product_id, product_name LIMIT 10"),
    }


def silver_ops() -> dict[str, str]:
    q: dict[str, str] = {}
    q["dedup_latest"] = with_tx("SELECT * EXCLUDE (year, month, day) FROM tx")
    q["sales_only"] = with_tx("SELECT * FROM tx WHERE is_return = false")
    q["date_partitions"] = with_tx("""
SELECT transaction_id, "timestamp", strftime("timestamp", '%Y') AS year, strftime("timestamp", '%m') AS month,
       strftime("timestamp", '%d') AS day FROM tx_raw""")
    q["region_enrichment"] = with_ev("SELECT transaction_id, store_id, region FROM ev_raw")
    q["line_totals"] = f"""
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_quantity AS INTEGER) AS quantity,
       CAST({dec('p.p_retailprice')} * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DOUBLE) AS unit_price,
       CAST(CAST({dec('p.p_retailprice')} * (1 - CAST(l.l_discount AS DECIMAL(4,2))) * CAST(l.l_quantity AS INTEGER)
            AS DECIMAL(18,2)) AS DOUBLE) AS total_amount
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""
    q["pricing_errors"] = with_ev(f"""
, priced AS (
  SELECT transaction_id, quantity, CASE WHEN CAST(transaction_id AS BIGINT) % 89 = 0 THEN unit_price + 1.0 ELSE unit_price END AS unit_price,
         total_amount FROM ev_raw)
SELECT transaction_id, quantity, unit_price, total_amount,
       CAST(ROUND({dec('unit_price')} * quantity, 2) AS DOUBLE) AS expected_total,
       CAST(ABS({dec('total_amount')} - ROUND({dec('unit_price')} * quantity, 2)) AS DOUBLE) AS price_gap
FROM priced WHERE ABS({dec('total_amount')} - ROUND({dec('unit_price')} * quantity, 2)) >= 0.05""").replace("\n, priced AS", ", priced AS")
    q["silver_preview"] = with_tx("""
SELECT transaction_id, "timestamp", store_id, category, total_amount, year, month, day
FROM tx ORDER BY transaction_id LIMIT 5""")
    q["list_partitions"] = with_tx("""
SELECT DISTINCT 'year=' || year || '/month=' || month || '/day=' || day AS partition FROM tx""")
    q["analyst_view"] = with_tx("SELECT * EXCLUDE (customer_id) FROM tx")
    q["regional_view"] = with_tx(f"SELECT * FROM tx WHERE region IN ('{GRANTED_REGION}')")
    return q




# --- Bronze landing fixture (dirty events as text) ------------------------------------

BRONZE = f"""
bz_base AS (
  SELECT event_id, ts, user_id, event_type, value FROM events
  UNION ALL
  SELECT event_id, ts + INTERVAL 1 HOUR, user_id, event_type, value + 1.0 FROM events WHERE event_id % 131 = 0
),
bronze AS (
  SELECT CAST(b.event_id AS VARCHAR) AS transaction_id,
         CASE WHEN b.event_id % 107 = 0 THEN 'not-a-time'
              WHEN b.event_id % 2 = 1 THEN strftime(b.ts, '%Y-%m-%dT%H:%M:%S.%fZ')
              ELSE strftime(b.ts, '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
         CASE WHEN b.event_id % 97 = 0 THEN NULL ELSE 'store-' || CAST(b.user_id AS VARCHAR) END AS store_id,
         COALESCE(sr.region, 'Central') AS region,
         'P-' || b.event_type AS product_id,
         b.event_type AS product_name,
         b.event_type AS category,
         CASE WHEN b.event_id % 109 = 0 THEN '0' ELSE '1' END AS quantity,
         CAST(b.value AS VARCHAR) AS unit_price,
         CAST(CASE WHEN b.event_id % 127 = 0 THEN NULL WHEN b.event_id % 113 = 0 THEN CAST(1.5 AS DOUBLE)
                   ELSE CAST(0.0 AS DOUBLE) END AS VARCHAR) AS discount_pct,
         CAST(CASE WHEN b.event_id % 103 = 0
                   THEN 0.0 - (CASE WHEN b.event_id % 101 = 0 THEN CAST(0.0 AS DOUBLE) ELSE b.value END)
                   WHEN b.event_id % 101 = 0 THEN CAST(0.0 AS DOUBLE) ELSE b.value END AS VARCHAR) AS total_amount,
         'card' AS payment_method,
         'cust-' || CAST(b.user_id AS VARCHAR) AS customer_id,
         CAST(b.event_id % 17 = 0 AS VARCHAR) AS is_return,
         b.ts AS arrival
  FROM bz_base b LEFT JOIN {STORE_REGIONS} ON 'store-' || CAST(b.user_id AS VARCHAR) = sr.store_id
),
typed AS (
  SELECT transaction_id,
         COALESCE(TRY_STRPTIME("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ'),
                  TRY_STRPTIME("timestamp", '%Y-%m-%dT%H:%M:%SZ')) AS "timestamp",
         store_id, region, product_id, product_name, category,
         TRY_CAST(quantity AS INTEGER) AS quantity,
         TRY_CAST(unit_price AS DOUBLE) AS unit_price,
         TRY_CAST(discount_pct AS DOUBLE) AS discount_pct,
         TRY_CAST(total_amount AS DOUBLE) AS total_amount,
         payment_method, customer_id,
         TRY_CAST(is_return AS BOOLEAN) AS is_return,
         "timestamp" AS raw_time
  FROM bronze
),
validated AS (
  SELECT transaction_id, arrival,
         list_filter([
           {", ".join(f"CASE WHEN {f} IS NULL THEN 'Missing field: {f}' END" for f in
                      ["transaction_id", '"timestamp"', "store_id", "product_id", "total_amount", "quantity", "category"])},
           CASE WHEN COALESCE(TRY_CAST(total_amount AS DOUBLE), -1.0) <= 0
                THEN 'Invalid total_amount: ' || COALESCE(total_amount, 'None') END,
           CASE WHEN COALESCE(TRY_CAST(quantity AS DOUBLE), -1.0) <= 0
                THEN 'Invalid quantity: ' || COALESCE(quantity, 'None') END,
           CASE WHEN COALESCE(TRY_CAST(discount_pct AS DOUBLE), -1.0) < 0
                  OR COALESCE(TRY_CAST(discount_pct AS DOUBLE), -1.0) > 1
                THEN 'Discount out of range: ' || COALESCE(discount_pct, 'None') END
         ], lambda x: x IS NOT NULL) AS errors
  FROM bronze
),
scored AS (
  SELECT COUNT(*) AS records, COUNT(*) FILTER (WHERE len(errors) = 0) AS valid_records,
         CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE len(errors) = 0) AS DOUBLE) / COUNT(*) ELSE 0.0 END
           AS quality_score
  FROM validated
),
verdict AS (
  SELECT CASE WHEN records = 0 THEN 'NO_DATA' WHEN quality_score < 0.95 THEN 'QUALITY_FAIL' ELSE 'OK' END AS status,
         quality_score, records, records - valid_records AS invalid_records, CAST(0.95 AS DOUBLE) AS threshold
  FROM scored
)"""

TYPED_COLS = ('transaction_id, "timestamp", store_id, region, product_id, product_name, category, quantity, '
              'unit_price, discount_pct, total_amount, payment_method, customer_id, is_return')


def with_bronze(body: str) -> str:
    return f"WITH {BRONZE},{silver_cte('bsilver', f'(SELECT {TYPED_COLS} FROM typed)')},{gold_ctes('gb', 'bsilver')}\n{body}"


def with_mended(body: str) -> str:
    """Silver of the mended landing rows, stores filled from customers."""
    fixed = """bronze AS (
  SELECT * REPLACE (ltrim(total_amount, '-') AS total_amount, COALESCE(store_id, replace(customer_id, 'cust-', 'store-')) AS store_id,
                    CASE WHEN quantity = '0' THEN '1' ELSE quantity END AS quantity,
                    CASE WHEN discount_pct = '1.5' THEN '0.0' ELSE discount_pct END AS discount_pct)
  FROM landed
),
typed AS ("""
    landed = BRONZE.replace("bronze AS (", "landed AS (").replace("typed AS (", fixed)
    return f"WITH {landed},{silver_cte('msilver', f'(SELECT {TYPED_COLS} FROM typed)')}\n{body}"


def bronze_ops() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_scan"] = with_bronze("SELECT * EXCLUDE (arrival) FROM bronze")
    q["typed_transactions"] = with_bronze(f"SELECT {TYPED_COLS} FROM typed")
    q["drop_critical_nulls"] = with_bronze(
        f'SELECT {TYPED_COLS} FROM typed WHERE transaction_id IS NOT NULL AND "timestamp" IS NOT NULL '
        "AND store_id IS NOT NULL AND product_id IS NOT NULL AND total_amount IS NOT NULL")
    q["valid_amounts"] = with_bronze(f"SELECT {TYPED_COLS} FROM typed WHERE total_amount > 0 AND NOT isnan(total_amount)")
    q["cleaning_report"] = with_bronze(f"""
, flagged AS (SELECT transaction_id, ({CLEAN}) AS ok FROM typed)
SELECT COUNT(*) AS raw_rows, COUNT(*) FILTER (WHERE ok) AS clean_rows,
       COUNT(*) - COUNT(*) FILTER (WHERE ok) AS dropped_quality,
       COUNT(DISTINCT CASE WHEN ok THEN transaction_id END) AS silver_rows,
       COUNT(*) FILTER (WHERE ok) - COUNT(DISTINCT CASE WHEN ok THEN transaction_id END) AS dropped_duplicates
FROM flagged""")
    q["dead_letter"] = with_bronze("""
SELECT transaction_id, raw_time AS raw_timestamp,
       CASE WHEN transaction_id IS NULL OR store_id IS NULL OR product_id IS NULL OR total_amount IS NULL
                 OR raw_time IS NULL THEN 'missing_field'
            WHEN "timestamp" IS NULL THEN 'bad_timestamp'
            ELSE 'invalid_amount' END AS error_type
FROM typed
WHERE transaction_id IS NULL OR store_id IS NULL OR product_id IS NULL OR total_amount IS NULL OR raw_time IS NULL
   OR "timestamp" IS NULL OR NOT (total_amount > 0) OR isnan(total_amount)""")
    q["silver_roundtrip"] = with_bronze("SELECT * FROM bsilver")
    q["gold_roundtrip"] = with_bronze("SELECT * FROM gb_product")
    q["dq_validate"] = with_bronze("""
SELECT transaction_id, len(errors) = 0 AS is_valid, CAST(len(errors) AS INTEGER) AS error_count,
       array_to_string(errors, '; ') AS errors_text FROM validated""")
    q["dq_score"] = with_bronze("SELECT * FROM scored")
    q["dq_error_log"] = with_bronze("""
SELECT COALESCE(transaction_id, 'unknown') AS record_id, array_to_string(errors, '; ') AS errors_text
FROM validated WHERE len(errors) > 0""")
    q["dq_first_errors"] = with_bronze("""
SELECT COALESCE(transaction_id, 'unknown') AS record_id, array_to_string(errors, '; ') AS errors_text
FROM validated WHERE len(errors) > 0 ORDER BY record_id, errors_text LIMIT 5""")
    q["dq_error_counts"] = with_bronze("""
, e AS (SELECT unnest(errors) AS error FROM validated WHERE len(errors) > 0)
SELECT CASE WHEN starts_with(error, 'Missing field') THEN error ELSE split_part(error, ':', 1) END AS rule,
       COUNT(*) AS records
FROM e GROUP BY 1""")
    q["dq_gate"] = with_bronze("SELECT * FROM verdict")
    q["dq_metrics"] = with_bronze("""
SELECT 'QualityScore' AS metric_name, quality_score AS metric_value, 'None' AS unit, 'Bronze' AS zone FROM scored
UNION ALL
SELECT 'SampledRecords', CAST(records AS DOUBLE), 'Count', 'Bronze' FROM scored""")
    q["dq_alerts"] = with_bronze("""
SELECT status, CASE WHEN status = 'NO_DATA' THEN 'WARNING: no new Bronze data'
                    ELSE 'ALERT: Bronze quality below threshold, ETL stopped' END AS subject,
       quality_score, records, invalid_records, threshold
FROM verdict WHERE status <> 'OK'""")
    return q


def stream_ops() -> dict[str, str]:
    b = bronze_ops()
    q: dict[str, str] = {"landing_stream": b["bronze_scan"], "silver_incremental": b["silver_roundtrip"]}
    q["late_data_rebuild"] = f"""WITH {EV_RAW},
resent AS (
  SELECT transaction_id, "timestamp" + INTERVAL 1 SECOND AS "timestamp", store_id, region, product_id, product_name,
         category, quantity, unit_price, discount_pct, total_amount + 1.0 AS total_amount, payment_method,
         customer_id, is_return
  FROM ev_raw WHERE strftime("timestamp", '%d') = '05'),
all_rows AS (SELECT * FROM ev_raw UNION ALL SELECT * FROM resent),
{silver_cte('ls', 'all_rows')},{gold_ctes('gl', 'ls')}
SELECT * FROM gl_product"""
    # the same rows, whether a batch was retried or the lake rebuilt
    q["late_data_retry"] = q["rebuild_moved_day"] = q["late_data_rebuild"]
    q["dead_letter_written"] = b["dead_letter"]
    totals = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, CAST(SUM({dec('total_revenue')}) AS DOUBLE) AS revenue FROM gl_{cte}"
        for name, cte in (("revenue_by_product", "product"), ("revenue_by_region", "region"),
                          ("payment_method_split", "payment"), ("top_products", "top")))
    q["gold_after_failure"] = f"""WITH {EV_RAW},
first_rows AS (SELECT * FROM ev_raw WHERE strftime("timestamp", '%d') <> '01'),
{silver_cte('ls', 'first_rows')},{gold_ctes('gl', 'ls')}
{totals}"""
    q["gold_after_retry"] = q["late_data_rebuild"].replace("SELECT * FROM gl_product", totals)
    q["metrics_history"] = f"""WITH {BRONZE}
SELECT strftime(arrival, '%Y-%m-%d') AS run_day, CAST(COUNT(*) FILTER (WHERE len(errors) = 0) AS DOUBLE) / COUNT(*) AS mean_value,
       CAST(1 AS BIGINT) AS checks
FROM validated GROUP BY 1"""
    q["cleaning_counters"] = b["cleaning_report"]
    n, d = "CAST(transaction_id AS BIGINT)", 'day("timestamp")'
    q["silver_with_new_column"] = with_ev(f"""
SELECT *, CASE WHEN {d} > 10 AND {n} % 3 = 0 THEN 'p' || CAST({n} % 7 AS VARCHAR) END AS promo,
       CASE WHEN {d} > 20 THEN CAST({n} % 5 AS DOUBLE) + 0.5 WHEN {d} > 10 THEN CAST({n} % 5 AS DOUBLE) END AS points
FROM ev""")
    q["lake_after_expiry"] = with_ev(f"""
SELECT year, month, day, COUNT(*) AS transactions,
       CAST(SUM({dec('total_amount')}) FILTER (WHERE is_return = false) AS DOUBLE) AS revenue
FROM ev WHERE datediff('day', CAST("timestamp" AS DATE), DATE '{EV_AS_OF}') <= {EV_KEEP_DAYS} GROUP BY year, month, day""")
    revenue = f"(SELECT CAST(SUM({dec('total_amount')}) FILTER (WHERE is_return = false) AS DOUBLE) FROM ev WHERE day <= '15')"
    q["gated_runs"] = f"""WITH {BRONZE.strip().removeprefix(',')},{EV_RAW},{silver_cte('ev', 'ev_raw')},
runs AS (
  SELECT 'clean' AS step, COUNT(*) AS records, COUNT(*) FILTER (WHERE total_amount > 0) AS valid
  FROM ev_raw WHERE day("timestamp") <= 15
  UNION ALL
  SELECT 'defective', COUNT(*), COUNT(*) FILTER (WHERE len(errors) = 0) FROM validated WHERE day(arrival) > 15)
SELECT step, CASE WHEN CAST(valid AS DOUBLE) / records < 0.95 THEN 'QUALITY_FAIL' ELSE 'OK' END AS status,
       1 - CAST(records - valid AS DOUBLE) / records AS quality_score, records,
       (SELECT COUNT(*) FROM ev WHERE day <= '15') AS silver_rows, {revenue} AS gold_revenue,
       CASE WHEN step = 'clean' THEN CAST(0 AS BIGINT) ELSE records END AS quarantined
FROM runs"""
    early = "(SELECT * FROM ev_raw WHERE day(\"timestamp\") <= 15)"
    q["report_persisted"] = reports()["monthly_category_revenue"].replace(with_tx(""), (
        f"WITH {EV_RAW},{silver_cte('ev', early)},{gold_ctes('g', 'ev')}\n")).replace(M_TX, M_EV)
    q["quarantine_replayed"] = with_mended("SELECT * FROM msilver")
    q["replay_accounts"] = with_mended("""
SELECT CASE WHEN "timestamp" IS NULL THEN 'bad_timestamp' ELSE 'invalid_amount' END AS outcome, COUNT(*) AS records
FROM typed WHERE "timestamp" IS NULL OR NOT (total_amount > 0) GROUP BY 1
UNION ALL SELECT 'silver', COUNT(*) FROM msilver
UNION ALL SELECT 'quarantine', CAST(0 AS BIGINT)""")
    amt = dec("value")
    q["win_incoming_records"] = """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       COUNT(*) AS records FROM events GROUP BY 1, 2"""
    q["win_hourly_sum"] = f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       CAST(SUM({amt}) AS DOUBLE) AS total_value FROM events GROUP BY 1, 2"""
    q["win_daily_avg"] = f"""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       {mean2(f'SUM({amt})', 'COUNT(value)')} AS avg_value, COUNT(value) AS records FROM events GROUP BY 1, 2"""
    q["win_quality_score"] = f"""WITH {BRONZE}
, flagged AS (SELECT arrival, len(errors) = 0 AS ok FROM validated)
SELECT time_bucket(INTERVAL 1 DAY, arrival) AS window_start, time_bucket(INTERVAL 1 DAY, arrival) + INTERVAL 1 DAY AS window_end,
       CAST(COUNT(*) FILTER (WHERE ok) AS DOUBLE) / COUNT(*) AS quality_score, COUNT(*) AS records
FROM flagged GROUP BY 1, 2"""
    return q


def storage_ops() -> dict[str, str]:
    q: dict[str, str] = {}
    q["silver_scan"] = with_tx("SELECT * FROM tx")
    day = "make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), CAST(day AS INTEGER))"
    q["retention_expired"] = with_tx(f"""
SELECT DISTINCT year, month, day, CAST(datediff('day', {day}, DATE '{AS_OF}') AS INTEGER) AS age_days
FROM tx WHERE datediff('day', {day}, DATE '{AS_OF}') > 730""")
    q["retention_kept"] = with_tx(f"SELECT * FROM tx WHERE {day} >= DATE '{AS_OF}' - INTERVAL 730 DAY")
    q["catalog_bronze"] = with_bronze("SELECT * EXCLUDE (arrival) FROM bronze")
    q["catalog_silver"] = q["silver_scan"]
    q["catalog_gold"] = with_tx("SELECT * FROM g_payment")
    q["catalog_partitions"] = with_tx("SELECT DISTINCT 'year=' || year || '/month=' || month || '/day=' || day AS partition FROM g_region")
    r = reports()
    q["sql_growth"], q["sql_leaders"], q["sql_month_count"] = r["mom_growth"], r["best_region_per_day"], r["month_transaction_count"]
    q["sql_landed"] = with_bronze(f"""
SELECT category, COUNT(*) AS records, COUNT(store_id) AS with_store FROM bronze
WHERE strftime(arrival, '%Y-%m-%d') = '{EV_YEAR}-{EV_MONTH}-{EV_DAY}' GROUP BY category""")
    fields = ["transaction_id", "timestamp", "store_id", "region", "product_id", "product_name", "category",
              "quantity", "unit_price", "discount_pct", "total_amount", "payment_method", "customer_id", "is_return"]
    parts = "\nUNION ALL\n".join(
        f"""SELECT '{f}' AS column_name, 'string' AS data_type,
       COUNT(DISTINCT CASE WHEN "{f}" IS NOT NULL THEN CAST(CAST(arrival AS DATE) AS VARCHAR) END) AS partitions
FROM bronze""" for f in fields)
    q["schema_discovery"] = f"WITH {BRONZE}\n{parts}"
    return q


def all_queries() -> dict[str, str]:
    return {**kpis(), **reports(), **silver_ops(), **bronze_ops(), **stream_ops(), **storage_ops()}
