"""The expected result of each query as DuckDB SQL over the same tables."""

ORACLES = {
    "extract_day": """
SELECT strftime(ts, '%Y-%m-%d') AS event_day, event_id, event_type, value FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-29'""",
    "extract_month": """
SELECT strftime(o_orderdate, '%Y-%m') AS order_month, o_orderkey, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-02-01' AND DATE '2001-07-31'""",
    "projection_transform": """
SELECT p_partkey AS product_code, p_name AS product_name, CAST(p_size AS VARCHAR) AS size_text,
  CASE WHEN p_retailprice >= 1000 THEN 'premium' ELSE 'standard' END AS price_band
FROM part""",
    "compound_predicate": """
SELECT event_id, nullif(event_type, 'error') AS event_type, value FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-29'
  AND (value >= 20 OR event_type = 'error')""",
    "day_spine": """
WITH active AS (
  SELECT user_id, date_trunc('day', min(ts)) AS first_day, date_trunc('day', max(ts)) AS last_day
  FROM events GROUP BY user_id),
days AS (
  SELECT user_id, unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS d
  FROM active)
SELECT user_id, strftime(d, '%Y-%m-%d') AS partition_value FROM days""",
    "month_spine": """
WITH active AS (
  SELECT o_custkey, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders GROUP BY o_custkey),
days AS (
  SELECT o_custkey, unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS d
  FROM active)
SELECT DISTINCT o_custkey, strftime(d, '%Y-%m') AS partition_value FROM days""",
    "strategy_windows": """
WITH r AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders),
p AS (SELECT run_date, CAST(run_date - INTERVAL 1 DAY AS DATE) AS prev FROM r)
SELECT run_date, 'single_day' AS strategy, prev AS start_date, prev AS end_date FROM p
UNION ALL
SELECT run_date, 'last_and_current_month', CAST(date_trunc('month', prev) - INTERVAL 1 MONTH AS DATE), prev FROM p
UNION ALL
SELECT run_date, 'single_month', CAST(date_trunc('month', prev) AS DATE), prev FROM p""",
    "parse_target_dates": """
WITH q AS (
  SELECT o_orderkey AS request_id, o_orderpriority AS p, o_orderstatus AS s, CAST(o_orderdate AS DATE) AS d
  FROM orders),
t AS (
  SELECT request_id, p, s, d,
    CASE WHEN p = '4-NOT SPECIFIED' THEN 'month' ELSE 'day' END AS partition_type,
    CASE
      WHEN p = '1-URGENT' THEN strftime(d, '%Y-%m-%d')
      WHEN p = '2-HIGH' THEN strftime(d, '%Y-%m-%d') || ' , ' || strftime(d + INTERVAL 9 DAY, '%Y-%m-%d')
      WHEN p = '3-MEDIUM' THEN strftime(d, '%Y-%m-%d') || ',' || strftime(d - INTERVAL 1 DAY, '%Y-%m-%d')
      WHEN p = '4-NOT SPECIFIED' AND s = 'F' THEN strftime(d, '%Y-%m')
      WHEN p = '4-NOT SPECIFIED' THEN strftime(d, '%Y-%m') || ',' || strftime(d + INTERVAL 2 MONTH, '%Y-%m')
      WHEN s = 'F' THEN strftime(d, '%Y') || '-02-30'
      WHEN s = 'O' THEN ' ' || strftime(d, '%Y-%m-%d')
      ELSE strftime(d, '%Y-%m-%d') || ',' || strftime(d, '%Y-%m-%d') || ',' || strftime(d, '%Y-%m-%d')
    END AS target_date
  FROM q)
SELECT request_id, partition_type, target_date,
  CASE
    WHEN p IN ('1-URGENT', '2-HIGH') THEN d
    WHEN p = '4-NOT SPECIFIED' THEN CAST(date_trunc('month', d) AS DATE)
  END AS start_date,
  CASE
    WHEN p = '1-URGENT' THEN d
    WHEN p = '2-HIGH' THEN CAST(d + INTERVAL 9 DAY AS DATE)
    WHEN p = '4-NOT SPECIFIED' AND s = 'F' THEN last_day(d)
    WHEN p = '4-NOT SPECIFIED' THEN last_day(CAST(d + INTERVAL 2 MONTH AS DATE))
  END AS end_date,
  p IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED') AS is_valid
FROM t""",
    "choose_window": """
WITH q AS (
  SELECT o_orderkey AS request_id, o_orderstatus AS s, o_orderpriority = '4-NOT SPECIFIED' AS monthly,
    CAST(o_orderdate AS DATE) AS run_date, CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS prev
  FROM orders)
SELECT request_id,
  CASE WHEN monthly THEN 'single_month' WHEN s = 'F' THEN 'single_day' ELSE 'last_and_current_month' END
    AS processing_strategy,
  run_date,
  CASE WHEN s = 'O' THEN ''
    WHEN s = 'F' AND monthly THEN strftime(run_date, '%Y-%m')
    WHEN s = 'F' AND request_id % 2 = 0
      THEN strftime(run_date, '%Y-%m-%d') || ',' || strftime(run_date + INTERVAL 6 DAY, '%Y-%m-%d')
    WHEN s = 'F' THEN strftime(run_date, '%Y-%m-%d') END AS target_date,
  CASE WHEN s = 'F' AND monthly THEN CAST(date_trunc('month', run_date) AS DATE)
    WHEN s = 'F' THEN run_date
    WHEN monthly THEN CAST(date_trunc('month', prev) AS DATE)
    ELSE CAST(date_trunc('month', prev) - INTERVAL 1 MONTH AS DATE) END AS start_date,
  CASE WHEN s = 'F' AND monthly THEN last_day(run_date)
    WHEN s = 'F' AND request_id % 2 = 0 THEN CAST(run_date + INTERVAL 6 DAY AS DATE)
    WHEN s = 'F' THEN run_date ELSE prev END AS end_date
FROM q""",
    "partition_row_counts": """
SELECT strftime(ts, '%Y-%m-%d') AS event_day, count(*) AS row_count FROM events GROUP BY 1""",
    "total_rows": "SELECT count(*) AS row_count FROM lineitem",
    "partition_bounds": """
SELECT min(strftime(l_shipdate, '%Y-%m')) AS min_partition, max(strftime(l_shipdate, '%Y-%m')) AS max_partition,
  count(*) AS row_count
FROM lineitem""",
    "distinct_partitions": """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS order_month FROM orders
WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1995-06' AND '2000-12'""",
    "quality_summary": """
SELECT count(*) AS row_count, count(DISTINCT k) AS partition_count, count(*) FILTER (WHERE k IS NULL) AS null_key_rows
FROM (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS k FROM events)""",
    "out_of_range_partitions": """
SELECT strftime(ts, '%Y-%m-%d') AS partition_value, count(*) AS row_count FROM events
WHERE CAST(ts AS DATE) NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY 1""",
    "missing_partitions": """
SELECT strftime(d, '%Y-%m-%d') AS partition_value
FROM generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-03', INTERVAL 1 DAY) g(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
    "gap_partitions": """
SELECT strftime(ts, '%Y-%m-%d') AS partition_value, count(*) AS rows_at_risk FROM events
WHERE dayofweek(ts) IN (0, 6) GROUP BY 1""",
    "reconcile_partitions": """
SELECT strftime(ts, '%Y-%m-%d') AS partition_value, count(*) AS source_rows, count(*) AS target_rows, TRUE AS is_match
FROM events GROUP BY 1""",
    "reconcile_contents": """
WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS d, value, event_id % 7 = 0 AND CAST(ts AS DATE) = DATE '2024-01-20' AS lost FROM events),
s AS (SELECT d AS partition_value, count(*) FILTER (WHERE NOT lost) AS source_rows, count(*) AS target_rows,
  coalesce(bool_or(d = '2024-01-12' AND value <> 0), FALSE) AS other FROM e GROUP BY 1)
SELECT partition_value, source_rows, target_rows, source_rows = target_rows AS same_rows,
  source_rows = target_rows AND NOT other AS same_content FROM s""",
    "replace_day_partitions": """
SELECT event_id, CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
  THEN value * 2 ELSE value END AS value, strftime(ts, '%Y-%m-%d') AS event_day
FROM events""",
    "replace_clustered_days": """
SELECT event_id, value * CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-12' AND DATE '2024-01-13' THEN 3
    WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-11' THEN 2 ELSE 1 END AS value,
  CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-12' AND DATE '2024-01-13' THEN event_type END AS event_type,
  strftime(ts, '%Y-%m-%d') AS event_day
FROM events""",
    "replace_month_partitions": """
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS order_month FROM orders
WHERE strftime(o_orderdate, '%Y-%m') NOT IN ('1996-02', '1996-03') OR o_orderstatus = 'F'""",
    "replace_staged_partitions": """
SELECT c_nationkey, count(*) AS orders, strftime(o_orderdate, '%Y-%m') AS order_month
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 3""",
    "replace_full": """
SELECT p_partkey AS product_code, p_name AS product_name, p_brand AS product_brand FROM part WHERE p_size > 25""",
    "evolve_schema": """
SELECT event_id, value, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN event_type END AS event_type,
  strftime(ts, '%Y-%m-%d') AS event_day
FROM events""",
    "evolve_nested": """
SELECT event_id, event_type AS kind, CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-17' THEN value END AS worth,
  CAST(CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-17' THEN 2 ELSE 1 END AS BIGINT) AS version,
  strftime(ts, '%Y-%m-%d') AS event_day
FROM events""",
    "publish_view": "SELECT event_type, count(*) AS row_count FROM events GROUP BY 1",
    "create_on_first_load": """
SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS event_day FROM events""",
    "preview_dry_run": """
SELECT strftime(ts, '%Y-%m-%d') AS partition_value, count(*) AS would_write FROM events GROUP BY 1""",
    "compact_partitions": """
SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS event_day FROM events""",
    "load_report": """
SELECT strftime(g.d, '%Y-%m-%d') AS partition_value, count(e.event_id) AS rows_read,
  count(e.event_id) FILTER (WHERE e.event_type <> 'purchase' AND g.d < TIMESTAMP '2024-01-30') AS rows_before,
  count(e.event_id) AS rows_after, CASE WHEN count(e.event_id) > 0 THEN 'written' ELSE 'missing' END AS status
FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-02', INTERVAL 1 DAY) g(d)
LEFT JOIN events e ON CAST(e.ts AS DATE) = CAST(g.d AS DATE) GROUP BY 1, g.d""",
    "reload_changed_days": """
WITH days AS (SELECT strftime(ts, '%Y-%m-%d') AS d, count(*) AS n,
  count(*) FILTER (WHERE NOT (CAST(ts AS DATE) = DATE '2024-01-20' AND event_id % 7 = 0)) AS kept,
  coalesce(bool_or(value <> 0), false) AS worth FROM events
  WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY 1)
SELECT d AS partition_value, kept AS rows_read, n AS rows_before, kept AS rows_after,
  CASE WHEN kept = n AND NOT (d = '2024-01-12' AND worth) THEN 'unchanged' ELSE 'written' END AS status
FROM days""",
}
