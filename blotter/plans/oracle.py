"""DuckDB oracle SQL for the registered queries (same column names/types).

The tables are the driver's views (lineitem, part, orders, events, ...).
"""

from __future__ import annotations

INC = """inc AS (
  SELECT l_orderkey * 10 + l_linenumber AS id,
         l_shipdate AS ts,
         CAST(l_partkey AS VARCHAR) AS iucr_code,
         l_returnflag = 'R' AS arrest,
         l_linestatus = 'O' AS domestic,
         CAST(l_suppkey % 25 AS INTEGER) AS district
  FROM lineitem)"""

CODES = """codes AS (
  SELECT CASE WHEN length(CAST(p_partkey AS VARCHAR)) = 3 THEN '0' || CAST(p_partkey AS VARCHAR)
              ELSE CAST(p_partkey AS VARCHAR) END AS code,
         p_type AS primary_description,
         p_name AS secondary_description,
         p_size <= 25 AS monitored_by_fbi
  FROM part)"""

ENR = """enr AS (
  SELECT inc.*, coalesce(c.primary_description, '') AS primary_description,
         coalesce(c.monitored_by_fbi, false) AS monitored_by_fbi
  FROM inc LEFT JOIN codes c ON inc.iucr_code = c.code)"""

BASE = f"WITH {INC},\n{CODES},\n{ENR}"

IMAGE = """image AS (
  SELECT district, CAST(month(date_trunc('month', ts)) AS INTEGER) AS month, primary_description,
         count(*) AS count,
         count(*) FILTER (WHERE arrest) AS count_arrest,
         count(*) FILTER (WHERE domestic) AS count_domestic,
         count(*) FILTER (WHERE monitored_by_fbi) AS count_monitored_by_fbi,
         date_trunc('month', ts) AS month_start,
         date_trunc('month', ts) + INTERVAL 1 MONTH AS month_end
  FROM enr GROUP BY district, date_trunc('month', ts), primary_description)"""

CLOSED = """closed AS (
  SELECT * FROM image WHERE month_end <= (SELECT max(ts) - INTERVAL 1 DAY FROM inc))"""

SERVING = """serving AS (
  SELECT district, month, primary_description,
         arg_max(count, month_start) AS count,
         arg_max(count_arrest, month_start) AS count_arrest,
         arg_max(count_domestic, month_start) AS count_domestic,
         arg_max(count_monitored_by_fbi, month_start) AS count_monitored_by_fbi
  FROM closed GROUP BY district, month, primary_description)"""

WINDOWS = """windows AS (
  SELECT date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS start,
         date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) + INTERVAL 30 DAY AS "end",
         district, count(*) AS count,
         count(*) FILTER (WHERE monitored_by_fbi) AS count_monitored_by_fbi
  FROM (SELECT ts, district, monitored_by_fbi, unnest(range(0, 30)) AS k FROM enr)
  GROUP BY 1, 2, district)"""

RESULTS = """results AS (
  SELECT start, "end", district, count, count_monitored_by_fbi,
         count_monitored_by_fbi / CAST(count AS DOUBLE) * 100.0 AS percentage_monitored_by_fbi
  FROM windows)"""

ALERTS = """alerts AS (
  SELECT * FROM results
  WHERE percentage_monitored_by_fbi > 60.0
    AND "end" <= (SELECT max(ts) - INTERVAL 1 DAY FROM inc))"""

MESSAGES = """SELECT 'CrimeAnomalyResult(start=' || strftime(start, '%Y-%m-%dT%H:%M')
       || ', end=' || strftime("end", '%Y-%m-%dT%H:%M')
       || ', district=' || CAST(district AS VARCHAR)
       || ', count=' || CAST(count AS VARCHAR)
       || ', countMonitoredByFbi=' || CAST(count_monitored_by_fbi AS VARCHAR)
       || ', percentageMonitoredByFbi=' || CAST(percentage_monitored_by_fbi AS VARCHAR) || ')' AS value
FROM alerts"""

PARSED = """SELECT l_orderkey * 10 + l_linenumber AS id,
       CASE WHEN l_linenumber = 2 THEN CAST(last_day(l_shipdate) AS TIMESTAMP)
            WHEN l_linenumber = 4 THEN l_shipdate + INTERVAL 1 DAY ELSE l_shipdate END AS date,
       CAST(l_partkey AS VARCHAR) AS iucr_code,
       l_returnflag = 'R' AS arrest,
       l_linestatus = 'O' AS domestic,
       CAST(CASE WHEN l_linenumber = 3 THEN l_suppkey % 25 + 1
                 WHEN l_linenumber = 5 THEN -(l_suppkey % 25)
                 ELSE l_suppkey % 25 END AS INTEGER) AS district
FROM lineitem WHERE l_linenumber <> 7"""

ORDERS_RUNNING = """WITH o AS (
  SELECT o_orderkey AS id, o_orderdate AS ts, o_orderstatus AS primary_description,
         CAST(o_custkey % 25 AS INTEGER) AS district,
         o_orderpriority = '1-URGENT' AS arrest, o_orderpriority = '2-HIGH' AS domestic,
         o_totalprice > 200000 AS monitored_by_fbi,
         date_trunc('month', o_orderdate) AS month_start
  FROM orders)
SELECT id, district, CAST(month(month_start) AS INTEGER) AS month, primary_description, month_start,
       count(*) OVER w AS count,
       CAST(sum(CASE WHEN arrest THEN 1 ELSE 0 END) OVER w AS BIGINT) AS count_arrest,
       CAST(sum(CASE WHEN domestic THEN 1 ELSE 0 END) OVER w AS BIGINT) AS count_domestic,
       CAST(sum(CASE WHEN monitored_by_fbi THEN 1 ELSE 0 END) OVER w AS BIGINT) AS count_monitored_by_fbi
FROM o
WINDOW w AS (PARTITION BY primary_description, district, month_start ORDER BY ts, id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

ORDERS_IMAGE_CLOSED = """WITH o AS (
  SELECT o_orderdate AS ts, o_orderstatus AS primary_description,
         CAST(o_custkey % 25 AS INTEGER) AS district,
         o_orderpriority = '1-URGENT' AS arrest, o_orderpriority = '2-HIGH' AS domestic,
         o_totalprice > 200000 AS monitored_by_fbi
  FROM orders)
SELECT district, CAST(month(date_trunc('month', ts)) AS INTEGER) AS month, primary_description,
       count(*) AS count,
       count(*) FILTER (WHERE arrest) AS count_arrest,
       count(*) FILTER (WHERE domestic) AS count_domestic,
       count(*) FILTER (WHERE monitored_by_fbi) AS count_monitored_by_fbi,
       date_trunc('month', ts) AS month_start
FROM o
GROUP BY district, date_trunc('month', ts), primary_description
HAVING date_trunc('month', ts) + INTERVAL 1 MONTH <= (SELECT max(o_orderdate) - INTERVAL 1 DAY FROM orders)"""

EVENTS_SLIDING = """SELECT date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS start,
       date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) + INTERVAL 7 DAY AS "end",
       event_type, count(*) AS count, CAST(sum(round(value * 100)) AS BIGINT) AS total_cents,
       max(value) AS max_value
FROM (SELECT ts, event_type, value, unnest(range(0, 7)) AS k FROM events)
GROUP BY 1, 2, event_type
HAVING date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) + INTERVAL 7 DAY
       <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"""


LATE_ORDERS = ORDERS_IMAGE_CLOSED.replace(
    "FROM orders)",
    "FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '1999-06-01' AND o_orderdate < TIMESTAMP '1999-07-01'))", 1)

# arrivals with late rows: stage 3 holds June 1999 and the first week of June 2001
LATE = """staged AS (
  SELECT *, CASE WHEN ts >= TIMESTAMP '1999-06-01' AND ts < TIMESTAMP '1999-07-01' THEN 3
                 WHEN ts < TIMESTAMP '2000-01-01' THEN 1
                 WHEN ts >= TIMESTAMP '2001-06-01' AND ts < TIMESTAMP '2001-06-08' THEN 3
                 WHEN ts < TIMESTAMP '2001-06-10' THEN 2 ELSE 3 END AS stage
  FROM enr),
marked AS (
  SELECT *, CASE stage WHEN 2 THEN (SELECT max(ts) - INTERVAL 1 DAY FROM staged WHERE stage = 1)
                       WHEN 3 THEN (SELECT max(ts) - INTERVAL 1 DAY FROM staged WHERE stage < 3) END AS mark
  FROM staged),
pairs AS (
  SELECT *, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS start,
         date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) + INTERVAL 30 DAY AS "end"
  FROM (SELECT *, unnest(range(0, 30)) AS k FROM marked))"""

LATE_WINDOWS = """windows AS (
  SELECT start, "end", district, count(*) AS count, count(*) FILTER (WHERE monitored_by_fbi) AS count_monitored_by_fbi
  FROM pairs WHERE mark IS NULL OR "end" > mark GROUP BY 1, 2, district)"""


def oracle_sql() -> dict[str, str]:
    return {
        "stream_state_log": ORDERS_RUNNING,
        "stream_late_rows_resized": LATE_ORDERS,
        "stream_lagging_partition": ORDERS_IMAGE_CLOSED.replace(
            "(SELECT max(o_orderdate) - INTERVAL 1 DAY FROM orders)",
            "(SELECT min(m) - INTERVAL 1 DAY FROM (SELECT max(o_orderdate) AS m FROM orders GROUP BY o_custkey % 2))"),
        "stream_late_windows": f"{BASE},\n{LATE},\n{LATE_WINDOWS},\n{RESULTS},\n{ALERTS}\n{MESSAGES}".replace("> 60.0", "> 50.0"),
        "stream_late_counts": f"""{BASE},\n{LATE}
SELECT (SELECT count(*) FROM marked WHERE date_trunc('month', ts) + INTERVAL 1 MONTH <= mark) AS late_rows,
       (SELECT count(*) FROM pairs WHERE "end" <= mark) AS late_windows""",
        "stream_hot_code": (f"{BASE},\n{IMAGE},\n{CLOSED},\n{SERVING}\nSELECT * FROM serving"
                            .replace("CAST(l_partkey AS VARCHAR) AS iucr_code",
                                     "CASE WHEN (l_orderkey * 10 + l_linenumber) % 30 < 10 THEN '1' ELSE CAST(l_partkey AS VARCHAR) END AS iucr_code")),
        "parse_csv_records": PARSED,
        "parse_rejects": """WITH damaged AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_linenumber IN (3, 5) AS no_district, *
  FROM lineitem WHERE l_linenumber IN (3, 5) OR (l_linestatus = 'O' AND l_linenumber <> 7))
SELECT CAST(id AS VARCHAR) AS key,
       concat_ws(',', CAST(id AS VARCHAR),
         CASE l_linenumber WHEN 2 THEN strftime(l_shipdate, '%Y-%m-31T%H:%M:%S')
                           WHEN 4 THEN strftime(l_shipdate, '%Y-%m-%dT24:00:00')
                           ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END || CASE WHEN no_district THEN '.000Z' ELSE 'Z' END,
         CAST(l_partkey AS VARCHAR),
         CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'TRUE' ELSE 'True' END
              WHEN l_returnflag = 'A' THEN 'yes' ELSE 'False' END,
         CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'F' END,
         CASE WHEN no_district THEN '' ELSE CAST(l_suppkey % 25 AS VARCHAR) || '.0' END,
         '1.0', '41.8', '-87.6') AS value,
       CASE WHEN no_district THEN 'bad district' ELSE 'bad date' END AS reason
FROM damaged""",
        "lookup_missing_fails": "SELECT count(*) AS codes, true AS failed FROM part",
        "stream_running_resume": ORDERS_RUNNING,
        "replay_path_order": f"""{BASE},\n{IMAGE},\n{CLOSED}
SELECT district, month, primary_description, count, count_arrest, count_domestic, count_monitored_by_fbi,
       month_start FROM closed""",
        "serving_rerun_fresh_checkpoint": f"{BASE},\n{IMAGE},\n{CLOSED},\n{SERVING}\nSELECT * FROM serving",
        "job_stream_alerts": f"{BASE},\n{WINDOWS},\n{RESULTS},\n{ALERTS}\n{MESSAGES}",
        "job_mode_a_serving": f"""{BASE},\n{IMAGE}
SELECT district, month, primary_description,
       arg_max(count, month_start) AS count,
       arg_max(count_arrest, month_start) AS count_arrest,
       arg_max(count_domestic, month_start) AS count_domestic,
       arg_max(count_monitored_by_fbi, month_start) AS count_monitored_by_fbi
FROM image GROUP BY district, month, primary_description""",
        "keyed_line_ingest": PARSED,
        "lookup_scan_pad": f"WITH {CODES} SELECT * FROM codes",
        "enrich_left_broadcast": f"""{BASE}
SELECT id, ts, iucr_code, arrest, domestic, district, primary_description, monitored_by_fbi FROM enr""",
        "enrich_shuffle_salted": f"""{BASE}
SELECT id, ts, iucr_code, arrest, domestic, district, primary_description, monitored_by_fbi FROM enr""",
        "month_image_all": f"{BASE},\n{IMAGE}\nSELECT * FROM image",
        "month_image_closed": f"{BASE},\n{IMAGE},\n{CLOSED}\nSELECT * FROM closed",
        "month_image_running": ORDERS_RUNNING,
        "running_hot_keys": """SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate,
       count(*) OVER w AS count,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS count_open
FROM lineitem
WINDOW w AS (PARTITION BY l_returnflag
             ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                      l_extendedprice, l_discount, l_tax, l_linestatus
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "serving_upsert": f"{BASE},\n{IMAGE},\n{CLOSED},\n{SERVING}\nSELECT * FROM serving",
        "serving_upsert_keep_year": f"""{BASE},\n{IMAGE},\n{CLOSED}
SELECT district, CAST(year(month_start) AS INTEGER) AS year, month, primary_description,
       count, count_arrest, count_domestic, count_monitored_by_fbi FROM closed""",
        "serving_filtered_read": f"""{BASE},\n{IMAGE},\n{CLOSED},\n{SERVING}
SELECT * FROM serving WHERE district = 7 AND month >= 6""",
        "sliding_counts": f"{BASE},\n{WINDOWS}\nSELECT * FROM windows",
        "anomaly_alerts": f"{BASE},\n{WINDOWS},\n{RESULTS},\n{ALERTS}\nSELECT * FROM alerts",
        "anomaly_messages": f"{BASE},\n{WINDOWS},\n{RESULTS},\n{ALERTS}\n{MESSAGES}",
        "job_month_image": f"{BASE},\n{IMAGE},\n{CLOSED}\nSELECT * FROM closed",
        "job_alert_messages": f"{BASE},\n{WINDOWS},\n{RESULTS},\n{ALERTS}\n{MESSAGES}",
        "alert_log_roundtrip": f"{BASE},\n{WINDOWS},\n{RESULTS},\n{ALERTS}\n{MESSAGES}",
        "anomaly_all_windows": f"""{BASE},\n{WINDOWS},\n{RESULTS}
SELECT * FROM results WHERE percentage_monitored_by_fbi > 50.0""",
        "stream_month_image_c": ORDERS_IMAGE_CLOSED,
        "stream_sliding_events": EVENTS_SLIDING,
        "stream_month_image_a": ORDERS_RUNNING,
        "stream_anomaly_alerts": f"{BASE},\n{WINDOWS},\n{RESULTS},\n{ALERTS}\n{MESSAGES}",
        "stream_serving_image_c": f"{BASE},\n{IMAGE},\n{CLOSED},\n{SERVING}\nSELECT * FROM serving",
        "stream_serving_image_a": f"""{BASE},\n{IMAGE}
SELECT district, month, primary_description,
       arg_max(count, month_start) AS count,
       arg_max(count_arrest, month_start) AS count_arrest,
       arg_max(count_domestic, month_start) AS count_domestic,
       arg_max(count_monitored_by_fbi, month_start) AS count_monitored_by_fbi
FROM image GROUP BY district, month, primary_description""",
        "job_stream_serving": f"{BASE},\n{IMAGE},\n{CLOSED},\n{SERVING}\nSELECT * FROM serving",
        "stream_late_rows": LATE_ORDERS,
    }
