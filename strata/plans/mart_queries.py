"""Mart queries over events, parsed log lines, orders and line items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import parse as P
from strata.operators import checks as CK
from strata.operators import keyed as K
from strata.operators import marts as M
from strata.operators import reconcile as R
from strata.plans import derive as D
from strata.plans.reconcile_queries import STRAY_SQL, _orders, _stray_shipments
from strata.plans.registry import register
from strata.session import scratch_path
from strata.sinks import files as sinks
from strata.sources.tables import read_table

SESSION_GAP_SECONDS = 30 * 60
FAILURE_WINDOW_SECONDS = 15 * 60
FUNNEL_STEPS = ("signup", "view", "click", "purchase", "error")

# Parsed access-log rows of the events, in SQL (for the oracles).
_LOGS_SQL = f"""
  SELECT event_id AS src_id,
    CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS log_ts,
    CASE event_type WHEN 'click' THEN 'catalog-service' WHEN 'view' THEN 'api-gateway'
         WHEN 'purchase' THEN 'checkout-service' WHEN 'signup' THEN 'api-gateway' ELSE 'payment-service' END
      AS service,
    CASE event_type WHEN 'click' THEN '/search' WHEN 'view' THEN '/product' WHEN 'purchase' THEN '/checkout'
         WHEN 'signup' THEN '/home' ELSE '/checkout' END AS path,
    CASE WHEN event_id % 101 = 5 THEN NULL
         WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 500 ELSE 504 END
         WHEN event_id % 8 = 0 THEN 404 WHEN event_id % 8 = 1 THEN 400
         WHEN event_id % 8 = 2 THEN 201 ELSE 200 END AS status_code,
    CAST(floor(value * 100) % 2990 + 10 AS INTEGER) AS latency_ms
  FROM events WHERE event_id % 34 NOT IN (0, 17)
"""


def _parsed_logs(spark, sf_dir) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    logs = P.parse_log_lines(D.server_log_lines(events), keep=("event_id",))
    ts = P.to_utc_wall_clock(spark, P.parse_time(F.col("timestamp")))
    return logs.withColumn("log_ts", ts)


@register("product_activity_window", sql="""
WITH w AS (
  SELECT date_trunc('minute', ts) - INTERVAL (k) MINUTE AS window_start,
         CAST(json_extract(props, '$.k') AS INTEGER) AS product_id, event_type, user_id
  FROM events, range(0, 5) r(k)),
agg AS (
  SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, product_id,
         CAST(count(*) AS BIGINT) AS interactions,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases,
         CAST(count(DISTINCT user_id) AS BIGINT) AS users
  FROM w GROUP BY window_start, product_id)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY interactions DESC, product_id)
                 AS INTEGER) AS rank
  FROM agg) WHERE rank <= 3
""")
def q_product_activity_window(spark, sf_dir):
    """Top 3 products per 5-minute window sliding by 1 minute."""
    events = read_table(spark, sf_dir, "events", "ts", "user_id", "event_type", "props")
    events = events.withColumn("product_id", F.get_json_object("props", "$.k").cast("int"))
    return M.product_activity(events, "ts", "product_id")


@register("service_health", sql=f"""
SELECT service, date_trunc('hour', log_ts) AS window_start, CAST(count(*) AS BIGINT) AS requests,
  CAST(count(*) FILTER (WHERE status_code >= 500) AS BIGINT) AS errors_5xx,
  CAST(count(*) FILTER (WHERE status_code >= 500) AS DOUBLE) / count(*) AS error_share,
  CAST(count(*) FILTER (WHERE status_code = 504) AS BIGINT) AS timeouts_504,
  round(quantile_cont(latency_ms, 0.5), 6) AS p50_latency_ms,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms,
  round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms
FROM ({_LOGS_SQL}) GROUP BY service, date_trunc('hour', log_ts)
""")
def q_service_health(spark, sf_dir):
    """Hourly health per service from the parsed access log.

    Percentiles are rounded to 6 decimals here (the operator keeps them
    exact): interpolation formulas differ between engines in the last bit.
    """
    return round_columns(M.service_health(_parsed_logs(spark, sf_dir), F.col("log_ts")), PERCENTILE_COLUMNS)


PERCENTILE_COLUMNS = ("p50_latency_ms", "p95_latency_ms", "p99_latency_ms")


def round_columns(df: DataFrame, names, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


def _shipment_events(spark, sf_dir) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    j = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    events = F.array(F.struct(F.lit("PICKED_UP").alias("event"), F.col("o_orderdate").alias("time")),
                     F.struct(F.lit("DELIVERED").alias("event"), F.col("l_shipdate").alias("time")))
    return j.select(F.concat(F.lit("carrier-"), (F.col("l_suppkey") % 4).cast("string")).alias("carrier"),
                    F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
                    .alias("tracking_number"),
                    F.explode(events).alias("e")).select("carrier", "tracking_number", "e.event", "e.time")


@register("carrier_latency", sql="""
WITH per AS (
  SELECT 'carrier-' || (l_suppkey % 4) AS carrier, l_orderkey || '-' || l_linenumber AS tracking_number,
         min(o_orderdate) AS p, max(l_shipdate) AS d
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2),
lat AS (SELECT carrier, CAST(floor((epoch(d) - epoch(p)) / 86400) AS BIGINT) AS latency FROM per),
stats AS (
  SELECT carrier,
    CAST(count(*) FILTER (WHERE latency >= 0) AS BIGINT) AS delivered,
    CAST(count(*) FILTER (WHERE latency < 0) AS BIGINT) AS invalid,
    CAST(count(*) FILTER (WHERE latency IS NULL) AS BIGINT) AS open,
    avg(latency) FILTER (WHERE latency >= 0) AS avg_latency,
    round(quantile_cont(latency, 0.5) FILTER (WHERE latency >= 0), 6) AS p50_latency,
    round(quantile_cont(latency, 0.95) FILTER (WHERE latency >= 0), 6) AS p95_latency,
    max(latency) FILTER (WHERE latency >= 0) AS max_latency
  FROM lat GROUP BY carrier)
SELECT *, CAST(rank() OVER (ORDER BY avg_latency DESC NULLS LAST) AS INTEGER) AS worst_rank FROM stats
""")
def q_carrier_latency(spark, sf_dir):
    """Pickup at the order date, delivery at the ship date, carrier by
    supplier; deliveries dated before pickup are counted as invalid."""
    return round_columns(M.carrier_latency(_shipment_events(spark, sf_dir)), ("p50_latency", "p95_latency"))


@register("sessions", sql=f"""
WITH g AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL
                   OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {SESSION_GAP_SECONDS} * 1000000
                 THEN 1 ELSE 0 END AS is_start
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, max(CASE WHEN is_start = 1 THEN ts END)
          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_start FROM g)
SELECT user_id, session_start, max(ts) AS session_end, CAST(count(*) AS BIGINT) AS events,
  CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS views,
  CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicks,
  CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases
FROM s GROUP BY user_id, session_start
""")
def q_sessions(spark, sf_dir):
    """User sessions split at gaps over 30 minutes (gaps and islands)."""
    events = read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type")
    tagged = K.sessionize(events, ["user_id"], "ts", ["event_id"], SESSION_GAP_SECONDS)
    return M.sessions(tagged, ["user_id"], "ts")


@register("funnel", sql="""
SELECT user_id, CAST(count(*) AS BIGINT) AS n_events,
  CAST(count(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS n_signup,
  CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS n_view,
  CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS n_click,
  CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS n_purchase,
  CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS n_error
FROM events GROUP BY user_id
""")
def q_funnel(spark, sf_dir):
    """Events per funnel step and user."""
    return M.funnel(read_table(spark, sf_dir, "events", "user_id", "event_type"), "user_id", FUNNEL_STEPS)


@register("purchase_vs_orders", sql="""
WITH p AS (SELECT user_id AS customer_id, count(*) AS purchase_events FROM events
           WHERE event_type = 'purchase' GROUP BY user_id),
o AS (SELECT o_custkey AS customer_id, count(*) AS orders FROM orders GROUP BY o_custkey)
SELECT coalesce(p.customer_id, o.customer_id) AS customer_id,
  CAST(coalesce(purchase_events, 0) AS BIGINT) AS purchase_events, CAST(coalesce(orders, 0) AS BIGINT) AS orders,
  CASE WHEN purchase_events IS NOT NULL AND orders IS NOT NULL THEN 'matched'
       WHEN orders IS NULL THEN 'no_order' ELSE 'no_event' END AS status
FROM p FULL OUTER JOIN o ON p.customer_id = o.customer_id
""")
def q_purchase_vs_orders(spark, sf_dir):
    """B2: purchase events against orders per customer."""
    purchases = read_table(spark, sf_dir, "events", "user_id", "event_type").where(
        F.col("event_type") == "purchase")
    return M.purchases_vs_orders(purchases, read_table(spark, sf_dir, "orders", "o_custkey"))


@register("purchase_log_interval_join", sql=f"""
WITH p AS (SELECT event_id, ts FROM events WHERE event_type = 'purchase'),
f AS (SELECT log_ts FROM ({_LOGS_SQL}) WHERE path = '/checkout' AND status_code >= 500)
SELECT p.event_id, p.ts,
  CAST(count(f.log_ts) FILTER (WHERE f.log_ts BETWEEN p.ts - INTERVAL {FAILURE_WINDOW_SECONDS} SECOND
                                            AND p.ts + INTERVAL {FAILURE_WINDOW_SECONDS} SECOND) AS BIGINT)
    AS n_within,
  (epoch_us(p.ts) - epoch_us(max(f.log_ts) FILTER (
      WHERE f.log_ts BETWEEN p.ts - INTERVAL {FAILURE_WINDOW_SECONDS} SECOND AND p.ts))) / 1000000.0
    AS seconds_since_last
FROM p LEFT JOIN f ON f.log_ts BETWEEN p.ts - INTERVAL {FAILURE_WINDOW_SECONDS} SECOND
                               AND p.ts + INTERVAL {FAILURE_WINDOW_SECONDS} SECOND
GROUP BY p.event_id, p.ts
""")
def q_purchase_log_interval_join(spark, sf_dir):
    """Per purchase, failing /checkout requests within 15 minutes."""
    purchases = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type").where(
        F.col("event_type") == "purchase").select("event_id", "ts")
    logs = _parsed_logs(spark, sf_dir)
    failures = logs.where((F.col("path") == "/checkout") & (F.col("status_code") >= 500)).select("log_ts")
    return M.failures_near_purchases(purchases, failures, FAILURE_WINDOW_SECONDS)


# The time of the run that found the discrepancies.
DETECTED_AT = "2024-02-01 00:00:00"


def _discrepancies(spark, sf_dir) -> DataFrame:
    at = F.lit(DETECTED_AT).cast("timestamp_ntz")
    # All order/shipment kinds come from one pass over one per-key table, so
    # line items are scanned and shuffled once.
    found = R.key_findings(R.key_counts(_orders(spark, sf_dir), _stray_shipments(spark, sf_dir)))
    what = F.when(F.col("kind").isin("missing_shipment", "duplicate_order"), "order rows").otherwise("shipment rows")
    keyed = M.discrepancy(found, F.col("kind"), F.col("order_id"), F.concat_ws(" ", F.col("n").cast("string"), what), at)
    purchases = read_table(spark, sf_dir, "events", "user_id", "event_type").where(
        F.col("event_type") == "purchase")
    pvo = M.purchases_vs_orders(purchases, read_table(spark, sf_dir, "orders", "o_custkey"))
    kind = F.when(F.col("status") == "no_order", "unmatched_purchase").otherwise("order_without_event")
    unmatched = M.discrepancy(pvo.where(F.col("status") != "matched"), kind, F.col("customer_id"), F.col("status"), at)
    checks = CK.constraint_report(_stray_customers(spark, sf_dir), "customer", ["c_custkey"], ["c_name", "c_mktsegment"])
    breaches = M.discrepancy(checks.where(F.col("violations") > 0), "constraint_breach",
                             F.concat_ws(".", "table", "column"), F.concat_ws(" ", "check", "violations"), at)
    orphans = CK.orphan_keys(read_table(spark, sf_dir, "events", "user_id"), "user_id",
                             read_table(spark, sf_dir, "customer", "c_custkey"), "c_custkey", "events.user_id->customer")
    dangling = M.discrepancy(orphans, "referential_breach", F.col("key"), F.concat_ws(" ", "relation", "rows"), at)
    return reduce(DataFrame.unionByName, [keyed, unmatched, breaches, dangling])


def _stray_customers(spark, sf_dir) -> DataFrame:
    """Customers as delivered by a feed: every 29th arrives twice, every 31st without its segment."""
    key = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment").select(
        F.explode(F.when(key % 29 == 0, F.array(key, key)).otherwise(F.array(key))).alias("c_custkey"), "c_name",
        F.when(key % 31 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))


_DISCREPANCIES_SQL = f"""
  WITH ship AS (SELECT k, count(*) AS n FROM ({STRAY_SQL}) WHERE k IS NOT NULL AND k <> 0 GROUP BY k),
  ord AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY o_orderkey),
  found AS (
    SELECT 'missing_shipment' AS kind, 'high' AS severity, CAST(k AS VARCHAR) AS "key", n || ' order rows' AS detail
    FROM ord WHERE k IS NOT NULL AND k <> 0 AND k NOT IN (SELECT k FROM ship)
    UNION ALL SELECT 'duplicate_order', 'medium', CAST(k AS VARCHAR), n || ' order rows' FROM ord WHERE k <> 0 AND n > 1
    UNION ALL SELECT 'orphan_shipment', 'medium', CAST(k AS VARCHAR), n || ' shipment rows' FROM ship
      WHERE k NOT IN (SELECT k FROM ord WHERE k IS NOT NULL)
    UNION ALL SELECT 'duplicate_shipment', 'low', CAST(k AS VARCHAR), n || ' shipment rows' FROM ship WHERE n > 1
    UNION ALL
    SELECT CASE WHEN o.customer_id IS NULL THEN 'unmatched_purchase' ELSE 'order_without_event' END,
           CASE WHEN o.customer_id IS NULL THEN 'high' ELSE 'medium' END,
           CAST(coalesce(p.customer_id, o.customer_id) AS VARCHAR),
           CASE WHEN o.customer_id IS NULL THEN 'no_order' ELSE 'no_event' END
    FROM (SELECT DISTINCT user_id AS customer_id FROM events WHERE event_type = 'purchase') p
    FULL OUTER JOIN (SELECT DISTINCT o_custkey AS customer_id FROM orders) o ON p.customer_id = o.customer_id
    WHERE p.customer_id IS NULL OR o.customer_id IS NULL
    UNION ALL
    SELECT 'constraint_breach', 'high', 'customer.c_custkey', 'primary_key ' || count(*)
    FROM customer WHERE c_custkey % 29 = 0 HAVING count(*) > 0
    UNION ALL
    SELECT 'constraint_breach', 'high', 'customer.c_mktsegment',
           'not_null ' || sum(CASE WHEN c_custkey % 29 = 0 THEN 2 ELSE 1 END)
    FROM customer WHERE c_custkey % 31 = 0 HAVING count(*) > 0
    UNION ALL
    SELECT 'referential_breach', 'high', CAST(user_id AS VARCHAR), 'events.user_id->customer ' || count(*)
    FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer) GROUP BY user_id)
  SELECT *, TIMESTAMP '{DETECTED_AT}' AS detected_at FROM found
"""


@register("discrepancies", sql=_DISCREPANCIES_SQL)
def q_discrepancies(spark, sf_dir):
    """One table of all discrepancy kinds ``(kind, severity, key, detail, detected_at)``."""
    return _discrepancies(spark, sf_dir)


@register("discrepancy_counts", sql=f"""
SELECT coalesce(severity, 'ALL') AS severity, coalesce(kind, 'ALL') AS kind, CAST(count(*) AS BIGINT) AS n
FROM ({_DISCREPANCIES_SQL}) GROUP BY ROLLUP (severity, kind)
""")
def q_discrepancy_counts(spark, sf_dir):
    """Discrepancy counts by severity and kind with subtotals (rollup)."""
    return M.discrepancy_counts(_discrepancies(spark, sf_dir))


RUNS = ("2024-02-01 00:00:00", "2024-02-02 00:00:00")


def _snapshot_sql(lines: str) -> str:
    return f"""
  SELECT * FROM (
    WITH ship AS (SELECT k, count(*) AS n FROM ({lines}) WHERE k <> 0 GROUP BY k),
    ord AS (SELECT o_orderkey AS k, count(*) AS n FROM orders WHERE o_orderkey <> 0 GROUP BY o_orderkey)
    SELECT 'missing_shipment' AS kind, 'high' AS severity, CAST(k AS VARCHAR) AS "key", n || ' rows' AS detail FROM ord WHERE k NOT IN (SELECT k FROM ship)
    UNION ALL SELECT 'duplicate_order', 'medium', CAST(k AS VARCHAR), n || ' rows' FROM ord WHERE n > 1
    UNION ALL SELECT 'orphan_shipment', 'medium', CAST(k AS VARCHAR), n || ' rows' FROM ship WHERE k NOT IN (SELECT k FROM ord)
    UNION ALL SELECT 'duplicate_shipment', 'low', CAST(k AS VARCHAR), n || ' rows' FROM ship WHERE n > 1)"""


@register("discrepancy_life_cycle", sql=f"""
WITH a AS ({_snapshot_sql("SELECT l_orderkey AS k FROM lineitem WHERE l_linenumber % 2 = 0")}),
b AS ({_snapshot_sql(STRAY_SQL)})
SELECT coalesce(b.kind, a.kind) AS kind, coalesce(b.severity, a.severity) AS severity, coalesce(b.key, a.key) AS "key",
  coalesce(b.detail, a.detail) AS detail, CASE WHEN a.key IS NULL THEN TIMESTAMP '{RUNS[1]}' ELSE TIMESTAMP '{RUNS[0]}' END AS first_seen,
  CASE WHEN b.key IS NULL THEN TIMESTAMP '{RUNS[0]}' ELSE TIMESTAMP '{RUNS[1]}' END AS last_seen,
  CASE WHEN b.key IS NULL THEN TIMESTAMP '{RUNS[1]}' END AS resolved_at
FROM a FULL JOIN b ON a.kind = b.kind AND a.key = b.key
""")
def q_discrepancy_life_cycle(spark, sf_dir):
    """Two runs of the reconciliation, the first before the odd lines of the
    shipment feed have come. Discrepancies open in the first run, stay open,
    are resolved or open anew in the second."""
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    early = lines.where(F.col("l_linenumber") % 2 == 0).select(F.col("l_orderkey").alias("order_id"))
    tracked = None
    for at, shipments in zip(RUNS, (early, _stray_shipments(spark, sf_dir))):
        run_at = F.lit(at).cast("timestamp_ntz")
        keys = R.key_findings(R.key_counts(_orders(spark, sf_dir), shipments))
        found = M.discrepancy(keys, F.col("kind"), F.col("order_id"), F.concat_ws(" ", F.col("n").cast("string"), F.lit("rows")), run_at)
        path = sinks.write_table(M.track_discrepancies(tracked, found, run_at), scratch_path(spark, "discrepancy-life-cycle"))
        tracked = spark.read.parquet(path)
    return tracked


VIEW_WINDOW_SECONDS = 30 * 60


@register("purchase_view_within", sql=f"""
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts AS vts FROM events WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.ts,
  CAST(count(v.vts) AS BIGINT) AS n_within,
  (epoch_us(p.ts) - epoch_us(max(v.vts) FILTER (WHERE v.vts <= p.ts))) / 1000000.0 AS seconds_since_last,
  CASE WHEN count(v.vts) > 0 THEN 'matched' ELSE 'no_view' END AS status
FROM p LEFT JOIN v ON v.user_id = p.user_id
  AND v.vts BETWEEN p.ts - INTERVAL {VIEW_WINDOW_SECONDS} SECOND AND p.ts + INTERVAL {VIEW_WINDOW_SECONDS} SECOND
GROUP BY p.event_id, p.user_id, p.ts
""")
def q_purchase_view_within(spark, sf_dir):
    """B2/B9 with a time bound, keyed: per purchase, the same user's views
    within 30 minutes (count, seconds since the last one before it) and a
    matched / no_view status; pair-free running counts per (user, bucket)."""
    events = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type")
    purchases = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    views = events.where(F.col("event_type") == "view").select("user_id", F.col("ts").alias("vts"))
    counted = M.count_within(purchases, "event_id", "ts", views, "vts", VIEW_WINDOW_SECONDS, keys=["user_id"])
    return counted.withColumn("status", F.when(F.col("n_within") > 0, "matched").otherwise("no_view"))


# Events lie in January 2024 and orders in 1995 to 2001. Moving every order by the same 24 years brings
# some of them to the events' month; no order is left out.
ORDER_SHIFT_DAYS = 8766
ORDER_WINDOW_SECONDS = 10 * 86_400


@register("purchase_events_vs_orders", sql=f"""
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
o AS (SELECT o_custkey, o_orderdate + INTERVAL {ORDER_SHIFT_DAYS} DAY AS ots FROM orders)
SELECT p.event_id, p.user_id, p.ts, CAST(count(o.ots) AS BIGINT) AS n_within,
  (epoch_us(p.ts) - epoch_us(max(o.ots) FILTER (WHERE o.ots <= p.ts))) / 1000000.0 AS seconds_since_last,
  CASE WHEN count(o.ots) > 0 THEN 'matched' ELSE 'no_order' END AS status
FROM p LEFT JOIN o ON o.o_custkey = p.user_id
  AND o.ots BETWEEN p.ts - INTERVAL {ORDER_WINDOW_SECONDS} SECOND AND p.ts + INTERVAL {ORDER_WINDOW_SECONDS} SECOND
GROUP BY p.event_id, p.user_id, p.ts
""")
def q_purchase_events_vs_orders(spark, sf_dir):
    """B2 per event: did the purchase reach the order system, as an order of
    the same customer within ten days of it?"""
    purchases = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type").where(
        F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    orders = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
    moved = orders.withColumn("o_orderdate", F.col("o_orderdate") + F.expr(f"INTERVAL {ORDER_SHIFT_DAYS} DAYS"))
    return M.purchases_matched_within(purchases, moved, ORDER_WINDOW_SECONDS)


# Status updates that arrive in weekly batches; every 13th arrives a batch later than its time.
LATENESS_SECONDS = 2 * 86_400
_ARRIVALS_SQL = """SELECT user_id, ts, event_id, event_type AS status,
  CAST((day(ts) - 1) // 7 + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END AS INTEGER) AS arrival FROM events"""
LATE_SQL = f"""
WITH a AS ({_ARRIVALS_SQL}),
m AS (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark
      FROM a GROUP BY arrival)
SELECT a.*, coalesce(ts < mark - INTERVAL {LATENESS_SECONDS} SECOND, false) AS late FROM a JOIN m USING (arrival)
"""


def status_arrivals(events: DataFrame) -> DataFrame:
    """Status updates with the batch in which they arrive."""
    delay = F.when(F.col("event_id") % 13 == 0, 1).otherwise(0)
    arrival = (F.floor((F.dayofmonth("ts") - 1) / 7) + delay).cast("int")
    return events.select("user_id", "ts", "event_id", F.col("event_type").alias("status"), arrival.alias("arrival"))


@register("late_updates", sql=LATE_SQL)
def q_late_updates(spark, sf_dir):
    """Status updates that arrive more than two days behind the newest of all earlier batches."""
    events = read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type")
    return M.route_late(status_arrivals(events), "ts", "arrival", LATENESS_SECONDS)


@register("latest_status", sql="""
SELECT user_id, event_type AS status, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS rn FROM events) WHERE rn = 1
""")
def q_latest_status(spark, sf_dir):
    """The latest status per user by event time, whenever the update arrived."""
    events = read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type")
    return M.latest_status(status_arrivals(events), "user_id", "ts", "status")


# An order follows its purchase event within three days.
MATCH_SECONDS = 3 * 86_400


@register("purchases_one_to_one", sql=f"""
WITH RECURSIVE p AS (
  SELECT user_id, CAST(json_extract(props, '$.k') AS INTEGER) % 10 AS product, event_id, ts,
         row_number() OVER (PARTITION BY user_id, CAST(json_extract(props, '$.k') AS INTEGER) % 10 ORDER BY ts, event_id) - 1 AS r
  FROM events WHERE event_type = 'purchase'
), o AS (
  SELECT o_custkey // 10 AS user_id, CAST(o_orderkey % 10 AS INTEGER) AS product, o_orderkey AS order_id,
         TIMESTAMP '2024-01-01' + to_days(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INTEGER))
         + to_seconds(o_orderkey % 86400) AS order_ts
  FROM orders
), s AS (
  SELECT user_id, product, order_id, order_ts, row_number() OVER (PARTITION BY user_id, product ORDER BY order_ts, order_id) AS j FROM o
), g AS (
  SELECT s.user_id, s.product, s.j, s.order_id, s.order_ts,
         count(p.event_id) FILTER (p.ts < s.order_ts - INTERVAL {MATCH_SECONDS} SECOND) AS low,
         count(p.event_id) FILTER (p.ts <= s.order_ts) AS high
  FROM s LEFT JOIN p ON p.user_id = s.user_id AND p.product = s.product GROUP BY ALL
), w AS (
  SELECT user_id, product, CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS free, CAST(NULL AS BIGINT) AS r FROM (SELECT DISTINCT user_id, product FROM g)
  UNION ALL
  SELECT w.user_id, w.product, w.j + 1, CASE WHEN greatest(free, low) < high THEN greatest(free, low) + 1 ELSE greatest(free, low) END,
         CASE WHEN greatest(free, low) < high THEN greatest(free, low) END
  FROM w JOIN g ON g.user_id = w.user_id AND g.product = w.product AND g.j = w.j + 1
), m AS (
  SELECT g.user_id, g.product, g.order_id, g.order_ts, w.r FROM w JOIN g USING (user_id, product, j)
)
SELECT coalesce(p.user_id, m.user_id) AS user_id, coalesce(p.product, m.product) AS product, p.event_id, p.ts, m.order_id, m.order_ts,
  CASE WHEN p.event_id IS NULL THEN 'no_event' WHEN m.order_id IS NULL THEN 'no_order' ELSE 'matched' END AS status
FROM p FULL JOIN m ON p.user_id = m.user_id AND p.product = m.product AND p.r = m.r
""")
def q_purchases_one_to_one(spark, sf_dir):
    """B2 one to one: every purchase event and every order of a customer and
    product, paired within three days, each used once; what stays alone on
    either side is shown too. Orders get customers, products and times in
    the range of the events; no order is left out."""
    events = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type", "props").where(F.col("event_type") == "purchase")
    purchases = events.select("user_id", (D.product_id(events) % 10).alias("product"), "event_id", "ts")
    day = F.date_diff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")) % 30
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate").select(
        F.expr("o_custkey div 10").alias("user_id"), (F.col("o_orderkey") % 10).cast("int").alias("product"),
        F.col("o_orderkey").alias("order_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(day, F.lit(0), F.lit(0), F.col("o_orderkey") % 86_400)).alias("order_ts"))
    return M.match_one_to_one(purchases, orders, ("user_id", "product"), MATCH_SECONDS)


HEALTH_SHARES = (0.5, 0.95, 0.99)
RANK_ERROR = 0.03


@register("service_health_days", sql=f"""
SELECT service, date_trunc('day', log_ts)::TIMESTAMP AS window_start, CAST(count(*) AS BIGINT) AS requests,
  CAST(count(*) FILTER (WHERE status_code >= 500) AS BIGINT) AS errors_5xx,
  CAST(count(*) FILTER (WHERE status_code = 504) AS BIGINT) AS timeouts_504, true AS within_rank_error
FROM ({_LOGS_SQL}) GROUP BY ALL
""")
def q_service_health_days(spark, sf_dir):
    """B4 by sketches: hourly states merged to days. Beside the exact counts
    it says whether the three latencies lie within three per cent of their
    ranks among the day's lines, which are counted exactly."""
    logs = _parsed_logs(spark, sf_dir)
    days = M.merged_health(M.health_states(logs, F.col("log_ts")), "day", HEALTH_SHARES)
    days = days.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    lines = logs.select("service", F.date_trunc("day", "log_ts").cast("timestamp_ntz").alias("window_start"), "latency_ms")
    per = lines.groupBy("service", "window_start", "latency_ms").agg(F.count(F.lit(1)).alias("n")).join(days, ["service", "window_start"])
    sums = []
    for i, share in enumerate(HEALTH_SHARES):
        at = F.col("latency_at")[i]
        below, upto = (F.sum(F.when(c, F.col("n")).otherwise(0)) / F.sum("n") for c in (F.col("latency_ms") < at, F.col("latency_ms") <= at))
        sums.append((below <= share + RANK_ERROR) & (upto >= share - RANK_ERROR))
    return per.groupBy("service", "window_start", "requests", "errors_5xx", "timeouts_504").agg(
        reduce(lambda a, b: a & b, sums).alias("within_rank_error"))
