"""Streaming twins: the same operators fed through file streams.

Each query runs a Structured Streaming job with ``availableNow`` over the
table's file, writes to a fresh folder under the shared checkpoint location
and returns what it wrote (stateful ones: the latest state of their upsert
log). The oracle is the batch query's, except for the semi interval join,
whose stream form has its own SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import parse as P
from strata.operators import history as H
from strata.operators import marts as M
from strata.plans import derive as D
from strata.plans.mart_queries import (
    _LOGS_SQL,
    FAILURE_WINDOW_SECONDS,
    LATE_SQL,
    LATENESS_SECONDS,
    PERCENTILE_COLUMNS,
    SESSION_GAP_SECONDS,
    round_columns,
    status_arrivals,
)
from strata.plans.reconcile_queries import STRAY_SQL
from strata.plans.registry import ORACLE_SQL, register
from strata.schemas import CLICKSTREAM_SCHEMA
from strata.session import scratch_path
from strata.sources.tables import read_table, stream_table
from strata.streaming import bronze as B
from strata.streaming import runner
from strata.streaming import stateful as ST

WATERMARK = "1 hour"


@register("stream_json_parse", sql=ORACLE_SQL["json_parse"])
def q_stream_json_parse(spark, sf_dir):
    """P1-P2, K1 on a file stream of events, appended to parquet."""
    raw = D.clickstream_json(stream_table(spark, sf_dir, "events")).withColumnRenamed("event_id", "src_id")
    base = scratch_path(spark, "stream_json_parse")
    B.append_stream(P.parse_json_columns(raw, CLICKSTREAM_SCHEMA, keep=("src_id",)), f"{base}/checkpoint",
                    path=f"{base}/data", trigger={"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{base}/data")


@register("stream_log_parse", sql=ORACLE_SQL["log_parse"])
def q_stream_log_parse(spark, sf_dir):
    """P4-P6 on a file stream of log lines, appended to parquet."""
    raw = D.server_log_lines(stream_table(spark, sf_dir, "events")).withColumnRenamed("event_id", "src_id")
    return runner.run_available(P.parse_log_lines(raw, keep=("src_id",)), spark, "stream_log_parse")


@register("stream_dedup_events", sql=ORACLE_SQL["dedup_events"])
def q_stream_dedup_events(spark, sf_dir):
    """B1 (stream): every 5th event delivered twice; duplicates dropped within
    the watermark."""
    first = stream_table(spark, sf_dir, "events")
    again = stream_table(spark, sf_dir, "events").where(F.col("event_id") % 5 == 0)
    deduped = ST.dedup_stream(first.unionByName(again), ["event_id"], "ts", WATERMARK)
    return runner.run_available(deduped, spark, "stream_dedup_events")


@register("stream_product_activity_window", sql=ORACLE_SQL["product_activity_window"])
def q_stream_product_activity_window(spark, sf_dir):
    """B3 (stream): sliding-window counts with a watermark.

    The stream keeps one state row per (slide, product, user), spread by
    hash and dropped once the watermark passes the slide, and writes its
    updates to an idempotent upsert log; windows, distinct users and the
    top 3 per window are aggregated when the log's state is read. No set of
    users is ever collected into one state row.
    """
    events = stream_table(spark, sf_dir, "events").withColumn(
        "product_id", F.get_json_object("props", "$.k").cast("int"))
    per_user = ST.windowed_counts(
        events, "ts", WATERMARK, "1 minute", None, [F.col("product_id"), F.col("user_id")],
        [F.count(F.lit(1)).alias("interactions"),
         F.count(F.when(F.col("event_type") == "purchase", True)).alias("purchases")])
    base = scratch_path(spark, "stream_product_activity_window")
    ST.upsert_log(per_user, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    state = ST.read_upsert_log(spark, f"{base}/log", ["window_start", "window_end", "product_id", "user_id"])
    slides = state.select("product_id", F.pmod(F.hash("user_id"), F.lit(16)).alias("_user_salt"), "user_id",
                          F.col("window_start").alias("slide_start"), "interactions", "purchases")
    return M.activity_windows(M.dealt(slides, "product_id", "_user_salt"), "5 minutes", "1 minute", 3)


@register("stream_service_health", sql=ORACLE_SQL["service_health"])
def q_stream_service_health(spark, sf_dir):
    """B4 (stream): hourly service health from a log-line stream, watermarked,
    written as an idempotent upsert log and read back as its latest state."""
    events = stream_table(spark, sf_dir, "events")
    logs = P.parse_log_lines(D.server_log_lines(events), keep=("event_id",))
    logs = logs.withColumn("log_ts", P.to_utc_wall_clock(spark, P.parse_time(F.col("timestamp"))))
    status = F.col("status_code")
    counts = ST.windowed_counts(
        logs, "log_ts", WATERMARK, "1 hour", None, [F.col("service")],
        [F.count(F.lit(1)).alias("requests"),
         F.count(F.when(status >= 500, True)).alias("errors_5xx"),
         F.count(F.when(status == 504, True)).alias("timeouts_504"),
         M.percentiles("latency_ms", 0.5, 0.95, 0.99).alias("_p")])
    base = scratch_path(spark, "stream_service_health")
    ST.upsert_log(counts, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    state = ST.read_upsert_log(spark, f"{base}/log", ["service", "window_start"])
    out = state.select("service", "window_start", "requests", "errors_5xx",
                       (F.col("errors_5xx") / F.col("requests")).alias("error_share"), "timeouts_504",
                       F.col("_p")[0].alias("p50_latency_ms"), F.col("_p")[1].alias("p95_latency_ms"),
                       F.col("_p")[2].alias("p99_latency_ms"))
    return round_columns(out, PERCENTILE_COLUMNS)


@register("stream_current_state", sql=ORACLE_SQL["current_state"])
def q_stream_current_state(spark, sf_dir):
    """B11 (stream): the latest event per user kept as streaming aggregate
    state (one row per key: the state is the current-state table itself),
    emitted in update mode to an idempotent upsert log."""
    events = runner.Arrivals(spark, "stream_current_state", read_table(
        spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type", "value"), F.col("event_id") % 3, 3)
    base = scratch_path(spark, "stream_current_state")

    def start(changes):
        latest = changes.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type", "value")).alias("r"))
        return ST.upsert_log(latest, f"{base}/log", f"{base}/checkpoint")

    runner.run_in_arrivals([events], start)
    state = ST.read_upsert_log(spark, f"{base}/log", ["user_id"])
    return state.select("user_id", "r.ts", "r.event_id", "r.event_type", "r.value")


@register("stream_purchases_near_failures", sql=f"""
WITH p AS (SELECT event_id, ts FROM events WHERE event_type = 'purchase'),
f AS (SELECT log_ts FROM ({_LOGS_SQL}) WHERE path = '/checkout' AND status_code >= 500)
SELECT p.event_id, p.ts FROM p
WHERE EXISTS (SELECT 1 FROM f WHERE f.log_ts BETWEEN p.ts - INTERVAL {FAILURE_WINDOW_SECONDS} SECOND
                                                AND p.ts + INTERVAL {FAILURE_WINDOW_SECONDS} SECOND)
""")
def q_stream_purchases_near_failures(spark, sf_dir):
    """B10 (stream): purchases with a failing checkout request within 15
    minutes, as a stream-stream left semi interval join (watermarks on both
    sides bound the state; each purchase is emitted at most once)."""
    purchases = stream_table(spark, sf_dir, "events").where(F.col("event_type") == "purchase") \
        .select("event_id", "ts")
    logs = P.parse_log_lines(D.server_log_lines(stream_table(spark, sf_dir, "events")), keep=("event_id",))
    failures = logs.where((F.col("path") == "/checkout") & (F.col("status_code") >= 500)).select(
        P.to_utc_wall_clock(spark, P.parse_time(F.col("timestamp"))).alias("log_ts"))
    near = ST.interval_semi_join_stream(purchases, "ts", failures, "log_ts", FAILURE_WINDOW_SECONDS,
                                        WATERMARK, WATERMARK)
    return runner.run_available(near.select("event_id", "ts"), spark, "stream_purchases_near_failures")


@register("stream_reconcile_report", sql=ORACLE_SQL["reconcile_report"])
def q_stream_reconcile_report(spark, sf_dir):
    """E5 (stream): the flagship report kept up to date incrementally: the
    counts of every micro-batch of orders and line items are appended to a
    log; the report sums it. Orders and line items arrive in three batches."""
    orders = runner.Arrivals(spark, "stream_reconcile_orders", read_table(spark, sf_dir, "orders", "o_orderkey"),
                             F.pmod(F.col("o_orderkey"), F.lit(3)), 3)
    lines = runner.Arrivals(spark, "stream_reconcile_lines", read_table(
        spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber"), F.col("l_linenumber") % 3, 3)
    base = scratch_path(spark, "stream_reconcile_report")
    runner.run_in_arrivals([orders, lines], lambda o, s: ST.count_log(
        ST.reconcile_rows(o, s, "o_orderkey", "l_orderkey"), f"{base}/log", f"{base}/checkpoint"))
    return ST.reconcile_report_from_log(spark, f"{base}/log")


@register("stream_validate_errors", sql=ORACLE_SQL["validate_errors"])
def q_stream_validate_errors(spark, sf_dir):
    """V2-V7 / D10 (stream): contract check inside a bronze stream; rejected
    records land per micro-batch in a quarantine table, read back here."""
    raw = D.contract_records(stream_table(spark, sf_dir, "events")).withColumnRenamed("event_id", "src_id")
    base = scratch_path(spark, "stream_validate_errors")
    q = B.validated_append(raw, "clickstream_events", f"{base}/valid", f"{base}/quarantine", f"{base}/checkpoint",
                           schema=CLICKSTREAM_SCHEMA, trigger={"availableNow": True}, keep=("src_id",))
    q.awaitTermination()
    bad = spark.read.parquet(f"{base}/quarantine")
    return bad.select("src_id", "error", F.size("errors").alias("n_errors"))



@register("stream_late_updates", sql=LATE_SQL)
def q_stream_late_updates(spark, sf_dir):
    """B7 (stream): every arrival is a micro-batch; updates more than two days
    behind the newest of all earlier batches go to the late table."""
    updates = status_arrivals(read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type"))
    batches = updates.agg(F.max("arrival")).first()[0]
    arrivals = runner.Arrivals(spark, "stream_late_updates", updates, F.col("arrival"), (batches or 0) + 1)
    base = scratch_path(spark, "stream_late_updates")
    runner.run_in_arrivals([arrivals], lambda stream: ST.late_router(
        stream, "ts", LATENESS_SECONDS, f"{base}/on_time", f"{base}/late", f"{base}/marks", f"{base}/checkpoint"))
    on_time = spark.read.parquet(f"{base}/on_time").drop("batch_id").withColumn("late", F.lit(False))
    return on_time.unionByName(spark.read.parquet(f"{base}/late").drop("batch_id").withColumn("late", F.lit(True)))


@register("stream_sessions", sql=f"""
WITH f AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) >= {SESSION_GAP_SECONDS}000000
                 THEN 1 ELSE 0 END AS starts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM f)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, CAST(count(*) AS BIGINT) AS events,
       CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases
FROM s GROUP BY user_id, n
""")
def q_stream_sessions(spark, sf_dir):
    """B9 (stream): sessions in append mode over three arrivals in event-time
    order. A closing event far ahead moves the watermark past the last
    session; its own session, of no user, is never closed."""
    events = read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type")
    closing = events.limit(1).select(F.lit(None).cast("bigint").alias("user_id"),
                                     F.lit("2100-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
                                     F.lit(None).cast("bigint").alias("event_id"), F.lit("close").alias("event_type"))
    third = F.floor((F.dayofmonth("ts") - 1) / 11)
    batch = F.when(F.col("event_type") == "close", 3).otherwise(F.least(third, F.lit(2)))
    arrivals = runner.Arrivals(spark, "stream_sessions", events.unionByName(closing), batch, 4)
    base = scratch_path(spark, "stream_sessions")

    def start(stream):
        purchases = F.count(F.when(F.col("event_type") == "purchase", True)).alias("purchases")
        sessions = ST.sessions_stream(stream, ["user_id"], "ts", f"{SESSION_GAP_SECONDS} seconds", WATERMARK, [purchases])
        return B.append_stream(sessions, f"{base}/checkpoint", path=f"{base}/data", trigger={"availableNow": True})

    runner.run_in_arrivals([arrivals], start)
    return spark.read.parquet(f"{base}/data").where(F.col("user_id").isNotNull())


# Orders are placed a second apart, and their lines ship so many hours later.
SHIP_WITHIN_SECONDS = 8 * 3_600


@register("stream_outer_reconcile", sql=f"""
WITH s AS (SELECT k, count(*) AS n FROM ({STRAY_SQL}) WHERE k <> 0 GROUP BY k),
o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey <> 0)
SELECT coalesce(o.k, s.k) AS order_id,
  CASE WHEN s.k IS NULL THEN 'missing_shipment' WHEN o.k IS NULL THEN 'orphan_shipment' ELSE 'matched' END AS status,
  CAST(coalesce(n, 0) AS BIGINT) AS shipment_rows
FROM o FULL JOIN s ON o.k = s.k
""")
def q_stream_outer_reconcile(spark, sf_dir):
    """J2, B12 (stream): orders and shipments arrive in four batches of time;
    missing and orphan rows leave the join's state when the watermark passes
    them. The last batch holds one row a side far in the future, which
    closes the day for all others."""
    start = F.lit("2024-01-01").cast("timestamp")
    end = F.lit("2200-01-01").cast("timestamp")

    def closing(key):
        return spark.range(1).select(F.lit(key).cast("bigint").alias("key"), end.alias("ts"), F.lit(3).cast("bigint").alias("arrival"))

    arrival = F.least(F.lit(2), F.expr("abs(key) div 5000"))
    orders = read_table(spark, sf_dir, "orders", "o_orderkey").select(F.col("o_orderkey").alias("key"))
    orders = orders.select("key", (start + F.make_dt_interval(secs=F.col("key"))).alias("ts"), arrival.alias("arrival"))
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    lines = D.stray_shipments(lines).select(F.col("l_orderkey").alias("key"), "l_linenumber")
    lines = lines.select("key", (start + F.make_dt_interval(hours=F.col("l_linenumber"), secs=F.abs("key"))).alias("ts"), arrival.alias("arrival"))
    sides = [runner.Arrivals(spark, f"stream_outer_{name}", rows.unionByName(closing(key)), F.col("arrival"), 4)
             for name, rows, key in (("orders", orders, -1), ("lines", lines, -2))]
    base = scratch_path(spark, "stream_outer_reconcile")

    def begin(o, s):
        joined = ST.reconcile_outer_stream(o, "key", "ts", s, "key", "ts", SHIP_WITHIN_SECONDS, WATERMARK)
        return (joined.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
                .trigger(availableNow=True).start(f"{base}/data"))

    runner.run_in_arrivals(sides, begin)
    return spark.read.parquet(f"{base}/data").groupBy("order_id", "status").agg(
        F.sum(F.when(F.col("status") != "missing_shipment", 1).otherwise(0)).alias("shipment_rows"))


@register("scd2_incremental", sql=ORACLE_SQL["scd2_history"])
def q_scd2_incremental(spark, sf_dir):
    """B8, incremental: events arrive in three batches that interleave in time,
    so two thirds of the changes are late and split intervals that are there."""
    changes = runner.Arrivals(spark, "scd2_incremental", read_table(
        spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type", "value"), F.col("event_id") % 3, 3)
    base = scratch_path(spark, "scd2_incremental")
    runner.run_in_arrivals([changes], lambda stream: H.history_stream(
        stream, f"{base}/history", f"{base}/checkpoint", ["user_id"], "ts", ["event_id"]))
    return H.read_history(spark, f"{base}/history")


@register("stream_activity_sketches", sql=f"""
WITH w AS (
  SELECT date_trunc('minute', ts) - INTERVAL (k) MINUTE AS window_start, CAST(json_extract(props, '$.k') AS INTEGER) AS product_id
  FROM events, range(0, 5) r(k)),
c AS (SELECT window_start, product_id, count(*) AS n FROM w GROUP BY ALL)
SELECT window_start, CAST(sum(n) AS BIGINT) AS events, CAST(least(3, count(*)) AS BIGINT) AS products, true AS within_error
FROM c GROUP BY window_start
""")
def q_stream_activity_sketches(spark, sf_dir):
    """B3 (stream) by sketches: one state row per slide, whatever the number of
    products and users. Per window: its events, how many top products there
    are, and whether their estimates are within the sketch's error bound of
    the exact counts and no product left out has more than that above them."""
    events = stream_table(spark, sf_dir, "events")
    events = events.select("ts", D.product_id(events).alias("product_id"))
    base = scratch_path(spark, "stream_activity_sketches")
    slides = ST.windowed_counts(events, "ts", WATERMARK, "1 minute", None, [],
                                [F.count(F.lit(1)).alias("events"), M.slide_sketch("product_id").alias("sketch")])
    ST.upsert_log(slides, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    state = ST.read_upsert_log(spark, f"{base}/log", ["window_start"])
    top = M.activity_from_sketches(state.withColumnRenamed("window_start", "slide_start"), "5 minutes", "1 minute", 3)
    table = read_table(spark, sf_dir, "events", "ts", "props")
    starts = F.array(*[F.date_trunc("minute", "ts").cast("timestamp_ntz") - F.expr(f"INTERVAL {k} MINUTES") for k in range(5)])
    exact = (table.select(F.explode(starts).alias("window_start"), D.product_id(table).alias("product_id"))
             .groupBy("window_start", "product_id").agg(F.count(F.lit(1)).alias("n")))
    both = exact.join(top, ["window_start", "product_id"], "left")
    bound = M.SKETCH_ERROR / M.SKETCH_ITEMS * F.sum("n")
    shown = F.col("interactions").isNotNull()
    return both.groupBy("window_start").agg(
        F.max("events").alias("events"), F.count("interactions").alias("products"),
        ((F.coalesce(F.max(F.when(shown, F.abs(F.col("interactions") - F.col("n")))), F.lit(0)) <= bound)
         & (F.coalesce(F.max(F.when(~shown, F.col("n"))), F.lit(0)) <= F.min("interactions") + bound)).alias("within_error"))
