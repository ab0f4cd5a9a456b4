"""Stateful streams with bounded state (stream forms of B1, B3, B4, B7, B9,
B10, B11 and E5).

Windowed, session, dedup and join operators carry a watermark, so their
state is dropped once event time has moved past the bound; the streaming
reconciliation keeps no state, it appends counts that add up. Sinks that update earlier results are
``foreachBatch`` writers keyed by ``batch_id``: a batch replayed after a
failure overwrites its own output folder, so restarts are exactly-once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.functions.timecols import as_instant, epoch_micros, instant_as_ntz
from strata.operators import keyed as K

EVENT_TIME = "_event_time"


def _is_ntz(df: DataFrame, ts: str) -> bool:
    return isinstance(df.schema[ts].dataType, T.TimestampNTZType)


def with_event_time(df: DataFrame, ts: str, delay: str) -> tuple[DataFrame, str]:
    """Watermark on ``ts``; a ``timestamp_ntz`` column gets a ``timestamp``
    twin (watermarks need one), read as UTC whatever the session zone."""
    if _is_ntz(df, ts):
        return df.withColumn(EVENT_TIME, as_instant(df, ts)).withWatermark(EVENT_TIME, delay), EVENT_TIME
    return df.withWatermark(ts, delay), ts


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """B1 (stream): drop repeats of a key seen within the watermark delay."""
    marked, et = with_event_time(df, ts, delay)
    out = marked.dropDuplicatesWithinWatermark(list(keys))
    return out.drop(EVENT_TIME) if et == EVENT_TIME else out


def windowed_counts(df: DataFrame, ts: str, delay: str, window: str, slide: str | None,
                    group: Sequence[Column], aggs: Sequence[Column]) -> DataFrame:
    """B3/B4 (stream): windowed aggregate with a watermark on ``ts``; window
    bounds come back in ``ts``'s own type."""
    marked, et = with_event_time(df, ts, delay)
    w = F.window(et, window, slide) if slide else F.window(et, window)
    if _is_ntz(df, ts):
        start = instant_as_ntz(df.sparkSession, F.col("w.start"))
        end = instant_as_ntz(df.sparkSession, F.col("w.end"))
    else:
        start, end = F.col("w.start"), F.col("w.end")
    return (marked.groupBy(w.alias("w"), *group).agg(*aggs)
            .select(start.alias("window_start"), end.alias("window_end"), "*")
            .drop("w"))


def sessions_stream(df: DataFrame, keys: Sequence[str], ts: str, gap: str, delay: str,
                    aggs: Sequence[Column] = ()) -> DataFrame:
    """B9 (stream): sessions per key with Spark's ``session_window`` under a
    watermark, for append mode: a session is emitted once the watermark
    passes its end (last event + ``gap``), and its state is dropped then.
    Columns: keys, ``session_start``, ``session_end`` (last event), ``events``
    and ``aggs``. A gap of exactly ``gap`` starts a new session (the window
    end is exclusive)."""
    marked, et = with_event_time(df, ts, delay)
    return (marked.groupBy(*keys, F.session_window(et, gap).alias("_s"))
            .agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"),
                 F.count(F.lit(1)).alias("events"), *aggs)
            .drop("_s"))


def _batch_dir(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def upsert_log(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
               output_mode: str = "update") -> StreamingQuery:
    """Write each micro-batch's updated rows to ``<path>/batch_id=<n>``.

    Replaying a batch overwrites its folder, so the log is idempotent; read
    the current state with :func:`read_upsert_log`.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_dir(path, batch_id))

    return (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start())


def read_upsert_log(spark, path: str, keys: Sequence[str], snapshot: str | None = None) -> DataFrame:
    """The latest version of every key in an upsert log (partially aggregated).

    With ``snapshot`` (written by :func:`compact_upsert_log`), only the log's
    batches after the snapshot are read on top of it, so the read cost stays
    bounded as the log grows.
    """
    log = spark.read.parquet(path)
    if snapshot:
        snap = spark.read.parquet(snapshot)
        upto = snap.agg(F.max("batch_id")).first()[0]
        if upto is not None:
            log = snap.unionByName(log.where(F.col("batch_id") > F.lit(upto)))
    return K.latest_per_key(log, list(keys), ["batch_id"]).drop("batch_id")


def compact_upsert_log(spark, path: str, keys: Sequence[str], snapshot_out: str,
                       snapshot: str | None = None) -> str:
    """Write the log's current state (with the batch each row came from) to
    ``snapshot_out``: later reads merge only newer batches onto it."""
    log = spark.read.parquet(path)
    if snapshot:
        snap = spark.read.parquet(snapshot)
        upto = snap.agg(F.max("batch_id")).first()[0]
        if upto is not None:
            log = snap.unionByName(log.where(F.col("batch_id") > F.lit(upto)))
    K.latest_per_key(log, list(keys), ["batch_id"]).write.mode("overwrite").parquet(snapshot_out)
    return snapshot_out


def late_router(df: DataFrame, ts: str, lateness_seconds: int, on_time_path: str, late_path: str,
                marks_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """B7 (stream): route updates older than ``lateness_seconds`` behind the
    high-water mark of earlier batches to a late table.

    The high-water mark (max event time of all earlier batches) is kept as a
    one-row file per batch next to the outputs; every output of batch ``n``
    goes to ``batch_id=n`` folders, so a replayed batch rewrites the same
    result. Only batch ``n - 1``'s mark is read by batch ``n``.
    """
    def route(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The previous batch's mark already folds in every earlier one, so
        # only its one-row file is read (no scan over all past batches). Only
        # the first batch of a checkpoint has none; anything else that keeps
        # the mark from being read is an error and stops the stream.
        mark = None if batch_id == 0 else spark.read.parquet(_batch_dir(marks_path, batch_id - 1)).first()["hw"]
        staged = batch.persist()
        try:
            t_us = epoch_micros(staged, ts)
            late_cond = F.lit(False) if mark is None else t_us < F.lit(mark) - F.lit(lateness_seconds * 1_000_000)
            late = F.coalesce(late_cond, F.lit(False))
            staged.where(~late).write.mode("overwrite").parquet(_batch_dir(on_time_path, batch_id))
            staged.where(late).write.mode("overwrite").parquet(_batch_dir(late_path, batch_id))
            hw = staged.agg(F.max(t_us).alias("hw")).first()["hw"]
        finally:
            staged.unpersist()
        hw = max((x for x in (hw, mark) if x is not None), default=None)
        spark.createDataFrame([(hw,)], "hw bigint").write.mode("overwrite").parquet(
            _batch_dir(marks_path, batch_id))

    return (df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(route)
            .trigger(**(trigger or {"availableNow": True})).start())


# Salts that the left rows of a time bucket are dealt over.
INTERVAL_SALTS = 8


def interval_semi_join_stream(left: DataFrame, left_ts: str, right: DataFrame, right_ts: str, seconds: int,
                              left_delay: str, right_delay: str, bucket_seconds: int | None = None,
                              salts: int = INTERVAL_SALTS) -> DataFrame:
    """B10 (stream): the left rows with at least one right row within
    ``seconds`` (stream-stream left semi join); each left row is emitted at
    most once, so the output is linear in the left stream.

    Only whether a match exists matters, so the right stream is reduced to its
    distinct times first. These few rows are copied to the neighbouring time
    buckets and to every salt; the left rows of a bucket are dealt over the
    salts. Both sides carry a watermark on a ``timestamp`` copy of their event
    time (``timestamp_ntz`` is read as UTC), and the range condition lets
    Spark drop join state once both watermarks pass it.
    """
    width = bucket_seconds or max(seconds, 1)
    span = -(-seconds // width)  # neighbour buckets a match can fall in
    lw = left.withColumn("_lt", as_instant(left, left_ts)).withWatermark("_lt", left_delay)
    lw = (lw.withColumn("_lb", F.floor(F.unix_seconds("_lt") / width).cast("bigint"))
          .withColumn("_ls", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")))
    times = (right.select(as_instant(right, right_ts).alias("_rt")).withWatermark("_rt", right_delay)
             .dropDuplicatesWithinWatermark(["_rt"]))
    rb = F.floor(F.unix_seconds("_rt") / width).cast("bigint")
    rw = times.select("_rt", F.explode(F.sequence(rb - F.lit(span), rb + F.lit(span))).alias("_rb"))
    rw = rw.select("_rt", "_rb", F.explode(F.array(*[F.lit(i) for i in range(salts)])).alias("_rs"))
    bound = F.expr(f"INTERVAL {seconds} SECONDS")
    cond = ((F.col("_lb") == F.col("_rb")) & (F.col("_ls") == F.col("_rs"))
            & (F.col("_rt") >= F.col("_lt") - bound) & (F.col("_rt") <= F.col("_lt") + bound))
    return lw.join(rw, cond, "left_semi").drop("_lb", "_ls", "_lt")


def reconcile_rows(orders: DataFrame, shipments: DataFrame, order_key: str, shipment_key: str,
                   zero_is_missing: bool = True) -> DataFrame:
    """E5 (stream): one row per order and per shipment with a present key, tagged for counting."""
    from strata.functions.keys import comparable_key, truthy_key
    o = orders.select(comparable_key(orders, order_key, shipments, shipment_key, zero_is_missing).alias("order_id"),
                      F.lit(1).alias("_o"), F.lit(0).alias("_s"))
    s = shipments.select(comparable_key(shipments, shipment_key, orders, order_key, zero_is_missing).alias("order_id"),
                         F.lit(0).alias("_o"), F.lit(1).alias("_s"))
    return o.unionByName(s.where(truthy_key(s, "order_id", zero_is_missing)))


def reconcile_outer_stream(orders: DataFrame, order_key: str, order_ts: str, shipments: DataFrame, shipment_key: str,
                           shipment_ts: str, within_seconds: int, delay: str, zero_is_missing: bool = True) -> DataFrame:
    """J2, B12 (stream): every order with its shipments, and whatever stays alone on either side.

    A stream-stream full outer join: a pair is emitted at once (``matched``);
    an order that no shipment names from its time on until ``within_seconds``
    later is emitted as ``missing_shipment``, and a shipment without such an
    order as ``orphan_shipment``, once the watermark has passed the bound.
    Their state leaves with them, so it holds the rows of the bound alone.
    Keys that do not count as present are left out, as in the batch form.
    """
    from strata.functions.keys import comparable_key, truthy_key
    o = orders.select(comparable_key(orders, order_key, shipments, shipment_key, zero_is_missing).alias("_ok"),
                      as_instant(orders, order_ts).alias("_ot")).withWatermark("_ot", delay)
    s = shipments.select(comparable_key(shipments, shipment_key, orders, order_key, zero_is_missing).alias("_sk"),
                         as_instant(shipments, shipment_ts).alias("_st")).withWatermark("_st", delay)
    o, s = o.where(truthy_key(o, "_ok", zero_is_missing)), s.where(truthy_key(s, "_sk", zero_is_missing))
    bound = F.expr(f"INTERVAL {within_seconds} SECONDS")
    pair = (F.col("_ok") == F.col("_sk")) & (F.col("_st") >= F.col("_ot")) & (F.col("_st") <= F.col("_ot") + bound)
    status = (F.when(F.col("_sk").isNull(), "missing_shipment").when(F.col("_ok").isNull(), "orphan_shipment").otherwise("matched"))
    return o.join(s, pair, "full_outer").select(F.coalesce("_ok", "_sk").alias("order_id"), status.alias("status"))


def count_log(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """E5 (stream): append each micro-batch's counts per key to ``<path>/batch_id=<n>``.

    Counts add up, so the stream keeps no state at all; the report sums the
    log when it is read. A replayed batch overwrites its own folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("order_id").agg(F.sum("_o").cast("bigint").alias("n_orders"),
                                               F.sum("_s").cast("bigint").alias("n_shipments"))
        counts.write.mode("overwrite").parquet(_batch_dir(path, batch_id))

    return (rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
            .trigger(**(trigger or {"availableNow": True})).start())


def reconcile_report_from_log(spark, path: str, zero_is_missing: bool = True) -> DataFrame:
    """The reconciliation report of all counts that :func:`count_log` wrote."""
    from strata.functions.keys import truthy_key
    from strata.operators.reconcile import report_from_counts
    state = spark.read.parquet(path).groupBy("order_id").agg(
        F.sum("n_orders").alias("n_orders"), F.sum("n_shipments").alias("n_shipments"))
    counts = state.select("order_id",
                          F.when(F.col("n_orders") > 0, F.col("n_orders")).alias("n_orders"),
                          F.when(F.col("n_shipments") > 0, F.col("n_shipments")).alias("n_shipments"))
    counts = counts.withColumn("present", truthy_key(counts, "order_id", zero_is_missing)
                               & F.col("n_orders").isNotNull())
    return report_from_counts(counts)
