"""Business marts (B2-B6, B7 batch, B9, B10).

All marts are aggregates over the parsed bronze/silver tables. Percentiles
are exact (``percentile``): Spark keeps a value -> count map per group and
merges it map-side, so the state grows with the number of *distinct*
values (latency in ms, days), not with the number of rows. Time-bounded
matching (B2 with a bound, B10) never materialises pairs of rows: it counts
with sorted running sums (``count(x <= t + N) - count(x < t - N)``), which
is exact and stays linear however many rows share a key or a second.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import sequence as S
from strata.functions.timecols import epoch_micros

# --- B3: product activity in sliding windows --------------------------------


def product_activity(events: DataFrame, ts: str, product: str, window: str = "5 minutes",
                     slide: str = "1 minute", top_k: int | None = 3) -> DataFrame:
    """Interactions per product in sliding windows, top ``top_k`` per window.

    Events are shuffled once, on (product, user salt), and counted per slide,
    product and user there; only these counts are expanded into windows (see
    :func:`activity_windows`). The salt keeps a hot product off a single task,
    and :func:`dealt` keeps a task's share small.
    """
    rows = events.select(F.window(ts, slide)["start"].alias("slide_start"), F.col(product).alias("product_id"),
                         "user_id", F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("p"),
                         _salt("user_id").alias("_user_salt"))
    slides = (dealt(rows, "product_id", "_user_salt")
              .groupBy("product_id", "_user_salt", "user_id", "slide_start")
              .agg(F.count(F.lit(1)).alias("interactions"), F.sum("p").alias("purchases")))
    return activity_windows(slides, window, slide, top_k)


_SALTS = 16


def _salt(column: str) -> Column:
    return F.pmod(F.hash(column), F.lit(_SALTS))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over the session's shuffle partitions, all of them.

    Adaptive execution merges partitions by their compressed bytes, but here a
    row becomes one state row per window, many times its size in memory: the
    share of a task is set by the number of partitions instead.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _seconds(interval: str) -> int:
    number, unit = interval.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}[unit.rstrip("s")]


def activity_windows(slides: DataFrame, window: str, slide: str, top_k: int | None) -> DataFrame:
    """B3 from counts per (product, ``_user_salt``, user, ``slide_start``), :func:`dealt` by the first two.

    A window is a whole number of slides, so each count goes to the windows
    that hold its slide. Distinct users are counted per (product, salt,
    window) where the rows are; one row for each of these meets the others of
    its window, dealt by (window, product salt), which is also how
    :func:`top_per_window` ranks first.
    """
    step, span = _seconds(slide), _seconds(window)
    if span % step:
        raise ValueError("a window must be a whole number of slides")
    starts = F.array(*[F.col("slide_start") - F.expr(f"INTERVAL {k * step} SECONDS") for k in range(span // step)])
    expanded = slides.select("product_id", "_user_salt", "user_id", F.explode(starts).alias("window_start"),
                             "interactions", "purchases")
    sums = [F.sum("interactions").alias("interactions"), F.sum("purchases").alias("purchases")]
    parts = (expanded.groupBy("product_id", "_user_salt", "user_id", "window_start").agg(*sums)
             .groupBy("product_id", "_user_salt", "window_start").agg(*sums, F.count("user_id").alias("users")))
    out = (dealt(parts.withColumn("_salt", _salt("product_id")), "window_start", "_salt")
           .groupBy("window_start", "_salt", "product_id").agg(*sums, F.sum("users").alias("users"))
           .withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {span} SECONDS")))
    columns = ["window_start", "window_end", "product_id", "interactions", "purchases", "users"]
    return out.select(*columns) if top_k is None else top_per_window(out.select(*columns, "_salt"), top_k)


def top_per_window(counts: DataFrame, top_k: int, salt_buckets: int = _SALTS) -> DataFrame:
    """The ``top_k`` products per window by interactions (ties: lower id).

    Two stages, so one very busy window is not ranked on one task: first the
    top ``top_k`` inside ``(window, hash(product) % salt_buckets)`` (``_salt``,
    if ``counts`` has it), then the final top ``top_k`` per window over at most
    ``salt_buckets * top_k`` candidates. Exact: a window's top ``top_k`` are each within the top
    ``top_k`` of their own bucket. The limit is the report's feature.
    """
    order = [F.col("interactions").desc(), F.col("product_id").asc()]
    salted = counts if "_salt" in counts.columns else counts.withColumn(
        "_salt", F.pmod(F.hash("product_id"), F.lit(salt_buckets)))
    first = salted.withColumn("_r", F.row_number().over(
        Window.partitionBy("window_start", "_salt").orderBy(*order))).where(F.col("_r") <= top_k)
    rank = F.row_number().over(Window.partitionBy("window_start").orderBy(*order))
    return (first.withColumn("rank", rank).where(F.col("rank") <= top_k)
            .select("window_start", "window_end", "product_id", "interactions", "purchases", "users", "rank"))


# A frequent-items sketch keeps so many products. Its counts are off by at most 3.5 / SKETCH_ITEMS of a window's events
# (the sketch's documented bound), and exact while there are fewer than three quarters as many products.
SKETCH_ITEMS = 256
SKETCH_ERROR = 3.5


def slide_sketch(product: str, items: int = SKETCH_ITEMS) -> Column:
    """B3 state: the frequent products of a group as one mergeable sketch, whatever the number of products and users."""
    return F.expr(f"approx_top_k_accumulate(`{product}`, {items})")


def activity_from_sketches(slides: DataFrame, window: str, slide: str, top_k: int, items: int = SKETCH_ITEMS) -> DataFrame:
    """B3 from one row per slide (``slide_start``, ``events``, ``sketch``): ``window_start``, ``events``, ``product_id``,
    ``interactions`` (estimated) and ``rank``. Ties rank by product. A window merges the sketches of its slides."""
    step, span = _seconds(slide), _seconds(window)
    if span % step:
        raise ValueError("a window must be a whole number of slides")
    starts = F.array(*[F.col("slide_start") - F.expr(f"INTERVAL {k * step} SECONDS") for k in range(span // step)])
    merged = (slides.select(F.explode(starts).alias("window_start"), "events", "sketch").groupBy("window_start")
              .agg(F.sum("events").alias("events"), F.expr(f"approx_top_k_combine(sketch, {items})").alias("sketch")))
    # A sketch gives equal counts in no order of its own, so all it holds are ranked here: at most ``items``.
    held = F.expr(f"approx_top_k_estimate(sketch, {items})")
    ranked = F.slice(F.array_sort(F.transform(held, lambda x: F.struct(
        (-x["count"]).alias("c"), x["item"].alias("product_id"), x["count"].alias("interactions")))), 1, top_k)
    return merged.select("window_start", "events", F.posexplode(ranked).alias("at", "top")).select(
        "window_start", "events", "top.product_id", "top.interactions", (F.col("at") + 1).alias("rank"))


# --- B4: service health -------------------------------------------------------

# Accuracy of a quantile sketch: its rank error is below 1 % for k = 400, with 99 % confidence.
SKETCH_K = 400


def health_states(logs: DataFrame, ts: Column, window: str = "1 hour", k: int = SKETCH_K) -> DataFrame:
    """B4 as states that merge: counts and a quantile sketch of the latencies per service and window.

    The exact form keeps every distinct latency of a group in its state; a
    sketch has a bounded size, and states of hours merge into those of days,
    so wide reports never go back to the lines. Works on streams too.
    """
    status = F.col("status_code")
    return (logs.groupBy("service", F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"), F.count(F.when(status >= 500, True)).alias("errors_5xx"),
                 F.count(F.when(status == 504, True)).alias("timeouts_504"),
                 F.kll_sketch_agg_bigint(F.col("latency_ms").cast("bigint"), k).alias("latencies"))
            .select("service", F.col("w.start").alias("window_start"), "requests", "errors_5xx", "timeouts_504", "latencies"))


def merged_health(states: DataFrame, unit: str = "day", shares: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """:func:`health_states` merged to a coarser ``unit``, with estimated latencies at ``shares`` (array ``latency_at``)."""
    merged = (states.groupBy("service", F.date_trunc(unit, "window_start").alias("window_start"))
              .agg(F.sum("requests").alias("requests"), F.sum("errors_5xx").alias("errors_5xx"), F.sum("timeouts_504").alias("timeouts_504"),
                   F.kll_merge_agg_bigint("latencies").alias("latencies")))
    return merged.select("service", "window_start", "requests", "errors_5xx", (F.col("errors_5xx") / F.col("requests")).alias("error_share"),
                         "timeouts_504", F.kll_sketch_get_quantile_bigint("latencies", F.array(*[F.lit(s) for s in shares])).alias("latency_at"))



def service_health(logs: DataFrame, ts: Column, window: str = "1 hour") -> DataFrame:
    """Per service and tumbling window: requests, 5xx count and share,
    504 (time-out) count, exact latency p50 / p95 / p99."""
    status = F.col("status_code")
    return (logs.groupBy("service", F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.count(F.when(status >= 500, True)).alias("errors_5xx"),
                 F.count(F.when(status == 504, True)).alias("timeouts_504"),
                 percentiles("latency_ms", 0.5, 0.95, 0.99).alias("_p"))
            .select("service", F.col("w.start").alias("window_start"), "requests", "errors_5xx",
                    (F.col("errors_5xx") / F.col("requests")).alias("error_share"), "timeouts_504",
                    F.col("_p")[0].alias("p50_latency_ms"), F.col("_p")[1].alias("p95_latency_ms"),
                    F.col("_p")[2].alias("p99_latency_ms")))


def percentiles(column: str | Column, *shares: float) -> Column:
    """Exact percentiles as one array: one value-to-count map serves them all."""
    return F.percentile(column, F.array(*[F.lit(s) for s in shares]))


# --- B5: carrier latency ------------------------------------------------------


def carrier_latency(shipment_events: DataFrame, pickup: str = "PICKED_UP", delivered: str = "DELIVERED",
                    unit_seconds: int = 86_400) -> DataFrame:
    """Per carrier delivery latency from shipment event lists.

    Input: one row per shipment event ``(carrier, tracking_number, event,
    time)`` (``explode`` of the payload's event list). Per tracking number the
    first pickup and the last delivery (a partially aggregated ``groupBy``);
    shipments delivered before pickup are counted apart (``invalid``) and
    left out of the statistics. Latency in whole ``unit_seconds``.
    """
    t = F.floor(epoch_micros(shipment_events, "time") / F.lit(1_000_000)).cast("bigint")
    per = (shipment_events.groupBy("carrier", "tracking_number")
           .agg(F.min(F.when(F.col("event") == pickup, t)).alias("_p"),
                F.max(F.when(F.col("event") == delivered, t)).alias("_d")))
    lat = F.floor((F.col("_d") - F.col("_p")) / F.lit(unit_seconds)).cast("bigint")
    per = per.withColumn("latency", F.when(F.col("_d").isNotNull() & F.col("_p").isNotNull(), lat))
    valid = F.col("latency") >= 0
    stats = per.groupBy("carrier").agg(
        F.count(F.when(valid, True)).alias("delivered"),
        F.count(F.when(F.col("latency") < 0, True)).alias("invalid"),
        F.count(F.when(F.col("latency").isNull(), True)).alias("open"),
        F.avg(F.when(valid, F.col("latency"))).alias("avg_latency"),
        percentiles(F.when(valid, F.col("latency")), 0.5, 0.95).alias("_p"),
        F.max(F.when(valid, F.col("latency"))).alias("max_latency"))
    stats = stats.select("carrier", "delivered", "invalid", "open", "avg_latency", F.col("_p")[0].alias("p50_latency"),
                         F.col("_p")[1].alias("p95_latency"), "max_latency")
    # One row per carrier: the ranking window sees a handful of rows.
    return stats.withColumn("worst_rank", F.rank().over(Window.orderBy(F.col("avg_latency").desc_nulls_last())))


# --- B9: sessions and funnel ----------------------------------------------------


def sessions(sessionized: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """One row per (key, session_start) from :func:`keyed.sessionize`."""
    keys = list(keys)
    return (sessionized.groupBy(*keys, "session_start")
            .agg(F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("events"),
                 F.count(F.when(F.col("event_type") == "view", True)).alias("views"),
                 F.count(F.when(F.col("event_type") == "click", True)).alias("clicks"),
                 F.count(F.when(F.col("event_type") == "purchase", True)).alias("purchases")))


def funnel(events: DataFrame, key: str, steps: Sequence[str]) -> DataFrame:
    """Per key, events per funnel step (conditional counts, one pass)."""
    cols = [F.count(F.when(F.col("event_type") == s, True)).alias(f"n_{s}") for s in steps]
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("n_events"), *cols)


# --- B2 / B10: time-bounded matching without pairs -----------------------------


def count_within(probes: DataFrame, probe_id: str, probe_ts: str, targets: DataFrame, target_ts: str,
                 seconds: int, keys: Sequence[str] = (), bucket_seconds: int = 3_600) -> DataFrame:
    """For each probe row, the number of target rows of the same key whose time
    lies in ``[probe_ts - seconds, probe_ts + seconds]``, plus the seconds
    since the latest such target at or before the probe
    (``seconds_since_last``, null when there is none in the bound).

    Exact and pair-free: targets and three points per probe (``ts - N``,
    ``ts + N`` and ``ts`` itself) are ordered per key by time; one bucketed
    pass gives the running target count, so ``count(<= ts + N) - count(< ts - N)``
    is the count in the bound, and the running latest target time at ``ts``
    gives ``seconds_since_last``. ``probe_id`` must identify a probe row
    (unique, not null); the output has the probe's columns plus the two
    results.
    """
    keys = list(keys)
    us = F.lit(seconds * 1_000_000)
    p_us = epoch_micros(probes, probe_ts)
    t_us = epoch_micros(targets, target_ts)
    # kind orders rows at equal time: lower probe (0) < target (1) < upper
    # probe (2) < the probe itself (3). The three probe points come from one
    # scan of the probes (an explode), the targets from one scan. Targets at
    # one time are one row with their number, folded map-side.
    tgt = (targets.select(*keys, t_us.alias("_t")).groupBy(*keys, "_t").agg(F.count(F.lit(1)).alias("_n"))
           .select(*keys, "_t", F.lit(1).alias("_kind"),
                   F.lit(None).cast(probes.schema[probe_id].dataType).alias("_pid"), "_n"))
    # The probe's own columns ride along on its own point (kind 3), so the
    # result needs no join back to the probes (one scan of them).
    payload = F.struct(*[F.col(c) for c in probes.columns])
    null_payload = F.lit(None).cast(probes.select(payload.alias("p")).schema["p"].dataType)
    tgt = tgt.withColumn("_payload", null_payload)
    points = F.array(F.struct((p_us - us).alias("_t"), F.lit(0).alias("_kind"), null_payload.alias("_payload")),
                     F.struct((p_us + us).alias("_t"), F.lit(2).alias("_kind"), null_payload.alias("_payload")),
                     F.struct(p_us.alias("_t"), F.lit(3).alias("_kind"), payload.alias("_payload")))
    prb = probes.select(*keys, F.col(probe_id).alias("_pid"), F.explode(points).alias("_p")).select(
        *keys, "_p._t", "_p._kind", "_pid", F.lit(0).cast("bigint").alias("_n"), "_p._payload")
    rows = tgt.unionByName(prb)
    bucket = F.floor(F.col("_t") / F.lit(bucket_seconds * 1_000_000)).cast("bigint")
    staged = S.stage(rows, keys, bucket)
    is_target = F.col("_kind") == 1
    counted = S.running_aggs_staged(staged, keys, ["_t", "_kind", "_pid"], {
        "_cum": (F.col("_n"), "sum"),
        "_last_t": (F.when(is_target, F.col("_t")), "max"),
    })
    per = (counted.where(F.col("_kind") != 1).groupBy("_pid")
           .agg(F.max(F.when(F.col("_kind") == 2, F.col("_cum"))).alias("_hi"),
                F.max(F.when(F.col("_kind") == 0, F.col("_cum"))).alias("_lo"),
                F.max(F.when(F.col("_kind") == 3, F.col("_last_t"))).alias("_last"),
                F.max(F.when(F.col("_kind") == 3, F.col("_t"))).alias("_at"),
                F.max_by("_payload", "_kind").alias("_probe")))
    gap = (F.col("_at") - F.col("_last")) / F.lit(1_000_000.0)
    return per.select(*[F.col(f"_probe.{c}").alias(c) for c in probes.columns],
                      (F.col("_hi") - F.col("_lo")).cast("bigint").alias("n_within"),
                      F.when(F.col("_last") >= F.col("_at") - us, gap).alias("seconds_since_last"))


def failures_near_purchases(purchases: DataFrame, failures: DataFrame, seconds: int,
                            bucket_seconds: int = 60) -> DataFrame:
    """Per purchase event, failing checkout requests within ``seconds``.

    There is no key, so the running count is partitioned by time bucket
    alone. Failures are folded to one row per time first, and a bucket is a
    minute: a task holds a minute's purchases. The per-bucket summary is
    ranked in one task, which has one row per minute of the whole span.
    """
    return count_within(purchases, "event_id", "ts", failures, "log_ts", seconds, bucket_seconds=bucket_seconds)


def purchases_vs_orders(purchases: DataFrame, orders: DataFrame, key: str = "user_id",
                        order_key: str = "o_custkey") -> DataFrame:
    """B2: per customer, purchase events against orders (full outer join of
    per-key counts): ``matched``, ``no_order`` (purchases but no order) or
    ``no_event`` (orders but no purchase event)."""
    p = purchases.groupBy(F.col(key).alias("customer_id")).agg(F.count(F.lit(1)).alias("purchase_events"))
    o = orders.groupBy(F.col(order_key).alias("customer_id")).agg(F.count(F.lit(1)).alias("orders"))
    j = p.join(o, "customer_id", "full")
    status = (F.when(F.col("purchase_events").isNotNull() & F.col("orders").isNotNull(), "matched")
              .when(F.col("orders").isNull(), "no_order").otherwise("no_event"))
    return j.select("customer_id", F.coalesce("purchase_events", F.lit(0)).alias("purchase_events"),
                    F.coalesce("orders", F.lit(0)).alias("orders"), status.alias("status"))


def purchases_matched_within(purchases: DataFrame, orders: DataFrame, seconds: int, key: str = "user_id",
                             order_key: str = "o_custkey", order_ts: str = "o_orderdate",
                             bucket_seconds: int = S.BUCKET_SECONDS) -> DataFrame:
    """B2 with a time bound: each purchase event is ``matched`` when the same
    customer has an order within ``seconds`` of it, else ``no_order``."""
    o = orders.select(F.col(order_key).alias(key), F.col(order_ts).alias("_ots"))
    counted = count_within(purchases, "event_id", "ts", o, "_ots", seconds, keys=[key],
                           bucket_seconds=bucket_seconds)
    return counted.withColumn("status", F.when(F.col("n_within") > 0, "matched").otherwise("no_order"))


_FAR = 1 << 60


def match_one_to_one(purchases: DataFrame, orders: DataFrame, keys: Sequence[str], seconds: int,
                     purchase: tuple[str, str] = ("event_id", "ts"), order: tuple[str, str] = ("order_id", "order_ts"),
                     bucket_seconds: int = S.BUCKET_SECONDS) -> DataFrame:
    """B2: purchases and orders paired one to one, each used once at most.

    An order takes the oldest purchase of its keys that is at most ``seconds``
    older and not taken yet; that leaves as few as possible without a partner.
    Classes: ``matched``, ``no_order`` (purchase alone), ``no_event`` (order alone).

    No pairs are built. The next free purchase is a number that the orders of a
    key move on one after the other: order ``j`` sees purchases ``L`` (the first
    not too old) up to ``U`` (those before it) and takes the later of ``L`` and
    the next free one, if below ``U``. With ``j`` subtracted this is a clamp to
    ``[L - j, U - j - 1]``, and clamps in a row make a clamp again. ``L``, ``U``
    and ``j`` are running sums; an hour's orders of a key make one clamp, a
    scan over a key's hours tells where each hour starts, and hours then run
    independently. A hot key is spread over its hours, never held whole.

    ``purchase`` and ``order`` name the id and time columns; ids identify rows.
    """
    keys = list(keys)
    (pid, pts), (oid, ots) = purchase, order
    width = F.lit(bucket_seconds * 1_000_000)
    p = purchases.select(*keys, epoch_micros(purchases, pts).alias("_t"), F.lit(1).alias("_kind"),
                         F.struct(F.col(pid).alias("id"), F.col(pts).alias("at")).alias("_p"))
    t = epoch_micros(orders, ots)
    points = F.array(F.struct((t - seconds * 1_000_000).alias("t"), F.lit(0).alias("kind")),
                     F.struct(t.alias("t"), F.lit(2).alias("kind")))
    o = orders.select(*keys, F.struct(F.col(oid).alias("id"), F.col(ots).alias("at")).alias("_o"), F.explode(points).alias("_x")).select(
        *keys, F.col("_x.t").alias("_t"), F.col("_x.kind").alias("_kind"), "_o")
    rows = p.unionByName(o, allowMissingColumns=True)
    counted = S.running_aggs_staged(
        S.stage(rows, keys, F.floor(F.col("_t") / width).cast("bigint")), keys, ["_t", "_kind", "_p", "_o"],
        {"_purchases": (F.when(F.col("_kind") == 1, 1).otherwise(0), "sum"),
         "_orders": (F.when(F.col("_kind") == 2, 1).otherwise(0), "sum")})
    ranked = counted.where(F.col("_kind") == 1).select(*keys, "_p", (F.col("_purchases") - 1).alias("_rank"))

    def at(kind: int, name: str) -> Column:
        return F.max(F.when(F.col("_kind") == kind, F.col(name)))

    seen = (counted.where(F.col("_kind") != 1).groupBy(*keys, "_o")
            .agg((at(2, "_orders") - 1).alias("j"), at(0, "_purchases").alias("low"), at(2, "_purchases").alias("high"), at(2, "_t").alias("_t")))
    held = (seen.select(*keys, F.floor(F.col("_t") / width).cast("bigint").alias("_bucket"), F.struct("j", "low", "high", "_o").alias("_s"))
            .groupBy(*keys, "_bucket").agg(F.sort_array(F.collect_list("_s")).alias("_seen")))

    def clamp(free: Column, s: Column) -> Column:
        return F.least(F.greatest(free, s["low"] - s["j"]), s["high"] - s["j"] - 1)

    hours = held.select(*keys, "_bucket", *[F.aggregate("_seen", F.lit(edge).cast("bigint"), clamp).alias(name)
                                            for name, edge in (("lo", -_FAR), ("hi", _FAR))])
    chain = hours.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_bucket", "lo", "hi"))).alias("_chain"))
    starts = chain.select(*keys, F.explode(F.transform("_chain", lambda c, i: F.struct(
        c["_bucket"].alias("b"),
        F.aggregate(F.slice("_chain", F.lit(1), i), F.lit(0).cast("bigint"), lambda y, h: F.least(F.greatest(y, h["lo"]), h["hi"])).alias("free")))).alias("_h"))
    starts = starts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_h.b", "_h.free")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col("_bucket") == F.col("b"))

    def take(state: Column, s: Column) -> Column:
        rank = F.greatest(state["free"] + s["j"], s["low"])
        made = F.struct(F.when(rank < s["high"], rank).alias("rank"), s["_o"].alias("o"))
        return F.struct(clamp(state["free"], s).alias("free"), F.concat(state["made"], F.array(made)).alias("made"))

    nothing = F.slice(F.transform("_seen", lambda s: F.struct(s["j"].alias("rank"), s["_o"].alias("o"))), 1, 0)
    taken = held.join(starts, same).select(*keys, F.explode(F.aggregate(
        "_seen", F.struct(F.col("free").alias("free"), nothing.alias("made")), take)["made"]).alias("_m"))
    taken = taken.select(*keys, F.col("_m.rank").alias("_rank"), F.col("_m.o").alias("_o"))
    both = ranked.join(taken, [*keys, "_rank"], "full_outer")
    status = F.when(F.col("_p").isNull(), "no_event").when(F.col("_o").isNull(), "no_order").otherwise("matched")
    return both.select(*keys, F.col("_p.id").alias(pid), F.col("_p.at").alias(pts), F.col("_o.id").alias(oid),
                       F.col("_o.at").alias(ots), status.alias("status"))


# --- B6: discrepancy layer ------------------------------------------------------

SEVERITY = {"missing_shipment": "high", "orphan_shipment": "medium", "duplicate_order": "medium",
            "duplicate_shipment": "low", "unmatched_purchase": "high", "order_without_event": "medium",
            "constraint_breach": "high", "referential_breach": "high"}


def severity_of(kind: Column) -> Column:
    """The severity of a discrepancy kind, from the one table of them."""
    table = F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])
    return F.coalesce(F.element_at(table, kind), F.lit("low"))


def discrepancy(df: DataFrame, kind: str | Column, key: Column, detail: Column, detected_at: Column) -> DataFrame:
    """One discrepancy row per input row: ``(kind, severity, key, detail, detected_at)``."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return df.select(kind.alias("kind"), severity_of(kind).alias("severity"), key.cast("string").alias("key"),
                     detail.cast("string").alias("detail"), detected_at.alias("detected_at"))


TRACKED = ("kind", "key", "severity", "detail", "first_seen", "last_seen", "resolved_at")


def track_discrepancies(open_: DataFrame | None, found: DataFrame, run_at: Column) -> DataFrame:
    """B6 life cycle: what a run at ``run_at`` found, against what was open before it.

    ``open_`` has the ``TRACKED`` columns of unresolved discrepancies, ``found`` those of
    :func:`discrepancy`. One that is found again keeps its ``first_seen`` and gets the new detail; one that is not found
    is resolved at the run's time; one that is new, or comes back after it was resolved, is seen first now. It is one
    null-safe full outer join; resolved rows are not carried on, so the work of a run follows what is open. Rows that
    are found twice are one.
    """
    now = found.groupBy("kind", "key").agg(F.max(F.struct("severity", "detail")).alias("n"))
    if open_ is None:
        return now.select("kind", "key", "n.severity", "n.detail", run_at.alias("first_seen"), run_at.alias("last_seen"),
                          F.lit(None).cast(found.schema["detected_at"].dataType).alias("resolved_at"))
    before = open_.select(F.col("kind").alias("_kind"), F.col("key").alias("_key"), F.struct(*TRACKED[2:]).alias("b"))
    both = now.join(before, F.col("kind").eqNullSafe(F.col("_kind")) & F.col("key").eqNullSafe(F.col("_key")), "full_outer")
    seen, known = F.col("n").isNotNull(), F.col("b").isNotNull()

    def either(new: str, old: str) -> Column:
        return F.when(seen, F.col(new)).otherwise(F.col(old))

    return both.select(
        either("kind", "_kind").alias("kind"), either("key", "_key").alias("key"), either("n.severity", "b.severity").alias("severity"),
        either("n.detail", "b.detail").alias("detail"), F.when(known, F.col("b.first_seen")).otherwise(run_at).alias("first_seen"),
        F.when(seen, run_at).otherwise(F.col("b.last_seen")).alias("last_seen"), F.when(~seen, run_at).alias("resolved_at"))


def discrepancy_counts(discrepancies: DataFrame) -> DataFrame:
    """Counts per kind and severity with subtotals (``rollup``)."""
    return (discrepancies.rollup("severity", "kind").agg(F.count(F.lit(1)).alias("n"))
            .select(F.coalesce("severity", F.lit("ALL")).alias("severity"),
                    F.coalesce("kind", F.lit("ALL")).alias("kind"), "n"))


def route_late(updates: DataFrame, ts: str, arrival: str, lateness_seconds: int) -> DataFrame:
    """B7 (batch): adds ``late``: the update is older than ``lateness_seconds``
    behind the newest update of all earlier ``arrival`` batches.

    One row per arrival is ranked in one task; the updates themselves are
    joined to it, not windowed.
    """
    marks = updates.groupBy(arrival).agg(F.max(epoch_micros(updates, ts)).alias("_newest"))
    before = Window.orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.select(arrival, F.max("_newest").over(before).alias("_mark"))
    late = epoch_micros(updates, ts) < F.col("_mark") - F.lit(lateness_seconds * 1_000_000)
    return updates.join(marks, arrival).withColumn("late", F.coalesce(late, F.lit(False))).drop("_mark")


def latest_status(updates: DataFrame, key: str, ts: str, status: str) -> DataFrame:
    """B7 (batch): the latest status per key (``max_by``, partially aggregated)."""
    return updates.groupBy(key).agg(F.max_by(status, F.struct(ts, status)).alias(status),
                                    F.max(ts).alias(ts))


__all__ = ["product_activity", "service_health", "carrier_latency", "sessions", "funnel", "count_within",
           "activity_windows", "percentiles", "severity_of", "failures_near_purchases", "purchases_vs_orders", "purchases_matched_within", "discrepancy",
           "discrepancy_counts", "latest_status", "top_per_window"]
