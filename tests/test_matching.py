"""One-to-one matching against a plain two-pointer walk."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from strata.operators import marts as M

BASE = datetime(2024, 1, 1)


def plain(purchases, orders, seconds):
    out = []
    for key in {r[:2] for r in purchases} | {r[:2] for r in orders}:
        ps = sorted(((r[3], r[2]) for r in purchases if r[:2] == key))
        free = 0
        for at, oid in sorted(((r[3], r[2]) for r in orders if r[:2] == key)):
            while free < len(ps) and ps[free][0] < at - timedelta(seconds=seconds):
                out.append((*key, ps[free][1], None, "no_order"))
                free += 1
            if free < len(ps) and ps[free][0] <= at:
                out.append((*key, ps[free][1], oid, "matched"))
                free += 1
            else:
                out.append((*key, None, oid, "no_event"))
        out += [(*key, pid, None, "no_order") for _, pid in ps[free:]]
    return sorted(out, key=str)


def frames(spark, purchases, orders):
    return (spark.createDataFrame(purchases, "user_id int, product int, event_id int, ts timestamp_ntz"),
            spark.createDataFrame(orders, "user_id int, product int, order_id int, order_ts timestamp_ntz"))


def run(spark, purchases, orders, seconds, **kw):
    p, o = frames(spark, purchases, orders)
    rows = M.match_one_to_one(p, o, ("user_id", "product"), seconds, **kw).collect()
    return sorted(((r.user_id, r["product"], r.event_id, r.order_id, r.status) for r in rows), key=str)


def test_against_plain_walk(spark):
    rng = random.Random(2)
    for seconds, bucket in ((60, 3600), (600, 100), (5, 40)):
        rows = lambda n, base: [(rng.randrange(3), rng.randrange(3), base + i, BASE + timedelta(seconds=rng.randrange(2500)))
                                for i in range(n)]
        purchases, orders = rows(150, 0), rows(170, 1000)
        got = run(spark, purchases, orders, seconds, bucket_seconds=bucket)
        assert got == plain(purchases, orders, seconds)
        assert {r[4] for r in got} == {"matched", "no_order", "no_event"}


def test_expired_purchase_does_not_hold_up_later_ones(spark):
    t = lambda s: BASE + timedelta(seconds=s)
    purchases = [(1, 1, 1, t(0)), (1, 1, 2, t(7200)), (1, 1, 3, t(7200))]
    orders = [(1, 1, 10, t(7201)), (1, 1, 11, t(7202)), (1, 1, 12, t(7203)), (2, 1, 13, t(1))]
    assert run(spark, purchases, orders, 60) == sorted([
        (1, 1, 1, None, "no_order"), (1, 1, 2, 10, "matched"), (1, 1, 3, 11, "matched"), (1, 1, None, 12, "no_event"),
        (2, 1, None, 13, "no_event")], key=str)


def test_empty_sides_and_null_keys(spark):
    one = [(1, 1, 1, BASE)]
    assert run(spark, one, [], 60) == [(1, 1, 1, None, "no_order")]
    assert run(spark, [], one, 60) == [(1, 1, None, 1, "no_event")]
    assert run(spark, [], [], 60) == []
    assert run(spark, [(None, 1, 1, BASE)], [(None, 1, 2, BASE)], 60) == sorted([(None, 1, 1, None, "no_order"), (None, 1, None, 2, "no_event")], key=str)


def test_a_hot_key_is_spread_over_its_hours(spark):
    p = spark.range(4000).select(F.lit(1).alias("user_id"), F.lit(1).alias("product"), F.col("id").cast("int").alias("event_id"),
                                 (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 60)).alias("ts"))
    o = p.select("user_id", "product", F.col("event_id").alias("order_id"), (F.col("ts") + F.expr("INTERVAL 30 SECONDS")).alias("order_ts"))
    rows = M.match_one_to_one(p, o, ("user_id", "product"), 60)
    assert rows.where("status = 'matched' AND event_id = order_id").count() == 4000
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_discrepancies_open_stay_and_close(spark):
    def found(rows, day):
        frame = spark.createDataFrame(rows, "kind string, key string, detail string")
        at = F.lit(f"2024-01-0{day}").cast("timestamp_ntz")
        return M.discrepancy(frame, F.col("kind"), F.col("key"), F.col("detail"), at), at

    def step(tracked, rows, day):
        return M.track_discrepancies(tracked, *found(rows, day))

    def shown(frame):
        return sorted(((r.kind, r.key, r.detail, r.first_seen.day, r.last_seen.day, r.resolved_at and r.resolved_at.day) for r in frame.collect()), key=str)

    one = step(None, [("missing_shipment", "1", "a"), ("missing_shipment", "2", "a"), ("orphan_shipment", None, "n"), ("orphan_shipment", None, "n")], 1)
    assert shown(one) == [("missing_shipment", "1", "a", 1, 1, None), ("missing_shipment", "2", "a", 1, 1, None), ("orphan_shipment", None, "n", 1, 1, None)]
    two = step(one.where("resolved_at IS NULL"), [("missing_shipment", "2", "b"), ("orphan_shipment", None, "n"), ("orphan_shipment", "3", "c")], 2)
    assert shown(two) == [("missing_shipment", "1", "a", 1, 1, 2), ("missing_shipment", "2", "b", 1, 2, None), ("orphan_shipment", "3", "c", 2, 2, None),
                          ("orphan_shipment", None, "n", 1, 2, None)]
    three = step(two.where("resolved_at IS NULL"), [("missing_shipment", "1", "again")], 3)
    assert ("missing_shipment", "1", "again", 3, 3, None) in shown(three) and sum(r[-1] == 3 for r in shown(three)) == 3
    assert shown(step(three.where("resolved_at IS NULL"), [], 4)) == [("missing_shipment", "1", "again", 3, 3, 4)]


def test_quantile_states_merge_within_the_rank_error(spark):
    logs = spark.range(60_000).select(
        F.lit("api").alias("service"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("at"),
        F.when(F.col("id") % 50 == 0, 504).otherwise(200).alias("status_code"), (F.col("id") * 7919 % 10_007).alias("latency_ms"))
    day = M.merged_health(M.health_states(logs, F.col("at")), "day").collect()
    assert [(r.requests, r.errors_5xx, r.timeouts_504) for r in day] == [(60_000, 1200, 1200)]
    for share, value in zip((0.5, 0.95, 0.99), day[0].latency_at):
        assert abs(value / 10_007 - share) < 0.02


def test_sketched_top_products_within_the_bound(spark):
    events = spark.range(50_000).select((F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=(F.col("id") % 300).cast("double"))).alias("ts"),
                                        F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 4 == 1, 9).otherwise(1000 + F.col("id") % 5000).cast("int").alias("product_id"))
    slides = events.groupBy(F.window("ts", "1 minute")["start"].alias("slide_start")).agg(
        F.count(F.lit(1)).alias("events"), M.slide_sketch("product_id", 64).alias("sketch"))
    top = M.activity_from_sketches(slides, "5 minutes", "1 minute", 2, 64).orderBy(F.desc("events"), "rank").limit(2).collect()
    assert {r.product_id for r in top} == {7, 9} and top[0].events == 50_000
    assert all(abs(r.interactions - 12_500) <= M.SKETCH_ERROR / 64 * 50_000 for r in top)
