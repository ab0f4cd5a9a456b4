"""Incremental history against the batch form, and streams that join outer."""

import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from strata.operators import history as H
from strata.operators import keyed as K
from strata.streaming import stateful as ST

SCHEMA = "k int, ts timestamp_ntz, n int, v string, valid_from string"
BASE = datetime(2024, 1, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def changes(spark, rows):
    return spark.createDataFrame([(k, BASE + timedelta(hours=h), n, v) for k, h, n, v in rows], "k int, ts timestamp_ntz, n int, v string")


def test_batches_with_late_rows_equal_the_batch_history(spark, scratch):
    rng = random.Random(5)
    rows = [(rng.choice((1, 1, 1, 2, 3, None)), rng.randrange(60), i, f"v{i}") for i in range(160)]
    for number in range(4):
        part = rows[number::4] + (rows[:5] if number == 2 else [])     # some come again
        H.merge_history(spark, f"{scratch}/h", changes(spark, part), ["k"], "ts", ["n"], number, buckets=4)
        so_far = [r for n in range(number + 1) for r in rows[n::4]]
        assert rows_of(H.read_history(spark, f"{scratch}/h")) == rows_of(K.scd2_history(changes(spark, sorted(set(so_far + rows[:5] if number >= 2 else so_far), key=str)), ["k"], "ts", ["n"]))
    again = rows_of(H.read_history(spark, f"{scratch}/h"))
    H.merge_history(spark, f"{scratch}/h", changes(spark, rows[3::4]), ["k"], "ts", ["n"], 3, buckets=4)
    assert rows_of(H.read_history(spark, f"{scratch}/h")) == again


def test_only_touched_buckets_are_written(spark, scratch):
    H.merge_history(spark, f"{scratch}/h", changes(spark, [(k, 1, k, "a") for k in range(40)]), ["k"], "ts", ["n"], 0, buckets=16)
    H.merge_history(spark, f"{scratch}/h", changes(spark, [(7, 2, 100, "b")]), ["k"], "ts", ["n"], 1, buckets=16)
    first, second = (len([n for n in os.listdir(f"{scratch}/h/rows/_version={v}") if n.startswith("_bucket=")]) for v in (0, 1))
    assert first > 8 and second == 1
    got = H.read_history(spark, f"{scratch}/h")
    assert got.count() == 41 and [r.is_current for r in got.where("k = 7").orderBy("ts").collect()] == [False, True]


def test_empty_batch_and_no_history(spark, scratch):
    assert H.read_history(spark, f"{scratch}/none") is None
    H.merge_history(spark, f"{scratch}/h", changes(spark, [(1, 1, 1, "a")]), ["k"], "ts", ["n"], 0)
    H.merge_history(spark, f"{scratch}/h", changes(spark, []), ["k"], "ts", ["n"], 1)
    assert H.read_history(spark, f"{scratch}/h").count() == 1


def test_outer_join_stream_emits_each_side_once(spark, scratch):
    t = lambda m: BASE + timedelta(minutes=m)
    orders = [[("a", t(0)), ("b", t(1)), (None, t(1)), ("", t(1))], [("c", t(100)), ("d", t(101))], [("end", t(9999))]]
    ships = [[("a", t(2)), ("a", t(3)), ("x", t(4))], [("c", t(90)), ("d", t(200)), ("d", t(105))], [("fin", t(9999))]]
    for number in range(3):
        for name, rows in (("o", orders), ("s", ships)):
            spark.createDataFrame(rows[number], "key string, ts timestamp_ntz").write.mode("append").parquet(f"{scratch}/{name}")
        streams = [spark.readStream.schema("key string, ts timestamp_ntz").parquet(f"{scratch}/{n}") for n in "os"]
        joined = ST.reconcile_outer_stream(streams[0], "key", "ts", streams[1], "key", "ts", 3600, "1 minute")
        (joined.writeStream.format("parquet").option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True)
         .start(f"{scratch}/out").awaitTermination())
    got = spark.read.parquet(f"{scratch}/out").groupBy("order_id", "status").agg(F.count("*")).collect()
    assert sorted(map(tuple, got)) == [("a", "matched", 2), ("b", "missing_shipment", 1), ("c", "missing_shipment", 1),
                                       ("c", "orphan_shipment", 1), ("d", "matched", 1), ("d", "orphan_shipment", 1), ("x", "orphan_shipment", 1)]
