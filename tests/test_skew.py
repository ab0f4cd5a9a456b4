"""One key holding a third of all rows: results stay exact and the key is split."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions import sequence as S
from strata.operators import keyed as K
from strata.operators import marts as M


def _events(spark, n=30_000):
    # key 0 gets every third row; rows spread over 30 days
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("user_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 86).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("event_id"))


def test_hot_key_split_across_partitions(spark):
    ev = _events(spark)
    staged = S.stage(ev, ["user_id"], S.time_bucket(ev, "ts", 86_400))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep the 8 partitions
    try:
        parts = staged.where("user_id = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1


def test_a_key_busy_on_one_day_is_split(spark):
    day = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("user_id"),
        F.timestamp_seconds(F.lit(1_700_006_400) + F.col("id") * 2).cast("timestamp_ntz").alias("ts"))
    staged = S.stage(day, ["user_id"], S.time_bucket(day, "ts", S.BUCKET_SECONDS))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = staged.where("user_id = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) > 3 and max(r["count"] for r in rows) < 6_000


def test_hot_key_lead_matches_plain_window(spark):
    ev = _events(spark)
    got = K.scd2_history(ev, ["user_id"], "ts", ["event_id"], bucket_seconds=3_600)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    exp = ev.select("*", F.lead("ts").over(w).alias("valid_to"))
    diff = got.select("event_id", "valid_to").exceptAll(exp.select("event_id", "valid_to"))
    assert diff.count() == 0 and got.count() == ev.count()


def test_hot_key_sessions_and_counts(spark):
    ev = _events(spark, 9_000)
    s = K.sessionize(ev, ["user_id"], "ts", ["event_id"], gap_seconds=200, bucket_seconds=3_600)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lag("ts").over(w).cast("timestamp"))
    exp = ev.withColumn("st", F.when(gap.isNull() | (gap > 200), F.col("ts"))) \
        .withColumn("session_start", F.max("st").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert s.select("event_id", "session_start").exceptAll(exp.select("event_id", "session_start")).count() == 0
    probes = ev.where("event_id % 50 = 0").select("event_id", "ts")
    targets = ev.where("user_id = 0").select(F.col("ts").alias("t"))
    got = M.count_within(probes, "event_id", "ts", targets, "t", 600)
    joined = probes.alias("p").join(targets.alias("q"), F.abs(
        F.unix_seconds(F.col("p.ts").cast("timestamp")) - F.unix_seconds(F.col("q.t").cast("timestamp"))) <= 600,
        "left").groupBy("event_id").agg(F.count("q.t").alias("n_within"))
    assert got.select("event_id", "n_within").exceptAll(joined).count() == 0


def test_latest_per_key_hot(spark):
    ev = _events(spark)
    latest = {r.user_id: r.event_id for r in K.latest_per_key(ev, ["user_id"], ["ts", "event_id"]).collect()}
    assert latest[0] == 29_997


def test_running_helpers_match_plain_window(spark):
    ev = _events(spark, 6_000).withColumn("v", F.col("event_id") % 7)
    bucket = S.time_bucket(ev, "ts", 3_600)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    exp = ev.select("event_id", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"))
    got_s = S.running_sum(ev, ["user_id"], ["ts", "event_id"], F.col("v"), bucket, "s")
    got_m = S.carry_forward_max(ev, ["user_id"], ["ts", "event_id"], F.col("v"), bucket, "m")
    assert got_s.select("event_id", "s").exceptAll(exp.select("event_id", "s")).count() == 0
    assert got_m.select("event_id", "m").exceptAll(exp.select("event_id", "m")).count() == 0
    both = S.running_aggs_staged(S.stage(ev, ["user_id"], bucket), ["user_id"], ["ts", "event_id"],
                                 {"s": (F.col("v"), "sum"), "m": (F.col("v"), "max")})
    assert both.select("event_id", "s", "m").exceptAll(exp).count() == 0
