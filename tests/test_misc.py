import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import jobs
from strata.functions import parse as P
from strata.operators import marts as M
from strata.operators import normalize as N
from strata.schemas import BRONZE_SCHEMAS, CLICKSTREAM_SCHEMA, bronze_ddl
from strata.session import DEFAULT_CONF, ensure_checkpoint_dir, scratch_path
from tests.conftest import docs


def test_bronze_ddl_keeps_types_and_adds_audit(spark):  # toDDL needs the JVM
    ddl = bronze_ddl(BRONZE_SCHEMAS["shipment_data"])
    assert ddl.endswith("_ingested_at TIMESTAMP")
    assert "ARRAY<STRUCT<event: STRING, time: STRING>>" in ddl
    assert "_ingested_at" not in CLICKSTREAM_SCHEMA.fieldNames()  # not mutated
    dec = bronze_ddl(T.StructType([T.StructField("amount", T.DecimalType(10, 2))]))
    assert dec.startswith("amount DECIMAL(10,2)")


def test_session_checkpoint_dir(spark):
    path = ensure_checkpoint_dir(spark)
    assert path == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(path.rstrip("/") + "/strata/x-")
    assert DEFAULT_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_utc_stamp_and_time_parse(spark):
    row = spark.range(1).select(P.utc_stamp().alias("s"),
                                P.parse_time(F.lit("2026-06-11T10:00:00+02:00")).alias("t"),
                                P.parse_time(F.lit("nope")).alias("bad")).first()
    assert len(row.s) == 16 and row.s.endswith("Z")
    assert row.bad is None
    ntz = spark.range(1).select(P.to_utc_wall_clock(spark, P.parse_time(F.lit("2026-06-11T10:00:00+02:00")))
                                .alias("u")).first().u
    assert (ntz.hour, ntz.minute) == (8, 0)


def test_object_records_drop_non_objects(spark):
    d = docs(spark, '[{"order_id":"o-1"}, 5, null, {"order_id":"o-2"}]', '{"order_id":"o-3"}', "null")
    got = sorted(r.record.toPython()["order_id"] for r in N.object_records(d).collect())
    assert got == ["o-1", "o-2", "o-3"]


def test_silver_file_job_dataset_name(spark, scratch):
    path = f"{scratch}/orders.json"
    with open(path, "w") as fh:
        json.dump([{"order_id": "o-1", "customer": {"name": "Ada"}}], fh)
    jobs.silver_file_job(spark, path, f"{scratch}/silver")
    row = spark.read.parquet(f"{scratch}/silver").first()
    assert (row.dataset, row.customer_name, row.source_name, row.record_index) == ("orders", "Ada", "orders", 0)


def test_envelope_unwrap_option(spark):
    env = json.dumps({"source": "clickstream", "ingested_at": "x", "records": [{"a": 1}, {"a": 2}]})
    parity = N.normalize(docs(spark, env), "s").collect()
    assert len(parity) == 1                                        # parity: not unwrapped
    fixed = N.normalize(docs(spark, env), "s", unwrap_keys=("shipments", "records")).collect()
    assert sorted(r.a for r in fixed) == [1, 2]


def test_purchases_matched_within(spark):
    purchases = spark.createDataFrame([(1, 10, "2026-01-01 10:00:00"), (2, 10, "2026-01-03 10:00:00"),
                                       (3, 11, "2026-01-01 10:00:00")], "event_id int, user_id int, ts string") \
        .withColumn("ts", F.to_timestamp_ntz("ts"))
    orders = spark.createDataFrame([(10, "2026-01-01 12:00:00")], "o_custkey int, o_orderdate string") \
        .withColumn("o_orderdate", F.to_timestamp_ntz("o_orderdate"))
    got = {r.event_id: r.status for r in M.purchases_matched_within(purchases, orders, 6 * 3600).collect()}
    assert got == {1: "matched", 2: "no_order", 3: "no_order"}


def test_latest_status(spark):
    df = spark.createDataFrame([(1, 1, "PICKED_UP"), (1, 3, "DELIVERED"), (1, 2, "IN_TRANSIT")],
                               "order_id int, ts int, status string")
    assert M.latest_status(df, "order_id", "ts", "status").first().status == "DELIVERED"


def test_write_raw_layout(spark, scratch):
    from strata.sinks import files as sinks
    out = sinks.write_raw(spark.createDataFrame([("e-1", "purchase")], "event_id string, event_type string"),
                          f"{scratch}/raw", "clickstream_events")
    assert out.endswith("source=clickstream_events")
    assert any(d.startswith("ingest_date=") for d in os.listdir(out))
    back = spark.read.json(f"{scratch}/raw").first()
    assert back.event_id == "e-1" and back.source == "clickstream_events"


def test_constraint_report_and_orphans(spark):
    from strata.operators import checks as CK
    users = spark.createDataFrame([(1, "a@x", "Ada"), (1, "b@x", None), (None, "a@x", "Bo"), (2, None, "Cy")],
                                  "user_id int, email string, full_name string")
    rep = {(r.check, r.column): r.violations for r in
           CK.constraint_report(users, "users", ["user_id"], ["email", "full_name"], unique=[["email"]]).collect()}
    assert rep == {("not_null", "user_id"): 1, ("not_null", "email"): 1, ("not_null", "full_name"): 1,
                   ("primary_key", "user_id"): 1, ("unique", "email"): 1}
    orders = spark.createDataFrame([(10, 1), (11, 7), (12, 7), (13, None)], "order_id int, user_id int")
    orphans = CK.orphan_keys(orders, "user_id", users, "user_id", "orders.user_id->users").collect()
    assert [(r.key, r.rows) for r in orphans] == [(7, 2)]


def test_top_per_window_salted_is_exact(spark):
    rows = [("2024-01-01 00:00:00", p, n) for p, n in enumerate([5, 9, 9, 1, 7, 9, 3, 8, 2, 6] * 5)]
    counts = spark.createDataFrame(rows, "window_start string, product_id int, interactions int") \
        .withColumn("window_end", F.col("window_start")).withColumn("purchases", F.lit(0)) \
        .withColumn("users", F.lit(1))
    got = [(r.product_id, r.rank) for r in M.top_per_window(counts, 3, salt_buckets=4).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 2), (5, 3)]


def test_sizing_conf():
    from strata.session import sizing_conf
    conf = sizing_conf(100 * 1024 ** 4, 8000)
    assert conf["spark.sql.shuffle.partitions"] == "409600"
    assert sizing_conf(10 * 1024 ** 2, 8)["spark.sql.shuffle.partitions"] == "16"


def test_epoch_micros_ignores_session_zone(spark):
    from strata.functions.timecols import as_instant, epoch_micros, instant_as_ntz
    df = spark.sql("select timestamp_ntz'2024-03-10 01:30:00' a, timestamp_ntz'2024-03-10 03:30:00' b")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")  # DST starts 2024-03-10 02:00
    try:
        r = df.select((epoch_micros(df, "b") - epoch_micros(df, "a")).alias("d"),
                      instant_as_ntz(spark, as_instant(df, "a")).alias("back")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.d == 2 * 3600 * 1_000_000
    assert str(r.back) == "2024-03-10 01:30:00"


def test_deduplicate_and_json_lines(spark, scratch):
    from strata.operators import keyed as K
    from strata.sources import files
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, v string")
    assert sorted(tuple(r) for r in K.deduplicate(df, ["id"]).collect()) == [(1, "a"), (2, "c")]
    assert K.deduplicate(df.select("id"), ["id"]).count() == 2
    os.makedirs(f"{scratch}/jl/sub")
    with open(f"{scratch}/jl/sub/a.json", "w") as fh:
        fh.write('{"x":1}\n{"x":2}\n')
    lines = files.read_json_lines(spark, f"{scratch}/jl")
    assert lines.count() == 2 and lines.first().path.endswith("sub/a.json")


def test_kafka_source_needs_its_connector(spark):
    import pytest
    from strata.streaming import bronze as B
    with pytest.raises(Exception, match="(?i)kafka"):
        B.kafka_stream(spark, "localhost:9092", "clickstream_events")


def test_orphan_report_matches_single_checks(spark):
    from strata.operators import checks as CK
    lines = spark.createDataFrame([(1, 10, 100), (2, 11, 100), (9, 10, 101), (9, None, 102), (None, 12, 100)],
                                  "o bigint, p bigint, s bigint")
    orders = spark.createDataFrame([(1,), (2,)], "o_orderkey bigint")
    parts = spark.createDataFrame([(10,), (11,)], "p_partkey bigint")
    supp = spark.createDataFrame([(100,)], "s_suppkey bigint")
    rep = CK.orphan_report([(lines, [("o", "l->o", orders, "o_orderkey"), ("p", "l->p", parts, "p_partkey"),
                                     ("s", "l->s", supp, "s_suppkey")])])
    got = sorted((r.relation, r.key, r.rows) for r in rep.collect())
    assert got == [("l->o", 9, 2), ("l->p", 12, 1), ("l->s", 101, 1), ("l->s", 102, 1)]
    single = CK.orphan_keys(lines, "s", supp, "s_suppkey", "l->s")
    assert sorted((r.key, r.rows) for r in single.collect()) == [(101, 1), (102, 1)]


def test_apply_changes_update_and_upsert(spark):
    from strata.operators import keyed as K
    target = spark.createDataFrame([(1, "PLACED", 10.0), (2, "PLACED", 20.0)], "id int, status string, amount double")
    changes = spark.createDataFrame([(1, "SHIPPED", 1), (1, "DELIVERED", 2), (3, "PLACED", 1)],
                                    "id int, new_status string, seq int")
    upd = {r.id: (r.status, r.amount, r.updated_at) for r in
           K.apply_changes(target, changes, ["id"], ["seq"], {"status": "new_status"}, change_time="seq").collect()}
    assert upd == {1: ("DELIVERED", 10.0, 2), 2: ("PLACED", 20.0, None)}
    ups = {r.id: r.status for r in
           K.apply_changes(target, changes, ["id"], ["seq"], {"status": "new_status"}, insert_missing=True).collect()}
    assert ups == {1: "DELIVERED", 2: "PLACED", 3: "PLACED"}


def test_order_life_cycle_and_history(spark):
    from strata.operators import keyed as K
    from strata.schemas import ORDER_TRANSITIONS
    rows = [(1, "2026-01-01 00:00:00", "PLACED"), (1, "2026-01-02 00:00:00", "SHIPPED"),
            (1, "2026-01-03 00:00:00", "DELIVERED"), (2, "2026-01-01 00:00:00", "SHIPPED"),
            (2, "2026-01-05 00:00:00", "PLACED"), (3, "2026-01-01 00:00:00", "PLACED"),
            (3, "2026-01-01 00:00:00", "PLACED")]
    df = spark.createDataFrame([(k, t, s, i) for i, (k, t, s) in enumerate(rows)],
                               "order_id int, ts string, status string, seq int") \
        .withColumn("ts", F.to_timestamp_ntz("ts"))
    bad = sorted(((r.order_id, r.prev_status, r.status) for r in K.transition_violations(
        df, ["order_id"], "ts", ["seq"], "status", ORDER_TRANSITIONS, allow_initial=["PLACED"]).collect()),
        key=lambda t: (t[0], t[1] or "", t[2]))
    assert bad == [(2, None, "SHIPPED"), (2, "SHIPPED", "PLACED")]
    hist = {(r.order_id, r.status, r.seq): (r.valid_to, r.is_current)
            for r in K.scd2_history(df, ["order_id"], "ts", ["seq"]).collect()}
    assert str(hist[(1, "PLACED", 0)][0]) == "2026-01-02 00:00:00" and hist[(1, "DELIVERED", 2)] == (None, True)
    latest = {r.order_id: r.status for r in K.latest_per_key(df, ["order_id"], ["ts", "seq"]).collect()}
    assert latest == {1: "DELIVERED", 2: "PLACED", 3: "PLACED"}


def test_kafka_batch_needs_its_connector(spark):
    import pytest
    from strata.streaming import bronze as B
    with pytest.raises(Exception, match="(?i)kafka"):
        B.kafka_batch(spark, "localhost:9092", "server_logs", max_messages=5).count()


def test_session_conf_layers():
    from strata.session import session_conf
    conf = session_conf({"spark.sql.shuffle.partitions": "64"}, input_bytes=100 * 1024 ** 4, total_cores=8000)
    assert conf["spark.sql.shuffle.partitions"] == "64"                 # explicit conf wins
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * 1024 * 1024)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert "spark.sql.files.maxPartitionBytes" in session_conf()


def test_keys_compare_exactly_and_by_type(spark):
    from strata.operators import reconcile as R
    big = 2 ** 53
    orders = spark.createDataFrame([(big,), (big + 1,)], "order_id bigint")
    ships = spark.createDataFrame([(str(big),), (str(big + 1),)], "k string").selectExpr("cast(k as decimal(20,0)) order_id")
    r = R.reconcile_report(orders, ships).first()
    assert (r.unique_orders, r.duplicate_orders, r.matched_unique_orders) == (2, 0, 2)
    numbers = spark.createDataFrame([(1,), (2,), (0,)], "order_id int")
    texts = spark.createDataFrame([("1",), ("x",), ("",)], "order_id string")
    r = R.reconcile(numbers, texts)
    assert (r.report.first().matched_orders, r.report.first().total_orders, r.report.first().unique_orders) == (0, 3, 2)
    assert sorted(x.order_id for x in r.orphans.collect()) == ['"1"', '"x"']
    assert sorted(x.order_id for x in R.missing_shipments(numbers, texts).collect()) == ["1", "2"]
    assert R.matched_orders(numbers, texts).count() == 0


def test_no_job_runs_before_the_action(spark):
    from strata.plans import QUERIES
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    try:
        QUERIES["flatten_ragged"](spark, "/root/testdata/sf0.001")
        QUERIES["product_activity_window"](spark, "/root/testdata/sf0.001")
        jobs = [j for j in tracker.getJobIdsForGroup("plan-only")]
    finally:
        spark.sparkContext.setJobGroup("", "")
    # Reading a parquet footer is the only thing that may run.
    assert all(tracker.getJobInfo(j) is None or len(tracker.getJobInfo(j).stageIds) == 1 for j in jobs)


def test_payment_is_needed_to_leave_placed(spark):
    rows = [(1, 1, "PLACED", "PENDING"), (1, 2, "SHIPPED", "PENDING"), (2, 1, "PLACED", "PENDING"), (2, 2, "PLACED", "PAID"),
            (2, 3, "SHIPPED", "PAID"), (3, 1, "PLACED", "PAID"), (3, 2, "DELIVERED", "PAID"), (4, 1, "PLACED", None),
            (4, 2, "CANCELLED", None)]
    df = spark.createDataFrame(rows, "o int, n int, status string, pay string").withColumn(
        "ts", F.timestamp_seconds("n").cast("timestamp_ntz"))
    from strata import schemas as S
    from strata.operators import keyed as K
    bad = K.transition_violations(df, ["o"], "ts", ["n"], "status", S.ORDER_TRANSITIONS, needs={"PLACED": F.col("pay") == "PAID"})
    assert sorted((r.o, r.n) for r in bad.collect()) == [(1, 2), (3, 2), (4, 2)]


def test_bare_log_lines_that_are_json_values(spark):
    from strata.operators import contracts as C
    lines = ["12345", "true", "null", '"text"', "plain text", "[1]", '{"message":"m"}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [r.message for r in C.validate(df, "server_logs").valid.collect()]
    assert got == ["12345", "true", "null", "text", "plain text", "[1]", "m"]
