import json
import os

from pyspark.sql import functions as F

from strata.schemas import CLICKSTREAM_SCHEMA
from strata.streaming import bronze as B
from strata.streaming import stateful as ST


_MTIME = [1_750_000_000]


def _write_lines(path, name, lines):
    """Write a text file with a strictly later modification time than the
    previous one, so a file stream reads the files in writing order."""
    os.makedirs(path, exist_ok=True)
    full = os.path.join(path, name)
    with open(full, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    _MTIME[0] += 10
    os.utime(full, (_MTIME[0], _MTIME[0]))


def _click(i, ts="2026-06-11T10:00:00Z"):
    return json.dumps({"event_id": f"e-{i}", "event_time": ts, "user_id": i, "event_type": "view"})


def test_append_restart_adds_nothing(spark, scratch):
    src, out, ckpt = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt"
    _write_lines(src, "a.json", [_click(1), _click(2), "not json"])
    for _ in range(2):
        q = B.append_stream(B.json_bronze(B.text_stream(spark, src), CLICKSTREAM_SCHEMA), ckpt, path=out,
                            trigger={"availableNow": True})
        q.awaitTermination()
    df = spark.read.parquet(out)
    assert df.count() == 3                       # the second run added nothing
    assert df.where("_is_malformed").count() == 1
    _write_lines(src, "b.json", [_click(3)])
    B.append_stream(B.json_bronze(B.text_stream(spark, src), CLICKSTREAM_SCHEMA), ckpt, path=out,
                    trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(out).count() == 4  # only the new file


def test_run_bronze_streams_to_tables(spark, scratch):
    clicks, logs = f"{scratch}/clicks", f"{scratch}/logs"
    _write_lines(clicks, "c.json", [_click(1)])
    _write_lines(logs, "l.txt", ["2026-06-11T10:00:00Z 127.0.0.1 api-gateway GET /home 200 100ms", "junk"])
    sources = [B.BronzeSource("clickstream_events", B.text_stream(spark, clicks), CLICKSTREAM_SCHEMA),
               B.BronzeSource("server_logs", B.text_stream(spark, logs))]
    qs = B.run_bronze_streams(spark, sources, f"{scratch}/bronze", f"{scratch}/ck",
                              trigger={"availableNow": True}, tables=True)
    for q in qs:
        q.awaitTermination()
    assert spark.table("bronze.clickstream_events").count() == 1
    assert spark.table("bronze.server_logs").collect()[0].status_code == 200
    # create-if-absent: a second ensure keeps the rows
    B.ensure_table(spark, "bronze.server_logs", spark.table("bronze.server_logs").drop("_ingested_at").schema)
    assert spark.table("bronze.server_logs").count() == 1
    spark.sql("DROP TABLE bronze.clickstream_events")
    spark.sql("DROP TABLE bronze.server_logs")


def test_late_router(spark, scratch):
    src = f"{scratch}/ship"
    _write_lines(src, "1.json", [json.dumps({"order_id": 1, "status": "shipped", "ts": "2026-06-11T10:00:00Z"})])
    _write_lines(src, "2.json", [json.dumps({"order_id": 2, "status": "shipped", "ts": "2026-06-11T12:00:00Z"}),
                                 json.dumps({"order_id": 1, "status": "delivered", "ts": "2026-06-11T08:00:00Z"})])
    raw = spark.readStream.format("json").schema("order_id int, status string, ts timestamp") \
        .option("maxFilesPerTrigger", 1).load(src)
    q = ST.late_router(raw, "ts", 3600, f"{scratch}/on", f"{scratch}/late", f"{scratch}/marks", f"{scratch}/ck")
    q.awaitTermination()
    late = spark.read.parquet(f"{scratch}/late").collect()
    assert [(r.order_id, r.status) for r in late] == [(1, "delivered")]
    assert spark.read.parquet(f"{scratch}/on").count() == 2


def test_validated_append_quarantines(spark, scratch):
    src = f"{scratch}/v"
    _write_lines(src, "a.json", [_click(1), json.dumps({"event_id": "e-2", "event_type": "view"}), "[1]"])
    for _ in range(2):  # a rerun over the same checkpoint adds nothing
        B.validated_append(B.text_stream(spark, src), "clickstream_events", f"{scratch}/ok", f"{scratch}/q",
                           f"{scratch}/ck", schema=CLICKSTREAM_SCHEMA, trigger={"availableNow": True}
                           ).awaitTermination()
    ok = spark.read.parquet(f"{scratch}/ok").collect()
    assert [r.event_id for r in ok] == ["e-1"]
    q = sorted(r.error for r in spark.read.parquet(f"{scratch}/q").collect())
    assert q == ["expected an object", "missing required fields ['user_id']"]


def test_interval_semi_join_stream(spark, scratch):
    a, b = f"{scratch}/sa", f"{scratch}/sb"
    _write_lines(a, "a.json", [json.dumps({"id": i, "ts": f"2026-06-11T10:{i:02d}:00Z"}) for i in range(0, 60, 5)])
    _write_lines(b, "b.json", [json.dumps({"fts": f"2026-06-11T10:{i:02d}:10Z"}) for i in (11, 12, 13, 40)])
    left = spark.readStream.format("json").schema("id int, ts timestamp").load(a)
    right = spark.readStream.format("json").schema("fts timestamp").load(b)
    from strata.streaming.runner import run_available
    got = sorted(r.id for r in run_available(ST.interval_semi_join_stream(left, "ts", right, "fts", 120,
                                                                          "10 minutes", "10 minutes"),
                                             spark, "semi").collect())
    assert got == [10, 15, 40]


def test_upsert_log_compaction(spark, scratch):
    src = f"{scratch}/u"
    _write_lines(src, "1.json", [json.dumps({"k": 1, "v": 1}), json.dumps({"k": 2, "v": 1})])
    _write_lines(src, "2.json", [json.dumps({"k": 1, "v": 5})])
    raw = spark.readStream.format("json").schema("k int, v int").option("maxFilesPerTrigger", 1).load(src)
    agg = raw.groupBy("k").agg(F.max("v").alias("v"))
    ST.upsert_log(agg, f"{scratch}/log", f"{scratch}/ck").awaitTermination()
    snap = ST.compact_upsert_log(spark, f"{scratch}/log", ["k"], f"{scratch}/snap")
    _write_lines(src, "3.json", [json.dumps({"k": 2, "v": 9})])
    ST.upsert_log(agg, f"{scratch}/log", f"{scratch}/ck").awaitTermination()
    state = {r.k: r.v for r in ST.read_upsert_log(spark, f"{scratch}/log", ["k"], snapshot=snap).collect()}
    assert state == {1: 5, 2: 9}
    assert state == {r.k: r.v for r in ST.read_upsert_log(spark, f"{scratch}/log", ["k"]).collect()}


def test_rows_to_insert(spark):
    from strata.operators import keyed as K
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    incoming = spark.createDataFrame([(1, "x"), (2, "c"), (2, "b")], "id int, v string")
    assert [(r.id, r.v) for r in K.rows_to_insert(target, incoming, ["id"], ["v"]).collect()] == [(2, "b")]


def test_dedup_across_micro_batches(spark, scratch):
    src = f"{scratch}/d"
    rows = lambda ids: [json.dumps({"event_id": i, "ts": f"2026-06-11T10:{i:02d}:00Z"}) for i in ids]
    _write_lines(src, "1.json", rows([1, 2, 3]))
    _write_lines(src, "2.json", rows([2, 3, 4]))       # repeats in a later micro-batch
    _write_lines(src, "3.json", rows([4, 5]))
    raw = spark.readStream.format("json").schema("event_id int, ts timestamp") \
        .option("maxFilesPerTrigger", 1).load(src)
    from strata.streaming.runner import run_available
    out = run_available(ST.dedup_stream(raw, ["event_id"], "ts", "1 hour"), spark, "dedup")
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 3, 4, 5]


def test_processing_time_trigger_runs(spark, scratch):
    src, out, ckpt = f"{scratch}/pt", f"{scratch}/pt_out", f"{scratch}/pt_ck"
    _write_lines(src, "a.json", [_click(1)])
    q = B.append_stream(B.json_bronze(B.text_stream(spark, src), CLICKSTREAM_SCHEMA), ckpt, path=out,
                        trigger={"processingTime": "1 second"}, query_name="pt_clicks")
    try:
        q.processAllAvailable()
        assert q.isActive and q.name == "pt_clicks"
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == 1


def test_stream_reconcile_matches_batch(spark, scratch):
    from strata.operators import reconcile as R
    o_dir, s_dir = f"{scratch}/o", f"{scratch}/s"
    _write_lines(o_dir, "1.json", [json.dumps({"order_id": k}) for k in ["o-1", "o-2", "o-2", ""]])
    _write_lines(o_dir, "2.json", [json.dumps({"order_id": k}) for k in ["o-3", "o-1"]])
    _write_lines(s_dir, "1.json", [json.dumps({"order_id": k}) for k in ["o-1"]])
    _write_lines(s_dir, "2.json", [json.dumps({"order_id": k}) for k in ["o-3", "o-9", ""]])
    read = lambda d: spark.readStream.format("json").schema("order_id string").option(
        "maxFilesPerTrigger", 1).load(d)
    rows = ST.reconcile_rows(read(o_dir), read(s_dir), "order_id", "order_id")
    ST.count_log(rows, f"{scratch}/rlog", f"{scratch}/rck").awaitTermination()
    got = ST.reconcile_report_from_log(spark, f"{scratch}/rlog").first().asDict()
    batch = lambda d: spark.read.schema("order_id string").json(d)
    exp = R.reconcile_report(batch(o_dir), batch(s_dir)).first().asDict()
    assert got == exp and exp["matched_orders"] == 3 and exp["total_orders"] == 6


def test_run_until_any_ends(spark, scratch):
    a, b = f"{scratch}/ra", f"{scratch}/rb"
    _write_lines(a, "a.json", [_click(1)])
    _write_lines(b, "b.json", [_click(2)])
    done = B.append_stream(B.json_bronze(B.text_stream(spark, a), CLICKSTREAM_SCHEMA), f"{scratch}/cka",
                           path=f"{scratch}/oa", trigger={"availableNow": True}, query_name="ends_first")
    running = B.append_stream(B.json_bronze(B.text_stream(spark, b), CLICKSTREAM_SCHEMA), f"{scratch}/ckb",
                              path=f"{scratch}/ob", trigger={"processingTime": "1 second"}, query_name="keeps_going")
    ended = B.run_until_any_ends(spark, [done, running], timeout_s=60)
    assert ended is not None and ended.name == "ends_first"
    assert not running.isActive


def test_windowed_counts_on_timestamp_column(spark, scratch):
    src = f"{scratch}/w"
    _write_lines(src, "a.json", [json.dumps({"svc": "api", "ts": f"2026-06-11T10:{m:02d}:00Z"}) for m in (1, 2, 14)])
    raw = spark.readStream.format("json").schema("svc string, ts timestamp").load(src)
    counts = ST.windowed_counts(raw, "ts", "1 hour", "10 minutes", None, [F.col("svc")],
                                [F.count(F.lit(1)).alias("n")])
    ST.upsert_log(counts, f"{scratch}/wlog", f"{scratch}/wck").awaitTermination()
    state = ST.read_upsert_log(spark, f"{scratch}/wlog", ["svc", "window_start"])
    assert state.schema["window_start"].dataType.simpleString() == "timestamp"
    assert sorted(r.n for r in state.collect()) == [1, 2]


def test_sessions_stream_emits_closed_sessions(spark, scratch):
    from strata.operators import keyed as K
    src = f"{scratch}/sess"
    first = [(1, "2026-06-11T10:00:00Z"), (1, "2026-06-11T10:10:00Z"), (1, "2026-06-11T11:00:00Z"),
             (2, "2026-06-11T10:05:00Z")]
    _write_lines(src, "1.json", [json.dumps({"u": u, "ts": t}) for u, t in first])
    _write_lines(src, "2.json", [json.dumps({"u": 3, "ts": "2026-06-11T18:00:00Z"})])  # moves the watermark
    raw = spark.readStream.format("json").schema("u int, ts timestamp").option("maxFilesPerTrigger", 1).load(src)
    from strata.streaming.runner import run_available
    out = run_available(ST.sessions_stream(raw, ["u"], "ts", "30 minutes", "1 hour"), spark, "sess")
    got = sorted((r.u, str(r.session_start), r.events) for r in out.collect())
    batch = spark.read.schema("u int, ts timestamp").json(f"{src}/1.json").withColumn("id", F.col("u"))
    exp_rows = K.sessionize(batch, ["u"], "ts", ["id"], 1800).groupBy("u", "session_start").count().collect()
    assert got == sorted((r.u, str(r.session_start), r["count"]) for r in exp_rows)
    assert len(got) == 3


def test_windowed_state_is_evicted_behind_the_watermark(spark, scratch):
    src = f"{scratch}/late_w"
    _write_lines(src, "1.json", [json.dumps({"svc": "api", "ts": "2026-06-11T10:01:00Z"})])
    _write_lines(src, "2.json", [json.dumps({"svc": "api", "ts": "2026-06-11T12:30:00Z"})])  # watermark -> 11:30
    _write_lines(src, "3.json", [json.dumps({"svc": "api", "ts": "2026-06-11T12:31:00Z"})])
    raw = spark.readStream.format("json").schema("svc string, ts timestamp").option("maxFilesPerTrigger", 1).load(src)
    counts = ST.windowed_counts(raw, "ts", "1 hour", "10 minutes", None, [F.col("svc")],
                                [F.count(F.lit(1)).alias("n")])
    q = ST.upsert_log(counts, f"{scratch}/lw_log", f"{scratch}/lw_ck")
    q.awaitTermination()
    # once the watermark passed 10:10, the 10:00 window left the state store:
    # only the 12:30 window is still held
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1
    state = {str(r.window_start)[11:16]: r.n for r in
             ST.read_upsert_log(spark, f"{scratch}/lw_log", ["svc", "window_start"]).collect()}
    assert state == {"10:00": 1, "12:30": 2}


def test_run_bronze_streams_to_paths(spark, scratch):
    clicks, logs = f"{scratch}/pc", f"{scratch}/pl"
    _write_lines(clicks, "c.json", [_click(1), _click(2)])
    _write_lines(logs, "l.txt", ["2026-06-11T10:00:00Z 10.0.0.1 api-gateway GET /home 504 2999ms"])
    qs = B.run_bronze_streams(spark, [B.BronzeSource("clicks", B.text_stream(spark, clicks), CLICKSTREAM_SCHEMA),
                                      B.BronzeSource("logs", B.text_stream(spark, logs))],
                              f"{scratch}/pout", f"{scratch}/pck", trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination()
    assert spark.read.parquet(f"{scratch}/pout/clicks").count() == 2
    row = spark.read.parquet(f"{scratch}/pout/logs").first()
    assert (row.status_code, row.latency_ms, row._ingested_at is not None) == (504, 2999, True)


def test_late_router_needs_the_mark_of_the_batch_before(spark, scratch):
    import os

    import pytest
    src = f"{scratch}/ship2"
    _write_lines(src, "1.json", [json.dumps({"order_id": 1, "status": "shipped", "ts": "2026-06-11T10:00:00Z"})])
    raw = spark.readStream.format("json").schema("order_id int, status string, ts timestamp").load(src)

    def run():
        ST.late_router(raw, "ts", 3600, f"{scratch}/on2", f"{scratch}/late2", f"{scratch}/marks2",
                       f"{scratch}/ck2").awaitTermination()

    run()
    marks = f"{scratch}/marks2/batch_id=0"
    for name in os.listdir(marks):
        if name.endswith(".parquet"):
            with open(f"{marks}/{name}", "wb") as fh:
                fh.write(b"not parquet")
        elif name.endswith(".crc"):
            os.remove(f"{marks}/{name}")
    _write_lines(src, "2.json", [json.dumps({"order_id": 1, "status": "late", "ts": "2026-06-11T01:00:00Z"})])
    with pytest.raises(Exception):
        run()
