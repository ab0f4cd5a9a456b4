import json
import os

import pytest

from strata import jobs
from strata.operators import marts as M
from strata.sources import files, jdbc


def test_bronze_batch_summary(spark, scratch):
    topics = {
        "clickstream_events": spark.createDataFrame([(f'{{"event_id":"e-{i}"}}',) for i in range(10)], "value string"),
        "server_logs": spark.createDataFrame([("line",)], "value string"),
    }
    tables = {name: spark.createDataFrame([(1, "Ada")], "id int, name string")
              for name in ("users", "products", "orders")}
    payloads = {"shipping_payload": spark.createDataFrame([("s-1", "o-1", "shipped")],
                                                          "shipment_id string, order_id string, status string")}
    summary = {r.source_kind: r for r in jobs.run_bronze_batch(spark, f"{scratch}/raw", topics, tables, payloads,
                                                              max_messages=3).collect()}
    assert summary["kafka_topics"].sources == 2 and summary["kafka_topics"].rows == 4
    assert summary["postgres_tables"].sources == 3 and summary["postgres_tables"].rows == 3
    assert summary["api_payloads"].rows == 1
    assert os.path.isdir(f"{scratch}/raw/source=clickstream_events")


def test_shipping_payload_and_carrier_latency(spark, scratch):
    os.makedirs(f"{scratch}/api")
    payload = {"generated_at": "2026-06-11T10:00:00Z", "shipments": [
        {"order_id": 1, "carrier": "UPS", "tracking_number": "T1", "status": "DELIVERED",
         "events": [{"event": "PICKED_UP", "time": "2026-06-10T00:00:00Z"},
                    {"event": "DELIVERED", "time": "2026-06-12T00:00:00Z"}]},
        {"order_id": 2, "carrier": "UPS", "tracking_number": "T2", "status": "IN_TRANSIT",
         "events": [{"event": "PICKED_UP", "time": "2026-06-10T00:00:00Z"}]}]}
    with open(f"{scratch}/api/shipping_1.json", "w") as fh:
        json.dump(payload, fh)
    with open(f"{scratch}/api/empty_2.json", "w") as fh:
        json.dump({"generated_at": "x"}, fh)
    ships = files.read_shipping_payload(spark, f"{scratch}/api")
    assert ships.count() == 2
    from pyspark.sql import functions as F
    ev = ships.select(F.try_variant_get("shipment", "$.carrier", "string").alias("carrier"),
                      F.try_variant_get("shipment", "$.tracking_number", "string").alias("tracking_number"),
                      F.explode(F.try_variant_get("shipment", "$.events",
                                                  "array<struct<event string, time string>>")).alias("e"))
    ev = ev.select("carrier", "tracking_number", "e.event", F.to_timestamp("e.time").alias("time"))
    r = M.carrier_latency(ev).first()
    assert (r.carrier, r.delivered, r.open, r.avg_latency) == ("UPS", 1, 1, 2.0)


def test_jdbc_options_allow_list():
    opts = jdbc.jdbc_options("jdbc:postgresql://db/shop", "orders", "order_id", 0, 100, 4)
    assert opts["numPartitions"] == "4" and opts["partitionColumn"] == "order_id"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "orders; DROP TABLE users", None)


def test_list_objects(spark, scratch):
    os.makedirs(f"{scratch}/objs/a")
    for name in ("a/1.json", "2.json"):
        with open(f"{scratch}/objs/{name}", "w") as fh:
            fh.write("{}")
    paths = sorted(r.path.split("/objs/")[1] for r in files.list_objects(spark, f"{scratch}/objs").collect())
    assert paths == ["2.json", "a/1.json"]
    assert files.list_objects(spark, f"{scratch}/none").count() == 0


def test_gold_job_writes_report(spark, scratch):
    orders = spark.createDataFrame([("o-1",), ("o-2",), ("o-2",)], "order_id string")
    ships = spark.createDataFrame([("o-1",)], "order_id string")
    out = jobs.gold_reconcile_job(orders, ships, f"{scratch}/gold")
    rep = spark.read.json(out["report"]).first()
    assert rep.matched_orders == 1 and rep.total_orders == 3
    assert [r.order_id for r in spark.read.parquet(out["missing_shipments"]).collect()] == ["o-2"]


def test_bronze_batch_counts_only_this_run(spark, scratch):
    topics = {"clickstream_events": spark.createDataFrame([("a",), ("b",)], "value string")}
    for _ in range(2):
        s = {r.source_kind: r for r in jobs.run_bronze_batch(spark, f"{scratch}/raw2", topics, {}).collect()}
        assert s["kafka_topics"].rows == 2


def test_bucketed_tables_reconcile_without_key_shuffle(spark, scratch):
    from pyspark.sql import functions as F

    from strata.operators import reconcile as R
    from strata.sinks import files as sinks
    spark.sql("CREATE NAMESPACE IF NOT EXISTS silver")
    orders = spark.range(2000).select((F.col("id") % 1500).alias("order_id"))
    ships = spark.range(1000).select(F.col("id").alias("order_id"))
    sinks.write_bucketed(orders, "silver.orders_b", ["order_id"], 8, f"{scratch}/ob")
    sinks.write_bucketed(ships, "silver.ships_b", ["order_id"], 8, f"{scratch}/sb")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rep = R.reconcile_report(spark.table("silver.orders_b"), spark.table("silver.ships_b"))
        plan = rep._jdf.queryExecution().executedPlan().toString()
        r = rep.first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE silver.orders_b")
        spark.sql("DROP TABLE silver.ships_b")
    assert "hashpartitioning" not in plan  # co-located: only the final single-row exchange
    assert (r.total_orders, r.unique_orders, r.matched_unique_orders) == (2000, 1499, 999)


def test_bronze_batch_with_empty_sources(spark, scratch):
    empty = spark.createDataFrame([], "value string")
    summary = {r.source_kind: (r.sources, r.rows) for r in jobs.run_bronze_batch(
        spark, f"{scratch}/raw0", {"clicks": empty}, {"users": empty}).collect()}
    assert summary == {"kafka_topics": (1, 0), "postgres_tables": (1, 0)}


def test_session_without_shared_folder_fails_on_a_cluster(monkeypatch):
    from strata import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
