"""The README quick start, end to end on local folders."""

import json
import os

from strata import jobs
from strata.operators import contracts, reconcile
from strata.schemas import CLICKSTREAM_SCHEMA
from strata.streaming import bronze


def test_quick_start_flow(spark, scratch):
    os.makedirs(f"{scratch}/landing/clickstream")
    with open(f"{scratch}/landing/clickstream/a.json", "w") as fh:
        fh.write(json.dumps({"event_id": "e-1", "event_type": "view", "user_id": 7}) + "\n")
    raw = bronze.text_stream(spark, f"{scratch}/landing/clickstream")
    q = bronze.append_stream(bronze.json_bronze(raw, CLICKSTREAM_SCHEMA), f"{scratch}/ckpt/clicks",
                             path=f"{scratch}/bronze/clickstream_events", trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.read.parquet(f"{scratch}/bronze/clickstream_events").first().user_id == 7

    os.makedirs(f"{scratch}/landing/orders")
    with open(f"{scratch}/landing/orders/o.json", "w") as fh:
        fh.write('{"order_id": 1, "order_status": "PLACED", "order_placed_at": "2026-06-11"}\n{"order_id": 2}\n')
    checked = contracts.validate(spark.read.text(f"{scratch}/landing/orders"), "order_changes")
    assert checked.valid.count() == 1 and checked.quarantine.count() == 1

    os.makedirs(f"{scratch}/raw")
    with open(f"{scratch}/raw/orders.json", "w") as fh:
        json.dump([{"order_id": "o-1"}, {"order_id": "o-2"}, {"order_id": "o-2"}], fh)
    with open(f"{scratch}/raw/shipping_1.json", "w") as fh:
        json.dump({"shipments": [{"order_id": "o-1", "status": "shipped"}]}, fh)
    jobs.silver_folder_job(spark, f"{scratch}/raw", f"{scratch}/silver")
    orders = spark.read.parquet(f"{scratch}/silver/dataset=orders")
    shipments = spark.read.parquet(f"{scratch}/silver/dataset=shipping_1")
    out = jobs.gold_reconcile_job(orders, shipments, f"{scratch}/gold")
    rep = spark.read.json(out["report"]).first()
    assert (rep.total_orders, rep.matched_orders, rep.missing_shipments, rep.duplicate_orders) == (3, 1, 1, 1)
    assert reconcile.reconcile_report(orders, shipments).first().reconciliation_rate == 1 / 3
