from pyspark.sql import functions as F

from strata.operators import reconcile as R


def _ids(spark, values, name="order_id", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")


def test_reference_vector(spark):
    orders = spark.createDataFrame([("o-1", "paid"), ("o-2", "paid"), ("o-2", "paid")],
                                   "order_id string, status string")
    shipments = spark.createDataFrame([("o-1", "shipped")], "order_id string, status string")
    rec = R.reconcile(orders, shipments)
    r = rec.report.first()
    assert r.matched_orders == 1
    assert r.total_orders == 3 and r.unique_orders == 2
    assert abs(r.reconciliation_rate - 1 / 3) < 1e-12
    assert [x.order_id for x in rec.missing.collect()] == ["o-2"]
    assert [x.order_id for x in rec.duplicates.collect()] == ["o-2"]
    lists = R.id_list_report(rec, max_ids=10).first()
    assert lists.missing_shipment_ids == ["o-2"] and lists.duplicate_order_ids == ["o-2"]


def test_falsy_keys_count_in_total_only(spark):
    orders = _ids(spark, [None, "", "a"])
    shipments = _ids(spark, ["a", ""])
    r = R.reconcile_report(orders, shipments).first()
    assert (r.total_orders, r.unique_orders, r.matched_orders, r.missing_shipments) == (3, 1, 1, 0)
    num = _ids(spark, [0, 0, 5], dtype="bigint")
    r = R.reconcile_report(num, _ids(spark, [5, 0], dtype="bigint")).first()
    assert (r.total_orders, r.unique_orders, r.matched_orders, r.duplicate_orders) == (3, 1, 1, 0)
    r = R.reconcile_report(num, _ids(spark, [5, 0], dtype="bigint"), zero_is_missing=False).first()
    assert (r.unique_orders, r.matched_orders, r.duplicate_orders) == (2, 3, 1)


def test_empty_orders(spark):
    r = R.reconcile_report(_ids(spark, []), _ids(spark, ["a"])).first()
    assert (r.total_orders, r.unique_orders, r.matched_orders) == (0, 0, 0)
    assert r.reconciliation_rate == 0.0


def test_duplicate_matched_rows(spark):
    orders = _ids(spark, ["k", "k"])
    rec = R.reconcile(orders, _ids(spark, ["k"]))
    r = rec.report.first()
    assert r.matched_orders == 2 and r.matched_unique_orders == 1
    assert rec.duplicates.count() == 1


def test_orphans_and_key_types(spark):
    orders = _ids(spark, [1, 2], dtype="int")
    shipments = _ids(spark, [2, 3, 3], dtype="bigint")
    rows = R.orphan_shipments(orders, shipments).collect()
    assert [(x.order_id, x.shipment_rows) for x in rows] == [(3, 2)]
    matched = R.matched_orders(orders.withColumn("x", F.lit(1)), shipments).collect()
    assert [x.order_id for x in matched] == [2]


def test_plan_has_two_exchanges_before_final_agg(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = spark.range(1000).select(F.col("id").alias("order_id"))
        ships = spark.range(500).select(F.col("id").alias("order_id"))
        plan = R.reconcile_report(orders, ships)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # two hash exchanges on the key + one single-partition exchange for the total
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Exchange SinglePartition") == 1
