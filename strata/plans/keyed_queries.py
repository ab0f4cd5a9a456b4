"""Keyed-table queries: upserts, current state, history, life cycle, dedup,
constraint and referential checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas as S
from strata.operators import checks as CK
from strata.operators import keyed as K
from strata.plans import derive as D
from strata.plans.registry import register
from strata.sources.tables import read_table

# The target holds orders placed before 1998; the incoming extract covers
# 1997 onwards, so 1997 overlaps and later orders are new.
TARGET_BEFORE = "1998-01-01"
INCOMING_FROM = "1997-01-01"

# Event flow used as the life cycle of a user's event sequence.
EVENT_TRANSITIONS = (
    ("signup", "view"), ("signup", "click"), ("view", "click"), ("view", "purchase"),
    ("click", "view"), ("click", "purchase"), ("purchase", "view"), ("purchase", "click"),
    ("error", "view"), ("error", "click"), ("view", "error"), ("click", "error"), ("purchase", "error"),
)


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _changes(spark, sf_dir):
    return read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type", "value")


@register("insert_if_absent", sql=f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate FROM orders
WHERE o_orderdate < TIMESTAMP '{TARGET_BEFORE}'
UNION ALL
SELECT o_orderkey, o_custkey, 'N' AS o_orderstatus, o_orderpriority, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '{TARGET_BEFORE}'
""")
def q_insert_if_absent(spark, sf_dir):
    """The incoming extract (every order twice: as 'N' and a '9-DUP'
    copy) is reduced to one row per key and only new keys are inserted."""
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]
    orders = read_table(spark, sf_dir, "orders", *cols)
    target = orders.where(F.col("o_orderdate") < _ts(TARGET_BEFORE))
    extract = orders.where(F.col("o_orderdate") >= _ts(INCOMING_FROM)).withColumn("o_orderstatus", F.lit("N"))
    # each extracted order arrives twice: as is and as a '9-DUP' copy (one scan)
    incoming = extract.withColumn("o_orderpriority", F.explode(F.array(F.col("o_orderpriority"), F.lit("9-DUP"))))
    return K.insert_if_absent(target, incoming, ["o_orderkey"], order=["o_orderpriority"])


@register("keyed_update", sql="""
WITH latest AS (
  SELECT l_orderkey, l_linestatus, l_shipdate FROM (
    SELECT l_orderkey, l_linestatus, l_shipdate,
           row_number() OVER (PARTITION BY l_orderkey
                              ORDER BY l_shipdate DESC, l_linenumber DESC, l_linestatus DESC) AS rn
    FROM lineitem) WHERE rn = 1)
SELECT o_orderkey, coalesce(l_linestatus, o_orderstatus) AS o_orderstatus, o_totalprice,
       l_shipdate AS updated_at
FROM orders LEFT JOIN latest ON o_orderkey = l_orderkey
""")
def q_keyed_update(spark, sf_dir):
    """Each line item is a status change of its order at its ship date;
    the latest change per order updates the order's status."""
    target = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    changes = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linestatus", "l_shipdate", "l_linenumber") \
        .withColumnRenamed("l_orderkey", "o_orderkey")
    return K.apply_changes(target, changes, ["o_orderkey"], ["l_shipdate", "l_linenumber", "l_linestatus"],
                           {"o_orderstatus": "l_linestatus"}, change_time="l_shipdate")


@register("current_state", sql="""
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def q_current_state(spark, sf_dir):
    """Latest event per user (events as a change stream keyed by user)."""
    return K.latest_per_key(_changes(spark, sf_dir), ["user_id"], ["ts", "event_id"])


@register("scd2_history", sql="""
SELECT user_id, ts, event_id, event_type, value, ts AS valid_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM events
""")
def q_scd2_history(spark, sf_dir):
    """Validity intervals of each user's state."""
    return K.scd2_history(_changes(spark, sf_dir), ["user_id"], "ts", ["event_id"])


def _pairs_sql(pairs) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs)


@register("lifecycle_violations", sql=f"""
WITH seq AS (
  SELECT user_id, ts, event_id, event_type, value,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_status,
         lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
  FROM events),
allowed(a, b) AS (VALUES {_pairs_sql(EVENT_TRANSITIONS)})
SELECT * FROM seq
WHERE prev_status IS NOT NULL AND prev_status <> event_type
  AND NOT EXISTS (SELECT 1 FROM allowed WHERE a = prev_status AND b = event_type)
""")
def q_lifecycle_violations(spark, sf_dir):
    """Consecutive event pairs per user outside the allowed flow."""
    return K.transition_violations(_changes(spark, sf_dir), ["user_id"], "ts", ["event_id"], "event_type",
                                   EVENT_TRANSITIONS)


@register("dedup_events", sql="""
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def q_dedup_events(spark, sf_dir):
    """B1: events delivered again (every 5th event a second time, later);
    one row per event id, the first delivery kept."""
    events = read_table(spark, sf_dir, "events")
    # every event delivered once, every 5th a second time (one scan, an explode)
    deliveries = F.when(F.col("event_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    delivered = events.withColumn("_delivery", F.explode(deliveries))
    return K.first_per_key(delivered, ["event_id"], ["_delivery"], few_repeats=True).drop("_delivery")


# Order changes derived from events: one feed of changes per user, with an order and a payment status.
_STATUS_SQL = """CASE event_type WHEN 'signup' THEN 'PLACED' WHEN 'view' THEN 'PLACED' WHEN 'click' THEN 'SHIPPED'
    WHEN 'purchase' THEN 'DELIVERED' ELSE 'CANCELLED' END"""
_PAYMENT_SQL = "CASE WHEN event_id % 3 = 0 THEN 'PAID' WHEN event_id % 3 = 1 THEN 'PENDING' ELSE 'FAILED' END"


def _order_changes(spark, sf_dir):
    kind, eid = F.col("event_type"), F.col("event_id")
    status = (F.when(kind.isin("signup", "view"), "PLACED").when(kind == "click", "SHIPPED")
              .when(kind == "purchase", "DELIVERED").otherwise("CANCELLED"))
    payment = F.when(eid % 3 == 0, "PAID").when(eid % 3 == 1, "PENDING").otherwise("FAILED")
    return read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type").select(
        "user_id", "ts", "event_id", status.alias("order_status"), payment.alias("payment_status"))


@register("order_lifecycle_violations", sql=f"""
WITH c AS (SELECT user_id, ts, event_id, {_STATUS_SQL} AS order_status, {_PAYMENT_SQL} AS payment_status FROM events),
seq AS (
  SELECT *, lag(order_status) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_status,
         lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM c),
allowed(a, b) AS (VALUES {_pairs_sql(S.ORDER_TRANSITIONS)})
SELECT * FROM seq
WHERE prev_status IS NOT NULL AND prev_status <> order_status
  AND (NOT EXISTS (SELECT 1 FROM allowed WHERE a = prev_status AND b = order_status)
       OR (prev_status = 'PLACED' AND payment_status <> 'PAID'))
""")
def q_order_lifecycle_violations(spark, sf_dir):
    """Order status changes outside the life cycle, or away from PLACED before the payment is PAID."""
    return K.transition_violations(_order_changes(spark, sf_dir), ["user_id"], "ts", ["event_id"], "order_status",
                                   S.ORDER_TRANSITIONS, needs={"PLACED": F.col("payment_status") == "PAID"})


@register("payment_lifecycle_violations", sql=f"""
WITH c AS (SELECT user_id, ts, event_id, {_PAYMENT_SQL} AS payment_status FROM events),
seq AS (
  SELECT *, lag(payment_status) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_status,
         lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM c),
allowed(a, b) AS (VALUES {_pairs_sql(S.PAYMENT_TRANSITIONS)})
SELECT * FROM seq
WHERE prev_status IS NOT NULL AND prev_status <> payment_status
  AND NOT EXISTS (SELECT 1 FROM allowed WHERE a = prev_status AND b = payment_status)
""")
def q_payment_lifecycle_violations(spark, sf_dir):
    """Payment status changes outside PENDING to PAID or FAILED."""
    changes = _order_changes(spark, sf_dir).select("user_id", "ts", "event_id", "payment_status")
    return K.transition_violations(changes, ["user_id"], "ts", ["event_id"], "payment_status", S.PAYMENT_TRANSITIONS)


@register("constraint_checks", sql="""
SELECT 'orders' AS "table", 'not_null' AS "check", c AS "column", CAST(v AS BIGINT) AS violations FROM (
  SELECT 'o_orderkey' AS c, count(*) FILTER (WHERE o_orderkey IS NULL) AS v FROM orders
  UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
  UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM orders
  UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders
  UNION ALL SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders)
UNION ALL
SELECT 'orders', 'primary_key', 'o_orderkey', CAST(count(*) AS BIGINT) FROM (
  SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL
SELECT 'lineitem', 'not_null', c, CAST(v AS BIGINT) FROM (
  SELECT 'l_orderkey' AS c, count(*) FILTER (WHERE l_orderkey IS NULL) AS v FROM lineitem
  UNION ALL SELECT 'l_linenumber', count(*) FILTER (WHERE l_linenumber IS NULL) FROM lineitem)
UNION ALL
SELECT 'lineitem', 'primary_key', 'l_orderkey,l_linenumber', CAST(count(*) AS BIGINT) FROM (
  SELECT 1 FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL
SELECT 'customer', 'not_null', 'c_custkey', CAST(count(*) FILTER (WHERE c_custkey IS NULL) AS BIGINT)
FROM customer
UNION ALL
SELECT 'customer', 'not_null', 'c_name', CAST(count(*) FILTER (WHERE c_name IS NULL) AS BIGINT) FROM customer
UNION ALL
SELECT 'customer', 'primary_key', 'c_custkey', CAST(count(*) AS BIGINT) FROM (
  SELECT 1 FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_custkey HAVING count(*) > 1)
UNION ALL
SELECT 'customer', 'unique', 'c_name', CAST(count(*) AS BIGINT) FROM (
  SELECT 1 FROM customer WHERE c_name IS NOT NULL GROUP BY c_name HAVING count(*) > 1)
""")
def q_constraint_checks(spark, sf_dir):
    """C4: primary key, NOT NULL and UNIQUE checks on orders, line items and
    customers (customer name stands in for the unique e-mail)."""
    parts = [
        CK.constraint_report(read_table(spark, sf_dir, "orders"), "orders", ["o_orderkey"],
                             ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]),
        CK.constraint_report(read_table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
        CK.constraint_report(read_table(spark, sf_dir, "customer"), "customer", ["c_custkey"], ["c_name"],
                             unique=[["c_name"]]),
    ]
    return reduce(DataFrame.unionByName, parts)


@register("referential_checks", sql="""
SELECT 'lineitem.l_orderkey->orders' AS relation, l_orderkey AS "key", CAST(count(*) AS BIGINT) AS "rows"
FROM (SELECT CASE WHEN l_orderkey % 50 = 7 AND l_linenumber = 1 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey
      FROM lineitem)
WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders
  WHERE o_orderkey IS NOT NULL) GROUP BY l_orderkey
UNION ALL
SELECT 'lineitem.l_partkey->part', l_partkey, CAST(count(*) AS BIGINT)
FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part
  WHERE p_partkey IS NOT NULL) GROUP BY l_partkey
UNION ALL
SELECT 'lineitem.l_suppkey->supplier', l_suppkey, CAST(count(*) AS BIGINT)
FROM lineitem WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier
  WHERE s_suppkey IS NOT NULL) GROUP BY l_suppkey
UNION ALL
SELECT 'orders.o_custkey->customer', o_custkey, CAST(count(*) AS BIGINT)
FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer
  WHERE c_custkey IS NOT NULL) GROUP BY o_custkey
UNION ALL
SELECT 'events.user_id->customer', user_id, CAST(count(*) AS BIGINT)
FROM (SELECT CASE WHEN event_id % 97 = 3 THEN -user_id - 1 ELSE user_id END AS user_id FROM events)
WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer
  WHERE c_custkey IS NOT NULL) GROUP BY user_id
""")
def q_referential_checks(spark, sf_dir):
    """Foreign keys without a parent row (each child table scanned once).

    Some shipments name an order that does not exist (:func:`D.stray_shipments`)
    and every 97th event a user that does not.
    """
    t = lambda name, *c: read_table(spark, sf_dir, name, *c)
    return CK.orphan_report([
        (D.stray_shipments(t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")), [
            ("l_orderkey", "lineitem.l_orderkey->orders", t("orders", "o_orderkey"), "o_orderkey"),
            ("l_partkey", "lineitem.l_partkey->part", t("part", "p_partkey"), "p_partkey"),
            ("l_suppkey", "lineitem.l_suppkey->supplier", t("supplier", "s_suppkey"), "s_suppkey"),
        ]),
        (t("orders", "o_custkey"), [
            ("o_custkey", "orders.o_custkey->customer", t("customer", "c_custkey"), "c_custkey"),
        ]),
        (t("events", "user_id", "event_id").withColumn("user_id", F.when(
            F.col("event_id") % 97 == 3, -F.col("user_id") - 1).otherwise(F.col("user_id"))), [
            ("user_id", "events.user_id->customer", t("customer", "c_custkey"), "c_custkey"),
        ]),
    ])


@register("duplicate_keys", sql="""
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def q_duplicate_keys(spark, sf_dir):
    """A3 on the line items' composite key (order, line number)."""
    return CK.duplicate_keys(read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber"),
                             ["l_orderkey", "l_linenumber"])
