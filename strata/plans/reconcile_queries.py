"""Reconciliation queries: orders against line items as the shipment feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import reconcile as R
from strata.plans import derive as D
from strata.plans.registry import register
from strata.sources.tables import read_table

def _orders(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "order_id")


def _shipments(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "order_id")


def _stray_shipments(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    return D.stray_shipments(lines).select(F.col("l_orderkey").alias("order_id"))


# The same feed in SQL.
STRAY_SQL = """SELECT CASE WHEN l_orderkey % 50 = 7 AND l_linenumber = 1 THEN -l_orderkey ELSE l_orderkey END AS k
FROM lineitem"""


@register("reconcile_report", sql="""
WITH per_key AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY o_orderkey),
ship AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey <> 0),
flagged AS (
  SELECT p.k, p.n, s.k IS NOT NULL AS hit, (p.k IS NOT NULL AND p.k <> 0) AS valid
  FROM per_key p LEFT JOIN ship s ON p.k = s.k)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_orders,
       CAST(count(*) FILTER (WHERE valid) AS BIGINT) AS unique_orders,
       CAST(coalesce(sum(n) FILTER (WHERE valid AND hit), 0) AS BIGINT) AS matched_orders,
       CAST(count(*) FILTER (WHERE valid AND hit) AS BIGINT) AS matched_unique_orders,
       CAST(count(*) FILTER (WHERE valid AND NOT hit) AS BIGINT) AS missing_shipments,
       CAST(count(*) FILTER (WHERE valid AND n > 1) AS BIGINT) AS duplicate_orders,
       CASE WHEN coalesce(sum(n), 0) = 0 THEN 0.0
            ELSE CAST(coalesce(sum(n) FILTER (WHERE valid AND hit), 0) AS DOUBLE) / CAST(sum(n) AS DOUBLE)
       END AS reconciliation_rate
FROM flagged
""")
def q_reconcile_report(spark, sf_dir):
    return R.reconcile_report(_orders(spark, sf_dir), _shipments(spark, sf_dir))


@register("reconcile_lines", sql="""
WITH per_key AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY l_orderkey),
ship AS (SELECT DISTINCT o_orderkey AS k FROM orders
         WHERE o_orderkey IS NOT NULL AND o_orderkey <> 0 AND o_orderstatus <> 'P'),
flagged AS (
  SELECT p.k, p.n, s.k IS NOT NULL AS hit, (p.k IS NOT NULL AND p.k <> 0) AS valid
  FROM per_key p LEFT JOIN ship s ON p.k = s.k)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_orders,
       CAST(count(*) FILTER (WHERE valid) AS BIGINT) AS unique_orders,
       CAST(coalesce(sum(n) FILTER (WHERE valid AND hit), 0) AS BIGINT) AS matched_orders,
       CAST(count(*) FILTER (WHERE valid AND hit) AS BIGINT) AS matched_unique_orders,
       CAST(count(*) FILTER (WHERE valid AND NOT hit) AS BIGINT) AS missing_shipments,
       CAST(count(*) FILTER (WHERE valid AND n > 1) AS BIGINT) AS duplicate_orders,
       CASE WHEN coalesce(sum(n), 0) = 0 THEN 0.0
            ELSE CAST(coalesce(sum(n) FILTER (WHERE valid AND hit), 0) AS DOUBLE) / CAST(sum(n) AS DOUBLE)
       END AS reconciliation_rate
FROM flagged
""")
def q_reconcile_lines(spark, sf_dir):
    """Line items as the order side (many rows per key), every order as a
    confirmation, where a pending order ('P') confirms no key yet (null):
    exercises null keys, duplicates and the row-versus-key difference of the
    rate."""
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey")
    confirmed = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("o_orderkey"))
    return R.reconcile_report(lines, confirmed, order_key="l_orderkey", shipment_key="o_orderkey")


@register("matched_orders", sql="""
SELECT o_orderkey AS order_id, o_custkey, o_totalprice, o_orderdate
FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey <> 0)
""")
def q_matched_orders(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("order_id", "o_custkey", "o_totalprice", "o_orderdate")
    return R.matched_orders(orders, _shipments(spark, sf_dir))


@register("missing_shipments", sql="""
SELECT DISTINCT o_orderkey AS order_id FROM orders
WHERE o_orderkey IS NOT NULL AND o_orderkey <> 0
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def q_missing_shipments(spark, sf_dir):
    return R.missing_shipments(_orders(spark, sf_dir), _shipments(spark, sf_dir))


@register("orphan_shipments", sql=f"""
SELECT k AS order_id, CAST(count(*) AS BIGINT) AS shipment_rows FROM ({STRAY_SQL})
WHERE k IS NOT NULL AND k <> 0 AND k NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
GROUP BY k
""")
def q_orphan_shipments(spark, sf_dir):
    """B12 on a feed in which some shipments name an order that does not exist."""
    return R.orphan_shipments(_orders(spark, sf_dir), _stray_shipments(spark, sf_dir))


@register("missing_and_duplicate_ids", sql="""
SELECT 'missing_shipment' AS kind, o_orderkey AS order_id FROM orders
WHERE o_orderkey IS NOT NULL AND o_orderkey <> 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL
SELECT 'duplicate_order', o_orderkey FROM (
  SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 41 = 0)
WHERE o_orderkey <> 0 GROUP BY o_orderkey HAVING count(*) > 1
""")
def q_missing_and_duplicate_ids(spark, sf_dir):
    """The id lists as one sorted table; every 41st order arrives twice."""
    orders = _orders(spark, sf_dir).select("order_id").withColumn("copy", F.explode(
        F.when(F.col("order_id") % 41 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return R.id_table(R.reconcile(orders, _shipments(spark, sf_dir)))


@register("duplicate_orders", sql="""
SELECT l_orderkey AS order_id, CAST(count(*) AS BIGINT) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_orderkey <> 0
GROUP BY l_orderkey HAVING count(*) > 1
""")
def q_duplicate_orders(spark, sf_dir):
    """A3 with line items as the order side (many rows per order key)."""
    return R.duplicate_orders(read_table(spark, sf_dir, "lineitem", "l_orderkey"), "l_orderkey")
