"""Order-versus-shipment reconciliation.

Plan shape of :func:`reconcile_report` (checked with ``explain``):

    orders  -> partial count by key -> Exchange hash(key) -> final count --+
                                                                           +-> join on key -> global agg
    shipments -> partial distinct    -> Exchange hash(key) -> final distinct +

Both join inputs come out of an aggregate hash-partitioned on the key, so the
join needs no further exchange; the only other exchange is the single-row
global aggregate. Keys are unique on both sides at join time, so a hot key
(one order id on a third of all rows) is folded map-side by the partial
aggregates and never reaches the join as skew. Id lists stay tables
(:func:`missing_shipments`, :func:`duplicate_orders`) instead of arrays
collected on one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import comparable_key, truthy_key

KEY = "order_id"


def _sides(orders: DataFrame, order_key: str, shipments: DataFrame, shipment_key: str,
           zero_is_missing: bool) -> tuple[DataFrame, DataFrame]:
    """The key columns of both sides in comparable form; shipments with a present key only."""
    o = orders.select(comparable_key(orders, order_key, shipments, shipment_key, zero_is_missing).alias(KEY))
    s = shipments.select(comparable_key(shipments, shipment_key, orders, order_key, zero_is_missing).alias(KEY))
    return o, s.where(truthy_key(s, KEY, zero_is_missing))


def _shipment_keys(orders: DataFrame, order_key: str, shipments: DataFrame,
                   shipment_key: str, zero_is_missing: bool) -> tuple[DataFrame, DataFrame]:
    o, s = _sides(orders, order_key, shipments, shipment_key, zero_is_missing)
    return o, s.distinct()


def reconcile_report(orders: DataFrame, shipments: DataFrame, order_key: str = KEY,
                     shipment_key: str | None = None, zero_is_missing: bool = True) -> DataFrame:
    """One-row report: totals, matches, missing and duplicate counts, rate.

    ``total_orders`` counts every order row, keyed or not (A1);
    ``unique_orders`` counts distinct present keys (A2); ``matched_orders``
    counts keyed order rows whose key has a shipment (J1, rows not keys);
    ``missing_shipments`` and ``duplicate_orders`` count keys (J2, A3);
    ``reconciliation_rate`` = matched rows / all rows, 0.0 when empty (A4).
    ``matched_unique_orders`` (keys with a shipment) is our addition.
    """
    shipment_key = shipment_key or order_key
    o, s = _shipment_keys(orders, order_key, shipments, shipment_key, zero_is_missing)
    per_key = o.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    flagged = per_key.join(s.withColumn("_hit", F.lit(True)), KEY, "left")
    valid = truthy_key(flagged, KEY, zero_is_missing)
    hit = F.col("_hit").isNotNull()
    agg = flagged.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.count(F.when(valid, True)).alias("unique_orders"),
        F.coalesce(F.sum(F.when(valid & hit, F.col("n"))), F.lit(0)).cast("bigint").alias("matched_orders"),
        F.count(F.when(valid & hit, True)).alias("matched_unique_orders"),
        F.count(F.when(valid & ~hit, True)).alias("missing_shipments"),
        F.count(F.when(valid & (F.col("n") > 1), True)).alias("duplicate_orders"),
    )
    rate = F.coalesce(F.try_divide(F.col("matched_orders").cast("double"),
                                   F.col("total_orders").cast("double")), F.lit(0.0))
    return agg.withColumn("reconciliation_rate", rate)


def matched_orders(orders: DataFrame, shipments: DataFrame, order_key: str = KEY,
                   shipment_key: str | None = None, zero_is_missing: bool = True) -> DataFrame:
    """Order rows (duplicates kept) whose key has a shipment (semi join)."""
    shipment_key = shipment_key or order_key
    _, s = _shipment_keys(orders, order_key, shipments, shipment_key, zero_is_missing)
    keyed = orders.withColumn("_k", comparable_key(orders, order_key, shipments, shipment_key, zero_is_missing))
    out = keyed.join(s.withColumnRenamed(KEY, "_k"), "_k", "left_semi")
    return out.drop("_k")


def missing_shipments(orders: DataFrame, shipments: DataFrame, order_key: str = KEY,
                      shipment_key: str | None = None, zero_is_missing: bool = True) -> DataFrame:
    """Distinct present order keys with no shipment (anti join)."""
    shipment_key = shipment_key or order_key
    o, s = _shipment_keys(orders, order_key, shipments, shipment_key, zero_is_missing)
    o = o.where(truthy_key(o, KEY, zero_is_missing)).distinct()
    return o.join(s, KEY, "left_anti")


def orphan_shipments(orders: DataFrame, shipments: DataFrame, order_key: str = KEY,
                     shipment_key: str | None = None, zero_is_missing: bool = True) -> DataFrame:
    """Distinct shipment keys with no order, with their row counts."""
    shipment_key = shipment_key or order_key
    o, s = _sides(orders, order_key, shipments, shipment_key, zero_is_missing)
    s = s.groupBy(KEY).agg(F.count(F.lit(1)).alias("shipment_rows"))
    o = o.distinct()
    return s.join(o, KEY, "left_anti")


def duplicate_orders(orders: DataFrame, order_key: str = KEY, zero_is_missing: bool = True) -> DataFrame:
    """A3: present keys that occur on more than one order row, with the count."""
    o = orders.select(F.col(order_key).alias(KEY))
    o = o.where(truthy_key(o, KEY, zero_is_missing))
    return (o.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def key_counts(orders: DataFrame, shipments: DataFrame, order_key: str = KEY,
               shipment_key: str | None = None, zero_is_missing: bool = True) -> DataFrame:
    """Per key: order rows ``n_orders`` and shipment rows ``n_shipments``.

    One full outer join of two partial aggregates (each side shuffled once on
    the key, unique keys at join time). Keys that do not count as present
    (P16) are kept on the order side only, under their own value, so
    ``total_orders`` still counts their rows. Every reconciliation output
    derives from this one table.
    """
    shipment_key = shipment_key or order_key
    o, s = _sides(orders, order_key, shipments, shipment_key, zero_is_missing)
    o = o.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_orders"))
    s = s.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_shipments"))
    joined = o.join(s, KEY, "full")
    return joined.withColumn("present", truthy_key(joined, KEY, zero_is_missing) & F.col("n_orders").isNotNull())


def report_from_counts(counts: DataFrame) -> DataFrame:
    """The one-row report of :func:`reconcile_report` from :func:`key_counts`."""
    valid, hit = F.col("present"), F.col("n_shipments").isNotNull()
    agg = counts.agg(
        F.coalesce(F.sum("n_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.count(F.when(valid, True)).alias("unique_orders"),
        F.coalesce(F.sum(F.when(valid & hit, F.col("n_orders"))), F.lit(0)).cast("bigint").alias("matched_orders"),
        F.count(F.when(valid & hit, True)).alias("matched_unique_orders"),
        F.count(F.when(valid & ~hit, True)).alias("missing_shipments"),
        F.count(F.when(valid & (F.col("n_orders") > 1), True)).alias("duplicate_orders"),
    )
    rate = F.coalesce(F.try_divide(F.col("matched_orders").cast("double"),
                                   F.col("total_orders").cast("double")), F.lit(0.0))
    return agg.withColumn("reconciliation_rate", rate)


@dataclass
class Reconciliation:
    report: DataFrame
    missing: DataFrame
    duplicates: DataFrame
    orphans: DataFrame


def from_counts(counts: DataFrame) -> Reconciliation:
    """All outputs from one :func:`key_counts` table (read it from storage
    once when several outputs are written, so the inputs are scanned once)."""
    return Reconciliation(
        report=report_from_counts(counts),
        missing=counts.where(F.col("present") & F.col("n_shipments").isNull()).select(KEY),
        duplicates=counts.where(F.col("present") & (F.col("n_orders") > 1))
        .select(KEY, F.col("n_orders").alias("n")),
        orphans=counts.where(F.col("n_orders").isNull()).select(KEY, F.col("n_shipments").alias("shipment_rows")),
    )


def key_findings(counts: DataFrame) -> DataFrame:
    """Every finding of the per-key table in one pass: ``(kind, order_id, n)``
    for ``missing_shipment`` (n = order rows), ``duplicate_order`` (order key
    on several order rows), ``orphan_shipment`` (n = shipment rows) and
    ``duplicate_shipment`` (several shipment rows for one key).

    One projection with an ``explode`` of a short array per key, so the
    inputs behind ``counts`` are scanned and joined once whatever the kinds.
    """
    present, n_o, n_s = F.col("present"), F.col("n_orders"), F.col("n_shipments")

    def item(cond, kind, n):
        return F.when(cond, F.struct(F.lit(kind).alias("kind"), n.cast("bigint").alias("n")))

    items = F.array(
        item(present & n_s.isNull(), "missing_shipment", n_o),
        item(present & (n_o > 1), "duplicate_order", n_o),
        item(n_o.isNull(), "orphan_shipment", n_s),
        item(n_s > 1, "duplicate_shipment", n_s),
    )
    found = counts.select(KEY, F.explode(F.filter(items, lambda x: x.isNotNull())).alias("f"))
    return found.select(F.col("f.kind").alias("kind"), KEY, F.col("f.n").alias("n"))


def reconcile(orders: DataFrame, shipments: DataFrame, order_key: str = KEY,
              shipment_key: str | None = None, zero_is_missing: bool = True) -> Reconciliation:
    """E5 without files: the report plus the id tables behind its counts."""
    return from_counts(key_counts(orders, shipments, order_key, shipment_key, zero_is_missing))


def id_table(rec: Reconciliation) -> DataFrame:
    """The missing and duplicate ids as one sorted table ``(kind, order_id)``.

    A range-partitioned sort: no array and no single task holds the lists.
    """
    tagged = (rec.missing.select(F.lit("missing_shipment").alias("kind"), KEY)
              .unionByName(rec.duplicates.select(F.lit("duplicate_order").alias("kind"), KEY)))
    return tagged.orderBy("kind", KEY)


def id_list_report(rec: Reconciliation, max_ids: int) -> DataFrame:
    """The small-report option (A6): the two sorted id arrays in one row.

    Only for reports a person reads: the arrays are built on one task, so
    the real list sizes are checked against ``max_ids`` first and the call
    fails rather than truncating.
    """
    counts = rec.report.select("missing_shipments", "duplicate_orders").first()
    if max(counts["missing_shipments"], counts["duplicate_orders"]) > max_ids:
        raise ValueError("id lists exceed max_ids; read Reconciliation.missing / .duplicates as tables")
    tagged = (rec.missing.select(F.lit("missing").alias("_tag"), KEY)
              .unionByName(rec.duplicates.select(F.lit("duplicate").alias("_tag"), KEY)))
    return tagged.agg(
        F.sort_array(F.collect_list(F.when(F.col("_tag") == "missing", F.col(KEY))))
        .alias("missing_shipment_ids"),
        F.sort_array(F.collect_list(F.when(F.col("_tag") == "duplicate", F.col(KEY))))
        .alias("duplicate_order_ids"),
    )
