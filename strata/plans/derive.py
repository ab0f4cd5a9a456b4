"""Bronze-shaped inputs derived from the driver tables.

The driver tables are typed parquet; the operators under test take raw
JSON text, log lines and nested documents. These derivations build such
raw inputs from every row of a table with JVM-side expressions (narrow
projections, no shuffle), deterministically from the row's own columns,
so a DuckDB oracle can compute the expected parsed values from the same
base columns independently. Variations (broken lines, missing or retyped
fields) are chosen by the row's id, never by sampling, and no row is
dropped: every input row ends up in exactly one raw record (one per row,
or one bounded document of up to 100 orders).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ISO-8601 forms used in the raw records.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _q(c: Column) -> Column:
    """A JSON string literal of a column (values here need no escaping)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def product_id(events: DataFrame) -> Column:
    return F.get_json_object(events["props"], "$.k").cast("int")


def clickstream_json(events: DataFrame) -> DataFrame:
    """One clickstream JSON document per event (P2 input).

    Every 17th event id is truncated mid-document (malformed); every 23rd
    carries ``user_id`` as a quoted string (a field of the wrong type).
    """
    eid = F.col("event_id")
    uid = F.when(eid % 23 == 0, _q(F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string"))
    device = F.when(eid % 3 == 0, "mobile").when(eid % 3 == 1, "desktop").otherwise("tablet")
    qty = F.when(F.col("event_type") == "purchase", eid % 3 + 1).otherwise(F.lit(0))
    doc = F.concat(
        F.lit('{"event_id":'), _q(F.concat(F.lit("e-"), eid.cast("string"))),
        F.lit(',"event_time":'), _q(F.date_format("ts", ISO_MICROS)),
        F.lit(',"user_id":'), uid,
        F.lit(',"session_id":'), _q(F.concat(F.lit("s-"), eid.cast("string"))),
        F.lit(',"event_type":'), _q(F.col("event_type")),
        F.lit(',"product_id":'), product_id(events).cast("string"),
        F.lit(',"category":'), _q(F.concat(F.lit("cat-"), (product_id(events) % 7).cast("string"))),
        F.lit(',"device_type":'), _q(device),
        F.lit(',"country":'), _q(F.concat(F.lit("C"), (F.col("user_id") % 20).cast("string"))),
        F.lit(',"price":'), F.col("value").cast("string"),
        F.lit(',"quantity":'), qty.cast("string"),
        F.lit("}"),
    )
    value = F.when(eid % 17 == 0, F.substring(doc, 1, 40)).otherwise(doc)
    return events.select("event_id", value.alias("value"))


def log_service(event_type: Column) -> Column:
    return (F.when(event_type == "click", "catalog-service")
            .when(event_type == "view", "api-gateway")
            .when(event_type == "purchase", "checkout-service")
            .when(event_type == "signup", "api-gateway")
            .otherwise("payment-service"))


def log_path(event_type: Column) -> Column:
    return (F.when(event_type == "click", "/search")
            .when(event_type == "view", "/product")
            .when(event_type == "purchase", "/checkout")
            .when(event_type == "signup", "/home")
            .otherwise("/checkout"))


def log_status(eid: Column, event_type: Column) -> Column:
    """Error events fail (500 / 504); the rest mostly succeed."""
    ok = (F.when(eid % 8 == 0, F.lit("404")).when(eid % 8 == 1, F.lit("400"))
          .when(eid % 8 == 2, F.lit("201")).otherwise(F.lit("200")))
    failing = F.when(eid % 2 == 0, F.lit("500")).otherwise(F.lit("504"))
    status = F.when(event_type == "error", failing).otherwise(ok)
    # An 11-digit status still matches the pattern; its int cast gives null.
    return F.when(eid % 101 == 5, F.lit("20000000000")).otherwise(status)


def server_log_lines(events: DataFrame) -> DataFrame:
    """One access-log line per event (P4-P6 input).

    Every 34th event id gets a leading blank and every 34th + 17 a latency
    in seconds: neither matches the pattern, so they go to quarantine.
    """
    eid, et = F.col("event_id"), F.col("event_type")
    ip = F.concat_ws(".", F.lit("10"), (eid % 200).cast("string"), (F.col("user_id") % 250).cast("string"),
                     (eid * 7 % 250 + 1).cast("string"))
    method = F.when(eid % 3 == 0, "GET").when(eid % 3 == 1, "POST").otherwise("PUT")
    latency = (F.floor(F.col("value") * 100) % 2990 + 10).cast("bigint").cast("string")
    unit = F.when(eid % 34 == 17, F.lit("s")).otherwise(F.lit("ms"))
    line = F.concat_ws(" ", F.date_format("ts", ISO_SECONDS), ip, log_service(et), method, log_path(et),
                       log_status(eid, et), F.concat(latency, unit))
    line = F.when(eid % 34 == 0, F.concat(F.lit(" "), line)).otherwise(line)
    return events.select("event_id", line.alias("value"))


def contract_records(events: DataFrame) -> DataFrame:
    """One raw clickstream record per event for the contract check (V2-V7).

    Variation by ``event_id % 10``: 1 drops user_id; 2 quotes it; 3 makes it
    fractional; 4 empties event_type; 5 quotes amount; 6 sets ts to null;
    7 makes event_id a number; 8 wraps the record in an array; 0 sets
    user_id to true; 9 adds an unknown field.
    """
    eid = F.col("event_id")
    m = eid % 10
    uid = F.col("user_id").cast("string")
    user = (F.when(m == 1, F.lit(None))
            .when(m == 2, _q(uid))
            .when(m == 3, F.concat(uid, F.lit(".5")))
            .when(m == 0, F.lit("true"))
            .otherwise(uid))
    event_id = F.when(m == 7, eid.cast("string")).otherwise(_q(F.concat(F.lit("e-"), eid.cast("string"))))
    event_type = F.when(m == 4, F.lit('""')).otherwise(_q(F.col("event_type")))
    amount = F.when(m == 5, _q(F.col("value").cast("string"))).otherwise(F.col("value").cast("string"))
    parts = F.concat(
        F.lit('{"event_id":'), event_id,
        F.lit(',"event_type":'), event_type,
        F.coalesce(F.concat(F.lit(',"user_id":'), user), F.lit("")),
        F.lit(',"event_time":'), _q(F.date_format("ts", ISO_MICROS)),
        F.when(m == 6, F.lit(',"ts":null')).otherwise(F.lit("")),
        F.lit(',"amount":'), amount,
        F.when(m == 9, F.lit(',"extra":{"k":1}')).otherwise(F.lit("")),
        F.lit("}"),
    )
    value = F.when(m == 8, F.concat(F.lit("["), parts, F.lit("]"))).otherwise(parts)
    return events.select("event_id", value.alias("value"))


def stray_shipments(lineitem: DataFrame) -> DataFrame:
    """Line items as a shipment feed in which some rows name an order that
    does not exist: the first line of every order key that leaves 7 modulo 50
    carries the negative key. No row is dropped."""
    k = F.col("l_orderkey")
    stray = (k % 50 == 7) & (F.col("l_linenumber") == 1)
    return lineitem.withColumn("l_orderkey", F.when(stray, -k).otherwise(k))


DEEP_LEVELS = 10
DEEP_NAME = "deep" + "_a" * DEEP_LEVELS


def order_documents(orders: DataFrame, customer: DataFrame, nation: DataFrame, ragged: bool = False) -> DataFrame:
    """One nested JSON order document per order (P7 input).

    ``{"order_id", "status", "priority", "total", "placed_at",
    "customer": {"key", "name", "segment", "nation": {"key", "name"}},
    "meta": {}, "tags": [priority, status]}`` and, at the end, keys that look
    like type names (``AVOIDED``, ``VOID``), an object nested ten levels deep
    and, in every 11th order, ``"customer_name": null``, which clashes with the
    nested name and comes later. With ``ragged`` every 5th order carries
    ``customer`` as the bare customer key (a scalar where other records hold
    an object) and no ``total``.
    """
    cust = customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey").join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey", "left")
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
                      "o_orderdate")
    joined = o.join(cust, o["o_custkey"] == cust["c_custkey"], "left")
    customer_obj = F.when(F.col("c_custkey").isNotNull(), F.struct(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.struct(F.col("c_nationkey").alias("key"), F.col("n_name").alias("name")).alias("nation")))

    def body(customer_value: Column, with_total: bool) -> Column:
        fields = [F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
                  F.col("o_orderpriority").alias("priority")]
        if with_total:
            fields.append(F.col("o_totalprice").alias("total"))
        fields += [F.date_format("o_orderdate", "yyyy-MM-dd").alias("placed_at"),
                   customer_value.alias("customer"),
                   F.array(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("tags")]
        return F.to_json(F.struct(*fields))

    if ragged:
        doc = F.when(F.col("o_orderkey") % 5 == 0, body(F.col("o_custkey"), False)) \
            .otherwise(body(customer_obj, False))
    else:
        doc = body(customer_obj, True)
    # An empty object, which flattening must drop, and the keys that end the document.
    k = F.col("o_orderkey")
    tail = F.concat(F.lit(',"meta":{},"AVOIDED":'), (k % 3).cast("string"), F.lit(',"VOID":'), (k % 5).cast("string"),
                    F.lit(',"deep":' + '{"a":' * DEEP_LEVELS), k.cast("string"), F.lit("}" * DEEP_LEVELS),
                    F.when(k % 11 == 0, F.lit(',"customer_name":null')).otherwise(F.lit("")), F.lit("}"))
    doc = F.concat(F.substring(doc, F.lit(1), F.char_length(doc) - 1), tail)
    return joined.select(F.col("o_orderkey").alias("src_id"), doc.alias("doc"))


ORDERS_PER_DOCUMENT = 100


def order_batch_documents(orders: DataFrame) -> DataFrame:
    """Bronze files built from orders: ``ORDERS_PER_DOCUMENT`` orders each.

    Orders are grouped by ``o_orderkey div 100``; the key is unique, so every
    group holds at most 100 rows whatever the data size (the arrays built
    per group are bounded by construction). Batch ``b``:

    * ``b % 3 == 0``: ``{"shipments": [...]}`` at ``bronze/shipments/shipping_<b>.json``
    * ``b % 3 == 1``: ``[..., b]`` (a trailing scalar) at ``bronze/orders/orders_<b>.json``
    * ``b % 3 == 2``: ``[...]`` at ``bronze/orders/web_orders_<b>.json``, where
      every 7th order carries ``"source_name": null``

    Records are ``{"order_id", "status", "customer": {"key"}}`` in key order.
    """
    k = F.col("o_orderkey")
    b = F.floor(k / ORDERS_PER_DOCUMENT).cast("bigint")
    rec = F.concat(
        F.lit('{"order_id":'), k.cast("string"),
        F.lit(',"status":"'), F.col("o_orderstatus"), F.lit('"'),
        F.lit(',"customer":{"key":'), F.col("o_custkey").cast("string"), F.lit("}"),
        F.when((b % 3 == 2) & (k % 7 == 0), F.lit(',"source_name":null')).otherwise(F.lit("")),
        F.lit("}"))
    grouped = (orders.select(b.alias("batch"), k.alias("k"), rec.alias("rec"))
               .groupBy("batch")
               .agg(F.sort_array(F.collect_list(F.struct("k", "rec"))).alias("items")))
    body = F.array_join(F.transform("items", lambda x: x["rec"]), ",")
    bb = F.col("batch")
    doc = (F.when(bb % 3 == 0, F.concat(F.lit('{"shipments":['), body, F.lit("]}")))
           .when(bb % 3 == 1, F.concat(F.lit("["), body, F.lit(","), bb.cast("string"), F.lit("]")))
           .otherwise(F.concat(F.lit("["), body, F.lit("]"))))
    path = (F.when(bb % 3 == 0, F.concat(F.lit("bronze/shipments/shipping_"), bb.cast("string"), F.lit(".json")))
            .when(bb % 3 == 1, F.concat(F.lit("bronze/orders/orders_"), bb.cast("string"), F.lit(".json")))
            .otherwise(F.concat(F.lit("bronze/orders/web_orders_"), bb.cast("string"), F.lit(".json"))))
    return grouped.select(path.alias("path"), doc.alias("doc"))
