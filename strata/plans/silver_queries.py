"""Silver queries: flattening and document normalisation over order documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import jobs
from strata.functions import flatten as FL
from strata.operators import normalize as N
from strata.plans import derive as D
from strata.plans.registry import register
from strata.schemas import BRONZE_SCHEMAS
from strata.session import scratch_path
from strata.sinks import files as sinks
from strata.sources.tables import read_table
from strata.streaming import bronze as B


def _order_docs(spark, sf_dir, ragged=False):
    return D.order_documents(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"),
                             read_table(spark, sf_dir, "nation"), ragged=ragged)


@register("flatten_struct", sql=f"""
SELECT o_orderkey AS order_id, o_orderstatus AS status, o_orderpriority AS priority,
  o_totalprice AS total, strftime(o_orderdate, '%Y-%m-%d') AS placed_at,
  o_orderkey % 3 AS "AVOIDED", o_orderkey % 5 AS "VOID", o_orderkey AS {D.DEEP_NAME},
  c_custkey AS customer_key, CASE WHEN o_orderkey % 11 <> 0 THEN c_name END AS customer_name, c_mktsegment AS customer_segment,
  CAST(CASE WHEN c_custkey IS NOT NULL THEN c_nationkey END AS BIGINT) AS customer_nation_key,
  n_name AS customer_nation_name,
  CAST(to_json([o_orderpriority, o_orderstatus]) AS VARCHAR) AS tags
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def q_flatten_struct(spark, sf_dir):
    """P7 wide form: nested order documents to one column per leaf path."""
    flat = FL.flatten_json(_order_docs(spark, sf_dir), "doc")
    return flat.select(
        "order_id", "status", "priority", F.col("total").cast("double").alias("total"), "placed_at",
        "AVOIDED", "VOID", D.DEEP_NAME,
        "customer_key", "customer_name", "customer_segment", "customer_nation_key", "customer_nation_name",
        F.to_json("tags").alias("tags"))


_RAGGED_SQL = f"""
WITH o AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate, o_custkey, c_custkey, c_name,
         c_mktsegment, c_nationkey, n_name
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT o_orderkey AS order_id, key, value FROM (
  SELECT o_orderkey, 'order_id' AS key, CAST(o_orderkey AS VARCHAR) AS value FROM o
  UNION ALL SELECT o_orderkey, 'status', o_orderstatus FROM o
  UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM o
  UNION ALL SELECT o_orderkey, 'placed_at', strftime(o_orderdate, '%Y-%m-%d') FROM o
  UNION ALL SELECT o_orderkey, 'tags', CAST(to_json([o_orderpriority, o_orderstatus]) AS VARCHAR) FROM o
  UNION ALL SELECT o_orderkey, 'customer', CAST(o_custkey AS VARCHAR) FROM o WHERE o_orderkey % 5 = 0
  UNION ALL SELECT o_orderkey, 'customer_key', CAST(c_custkey AS VARCHAR) FROM o
    WHERE o_orderkey % 5 <> 0 AND c_custkey IS NOT NULL
  UNION ALL SELECT o_orderkey, 'customer_name', CASE WHEN o_orderkey % 11 <> 0 THEN c_name END FROM o
    WHERE o_orderkey % 11 = 0 OR (o_orderkey % 5 <> 0 AND c_custkey IS NOT NULL)
  UNION ALL SELECT o_orderkey, 'AVOIDED', CAST(o_orderkey % 3 AS VARCHAR) FROM o
  UNION ALL SELECT o_orderkey, 'VOID', CAST(o_orderkey % 5 AS VARCHAR) FROM o
  UNION ALL SELECT o_orderkey, '{D.DEEP_NAME}', CAST(o_orderkey AS VARCHAR) FROM o
  UNION ALL SELECT o_orderkey, 'customer_segment', c_mktsegment FROM o
    WHERE o_orderkey % 5 <> 0 AND c_custkey IS NOT NULL
  UNION ALL SELECT o_orderkey, 'customer_nation_key', CAST(c_nationkey AS VARCHAR) FROM o
    WHERE o_orderkey % 5 <> 0 AND c_custkey IS NOT NULL AND c_nationkey IS NOT NULL
  UNION ALL SELECT o_orderkey, 'customer_nation_name', n_name FROM o
    WHERE o_orderkey % 5 <> 0 AND c_custkey IS NOT NULL AND n_name IS NOT NULL)
"""


@register("flatten_ragged", sql=_RAGGED_SQL)
def q_flatten_ragged(spark, sf_dir):
    """P7 ragged form: ``customer`` is an object in some records and a scalar
    in others; records become flat maps, shown here as (order, key, value)."""
    flat = FL.flatten_ragged(_order_docs(spark, sf_dir, ragged=True), "doc", keep=("src_id",))
    kv = flat.select(F.col("src_id").alias("order_id"), F.explode("record").alias("key", "v"))
    return kv.select("order_id", "key", F.col("v").cast("string").alias("value"))


# The shape of the batch documents' records: with it, no job looks for names first.
BATCH_SHAPE = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("status", T.StringType()),
                            T.StructField("customer_key", T.LongType()), T.StructField("source_name", T.StringType())])


@register("normalize_metadata", sql="""
WITH o AS (
  SELECT *, o_orderkey // 100 AS b,
         row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS pos
  FROM orders)
SELECT CASE b % 3 WHEN 0 THEN 'shipments_shipping_' || b WHEN 1 THEN 'orders_orders_' || b
            ELSE 'orders_web_orders_' || b END AS dataset,
       CASE WHEN b % 3 = 0 THEN 'shipping' WHEN b % 3 = 1 THEN 'orders'
            WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'web' END AS source_name,
       CAST(pos AS BIGINT) AS record_index, o_orderkey AS order_id, o_orderstatus AS status,
       o_custkey AS customer_key, CAST(NULL AS VARCHAR) AS value
FROM o
UNION ALL
SELECT 'orders_orders_' || b, 'orders', CAST(count(*) AS BIGINT), NULL, NULL, NULL, CAST(b AS VARCHAR)
FROM o WHERE b % 3 = 1 GROUP BY b
""")
def q_normalize_metadata(spark, sf_dir):
    """Bronze documents (lists, wrapped shipments, scalars) to silver
    records with source name, record index and dataset."""
    docs = D.order_batch_documents(read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_custkey"))
    docs = docs.withColumn("dataset", N.dataset_from_path(F.col("path"), "bronze"))
    out = N.normalize(docs, None, doc_col="doc", keep=("dataset",), path_col="path", schema=BATCH_SHAPE)
    return out.select("dataset", "source_name", "record_index", "order_id", "status", "customer_key",
                      F.col("value").cast("string").alias("value"))


@register("silver_folder", sql="""
SELECT 'orders' AS dataset, 'orders' AS source_name, o_orderkey AS order_id, o_custkey AS customer_key,
       CAST(NULL AS VARCHAR) AS event_id, false AS quarantined
FROM orders
UNION ALL
SELECT 'clicks', CASE WHEN event_id % 17 <> 0 THEN 'clicks' END, NULL, NULL,
       CASE WHEN event_id % 17 <> 0 THEN 'e-' || event_id END, event_id % 17 = 0
FROM events
""")
def q_silver_folder(spark, sf_dir):
    """Orders and click lines land raw, the folder job makes silver
    of the landing; truncated lines go to quarantine."""
    base = scratch_path(spark, "silver-folder")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(
        F.col("o_orderkey").alias("order_id"), F.struct(F.col("o_custkey").alias("key")).alias("customer"))
    sinks.write_raw(orders, f"{base}/bronze", "orders", "run-1")
    lines = D.clickstream_json(read_table(spark, sf_dir, "events"))
    lines.select("value").write.text(f"{base}/bronze/source=clicks/ingest_date=2024-01-01/run_id=run-1")
    jobs.silver_folder_job(spark, f"{base}/bronze", f"{base}/silver")
    good = spark.read.parquet(f"{base}/silver").select(
        "dataset", "source_name", "order_id", "customer_key", "event_id", F.lit(False).alias("quarantined"))
    bad = spark.read.parquet(f"{base}/silver/{jobs.QUARANTINE}").select(
        "dataset", F.lit(None).cast("string").alias("source_name"), F.lit(None).cast("bigint").alias("order_id"),
        F.lit(None).cast("bigint").alias("customer_key"), F.lit(None).cast("string").alias("event_id"),
        F.lit(True).alias("quarantined"))
    return good.unionByName(bad)


@register("single_objects", sql="""
SELECT 'order_' || o_orderkey AS dataset, 'order' AS source_name, CAST(0 AS BIGINT) AS record_index,
       o_orderkey AS order_id, o_custkey AS customer_key
FROM orders
""")
def q_single_objects(spark, sf_dir):
    """Documents that are one bare object, the dataset from the file's stem."""
    docs = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(
        F.concat(F.lit("bronze/order_"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("path"),
        F.to_json(F.struct(F.col("o_orderkey").alias("order_id"),
                           F.struct(F.col("o_custkey").alias("key")).alias("customer"))).alias("doc"))
    docs = docs.withColumn("dataset", N.file_stem(F.col("path")))
    out = N.normalize(docs, None, keep=("dataset",), schema=BATCH_SHAPE)
    return out.select("dataset", "source_name", "record_index", "order_id", "customer_key")


@register("object_records", sql="""
SELECT o_orderkey // 100 AS batch, o_orderkey AS order_id FROM orders WHERE o_orderkey // 100 % 3 <> 0
UNION ALL
SELECT DISTINCT o_orderkey // 100, CAST(NULL AS BIGINT) FROM orders WHERE o_orderkey // 100 % 3 = 0
""")
def q_object_records(spark, sf_dir):
    """The object records of every batch document; scalars go, and a
    wrapped list is the one object that holds it."""
    docs = D.order_batch_documents(read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_custkey"))
    records = N.object_records(docs, keep=("path",))
    return records.select(F.regexp_extract("path", r"_(\d+)\.json$", 1).cast("bigint").alias("batch"),
                          F.try_variant_get("record", "$.order_id", "bigint").alias("order_id"))


# The bounded pull takes so many messages of each topic: its documented feature.
MAX_MESSAGES = 5


@register("run_summary", sql=f"""
SELECT 'kafka_topics' AS source_kind, CAST(2 AS BIGINT) AS sources,
       CAST((SELECT least({MAX_MESSAGES}, count(*)) FROM events) AS BIGINT) AS "rows"
UNION ALL
SELECT 'postgres_tables', 3, (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer)
UNION ALL
SELECT 'api_payloads', 1, (SELECT count(*) FROM lineitem)
""")
def q_run_summary(spark, sf_dir):
    """One bounded bronze pull with an empty topic and an empty table, and its summary."""
    clicks = D.clickstream_json(read_table(spark, sf_dir, "events")).select("value")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return jobs.run_bronze_batch(
        spark, scratch_path(spark, "run-summary"), {"clickstream_events": clicks, "server_logs": clicks.where(F.lit(False))},
        {"orders": orders, "users": read_table(spark, sf_dir, "customer", "c_custkey", "c_name"),
         "products": orders.where(F.lit(False))},
        {"shipping_payload": read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")}, MAX_MESSAGES)


# What the bronze tables hold, in SQL: column, type and when a record has a value.
_BRONZE_SQL = """
SELECT source, CAST(position AS INTEGER) AS position, name, type, CAST(count(*) FILTER (filled) AS BIGINT) AS filled FROM (
  SELECT 'clickstream_events' AS source, c.* FROM events, LATERAL (VALUES
    (1, 'event_id', 'string', true), (2, 'event_time', 'string', true), (3, 'user_id', 'int', event_id % 23 <> 0),
    (4, 'session_id', 'string', true), (5, 'event_type', 'string', true), (6, 'product_id', 'int', true),
    (7, 'category', 'string', event_id % 7 <> 0), (8, 'device_type', 'string', false), (9, 'country', 'string', true),
    (10, 'price', 'double', true), (11, 'quantity', 'int', event_type = 'purchase'), (12, '_ingested_at', 'timestamp', true)
  ) c(position, name, type, filled)
  UNION ALL
  SELECT 'order_changes', c.* FROM orders, LATERAL (VALUES
    (1, 'order_id', 'int', true), (2, 'user_id', 'int', true), (3, 'product_id', 'int', o_orderkey % 5 <> 0),
    (4, 'quantity', 'int', true), (5, 'total_amount', 'double', true), (6, 'order_status', 'string', true),
    (7, 'payment_status', 'string', o_orderkey % 3 <> 0), (8, 'order_placed_at', 'string', true), (9, '_ingested_at', 'timestamp', true)
  ) c(position, name, type, filled)
  UNION ALL
  SELECT 'shipment_data', c.* FROM lineitem, LATERAL (VALUES
    (1, 'order_id', 'int', true), (2, 'carrier', 'string', true), (3, 'tracking_number', 'string', true), (4, 'status', 'string', true),
    (5, 'status_last_updated_at', 'string', l_linenumber % 2 = 0), (6, 'events', 'array<struct<event:string,time:string>>', true),
    (7, '_ingested_at', 'timestamp', true)
  ) c(position, name, type, filled)
  UNION ALL
  SELECT 'server_logs', c.* FROM events, LATERAL (VALUES
    (1, 'timestamp', 'string', true), (2, 'ip', 'string', true), (3, 'service', 'string', true), (4, 'method', 'string', event_id % 2 = 0),
    (5, 'path', 'string', true), (6, 'status_code', 'int', true), (7, 'latency_ms', 'int', true), (8, '_ingested_at', 'timestamp', true)
  ) c(position, name, type, filled)
) GROUP BY ALL
"""


def _bronze_messages(spark, sf_dir):
    """JSON messages of every bronze source, some without a field."""
    events = read_table(spark, sf_dir, "events")
    eid, product = F.col("event_id"), D.product_id(events)
    clicks = F.struct(
        eid.cast("string").alias("event_id"), F.col("ts").cast("string").alias("event_time"),
        F.when(eid % 23 != 0, F.col("user_id")).alias("user_id"),
        F.concat(F.lit("s-"), eid).alias("session_id"), "event_type", product.alias("product_id"),
        F.when(eid % 7 != 0, F.concat(F.lit("c-"), product)).alias("category"), F.lit("C1").alias("country"),
        F.col("value").alias("price"), F.when(F.col("event_type") == "purchase", F.lit(1)).alias("quantity"))
    logs = F.struct(
        F.col("ts").cast("string").alias("timestamp"), F.lit("10.0.0.1").alias("ip"), D.log_service(F.col("event_type")).alias("service"),
        F.when(eid % 2 == 0, F.lit("GET")).alias("method"), D.log_path(F.col("event_type")).alias("path"),
        F.lit(200).alias("status_code"), (eid % 900).cast("int").alias("latency_ms"))
    key = F.col("o_orderkey")
    orders = F.struct(
        key.alias("order_id"), F.col("o_custkey").alias("user_id"), F.when(key % 5 != 0, key % 100).alias("product_id"),
        (key % 7).alias("quantity"), F.col("o_totalprice").alias("total_amount"), F.col("o_orderstatus").alias("order_status"),
        F.when(key % 3 != 0, F.lit("PAID")).alias("payment_status"), F.col("o_orderdate").cast("string").alias("order_placed_at"))
    line = F.col("l_linenumber")
    ships = F.struct(
        F.col("l_orderkey").alias("order_id"), F.concat(F.lit("carrier-"), F.col("l_suppkey") % 4).alias("carrier"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("tracking_number"), F.col("l_linestatus").alias("status"),
        F.when(line % 2 == 0, F.col("l_shipdate").cast("string")).alias("status_last_updated_at"),
        F.array(F.struct(F.lit("DELIVERED").alias("event"), F.col("l_shipdate").cast("string").alias("time"))).alias("events"))
    return {"clickstream_events": events.select(F.to_json(clicks).alias("value")),
            "order_changes": read_table(spark, sf_dir, "orders").select(F.to_json(orders).alias("value")),
            "shipment_data": read_table(spark, sf_dir, "lineitem").select(F.to_json(ships).alias("value")),
            "server_logs": events.select(F.to_json(logs).alias("value"))}


@register("bronze_columns", sql=_BRONZE_SQL)
def q_bronze_columns(spark, sf_dir):
    """Every bronze table is created from its schema's DDL, the parsed
    messages land in it, and its columns are listed with the number of
    records that have a value."""
    base = scratch_path(spark, "bronze-columns")
    parts = []
    for source, raw in _bronze_messages(spark, sf_dir).items():
        table = B.ensure_table(spark, f"strata_columns.{source}_{base.rsplit('-', 1)[-1]}", BRONZE_SCHEMAS[source], f"{base}/{source}")
        shape = spark.table(table).schema
        spark.sql(f"DROP TABLE {table}")  # the files of an external table stay
        B.json_bronze(raw, BRONZE_SCHEMAS[source], drop_malformed=False).select(*shape.names).write.mode("append").parquet(f"{base}/{source}")
        rows = spark.read.schema(shape).parquet(f"{base}/{source}")
        columns = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                                     F.count(f"`{f.name}`").alias("filled")) for i, f in enumerate(shape, 1)])
        parts.append(rows.agg(columns.alias("c")).select(F.lit(source).alias("source"), F.explode("c").alias("c")).select("source", "c.*"))
    return reduce(DataFrame.unionByName, parts)


ORDERS_PER_FILE = 1000


@register("silver_increments", sql=f"""
WITH o AS (
  SELECT o_orderkey // {ORDERS_PER_FILE} AS file, o_orderkey, o_orderstatus, o_custkey,
         row_number() OVER (PARTITION BY o_orderkey // {ORDERS_PER_FILE} ORDER BY o_orderkey) - 1 AS pos
  FROM orders)
SELECT file, CAST(file % 2 AS INTEGER) AS run, CAST(pos AS BIGINT) AS record_index, o_orderkey AS order_id, o_orderstatus AS status,
       o_custkey AS customer_key, file % 3 = 0 AS unwrapped, false AS quarantined
FROM o WHERE file % 5 <> 4
UNION ALL
SELECT DISTINCT file, CAST(file % 2 AS INTEGER), CAST(NULL AS BIGINT), NULL, NULL, NULL, NULL, true FROM o WHERE file % 5 = 4
""")
def q_silver_increments(spark, sf_dir):
    """Whole, indented JSON documents in nested folders, some of
    them cut off, come in two arrivals; each run of the folder job reads the
    new files only and appends records and quarantine."""
    file = F.expr(f"o_orderkey div {ORDERS_PER_FILE}")
    record = F.struct(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
                      F.struct(F.col("o_custkey").alias("key")).alias("customer"))
    # A file holds a bounded number of orders.
    docs = (read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_custkey").groupBy(file.alias("file"))
            .agg(F.sort_array(F.collect_list(record)).alias("records")))
    pretty = {"pretty": "true"}
    text = F.when(F.col("file") % 3 == 0, F.to_json(F.struct(F.col("records").alias("shipments")), pretty)).otherwise(F.to_json("records", pretty))
    docs = docs.select("file", (F.col("file") % 2).cast("int").alias("arrival"), (F.col("file") % 10).alias("shelf"), text.alias("doc"))
    docs = docs.withColumn("doc", F.when(F.col("file") % 5 == 4, F.expr("left(doc, char_length(doc) div 2)")).otherwise(F.col("doc")))
    base = scratch_path(spark, "silver-increments")
    arrived = f"{base}/arrivals"
    docs.repartition("file").write.parquet(arrived)
    for run in range(2):
        new = spark.read.parquet(arrived).where(F.col("arrival") == run).drop("arrival")
        new.repartition("file").write.mode("append").partitionBy("shelf", "file").text(f"{base}/bronze")
        jobs.silver_stream_job(spark, f"{base}/bronze", f"{base}/silver", f"{base}/checkpoint", BATCH_SHAPE, glob="part-*")
    number = F.regexp_extract("dataset", r"file=(\d+)_", 1).cast("bigint")
    good = jobs.read_silver(spark, f"{base}/silver").select(
        number.alias("file"), F.col("batch_id").cast("int").alias("run"), "record_index", "order_id", "status", "customer_key",
        (F.col("source_name") == "shipping").alias("unwrapped"), F.lit(False).alias("quarantined"))
    bad = jobs.read_quarantine(spark, f"{base}/silver").select(
        number.alias("file"), F.col("batch_id").cast("int").alias("run"), F.lit(True).alias("quarantined"))
    return good.unionByName(bad, allowMissingColumns=True)
