"""Parsing and contract queries over raw records derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import parse as P
from strata.operators import contracts as C
from strata.plans import derive as D
from strata.plans.registry import register
from strata.schemas import CLICKSTREAM_SCHEMA
from strata.sources.tables import read_table

_LOG_LINE_SQL = """
  concat_ws(' ', strftime(ts, '%Y-%m-%dT%H:%M:%SZ'),
    '10.' || (event_id % 200) || '.' || (user_id % 250) || '.' || (event_id * 7 % 250 + 1),
    CASE event_type WHEN 'click' THEN 'catalog-service' WHEN 'view' THEN 'api-gateway'
         WHEN 'purchase' THEN 'checkout-service' WHEN 'signup' THEN 'api-gateway' ELSE 'payment-service' END,
    CASE event_id % 3 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' ELSE 'PUT' END,
    CASE event_type WHEN 'click' THEN '/search' WHEN 'view' THEN '/product' WHEN 'purchase' THEN '/checkout'
         WHEN 'signup' THEN '/home' ELSE '/checkout' END,
    CASE WHEN event_id % 101 = 5 THEN '20000000000'
         WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN '500' ELSE '504' END
         WHEN event_id % 8 = 0 THEN '404' WHEN event_id % 8 = 1 THEN '400'
         WHEN event_id % 8 = 2 THEN '201' ELSE '200' END,
    CAST(CAST(floor(value * 100) % 2990 + 10 AS BIGINT) AS VARCHAR)
      || CASE WHEN event_id % 34 = 17 THEN 's' ELSE 'ms' END)
"""


def _events(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "events", *cols)


@register("json_parse", sql="""
SELECT event_id AS src_id,
  CASE WHEN m17 THEN NULL ELSE 'e-' || event_id END AS event_id,
  CASE WHEN m17 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS event_time,
  CASE WHEN m17 OR m23 THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_id,
  CASE WHEN m17 THEN NULL ELSE 's-' || event_id END AS session_id,
  CASE WHEN m17 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN m17 THEN NULL ELSE pid END AS product_id,
  CASE WHEN m17 THEN NULL ELSE 'cat-' || (pid % 7) END AS category,
  CASE WHEN m17 THEN NULL WHEN event_id % 3 = 0 THEN 'mobile' WHEN event_id % 3 = 1 THEN 'desktop'
       ELSE 'tablet' END AS device_type,
  CASE WHEN m17 THEN NULL ELSE 'C' || (user_id % 20) END AS country,
  CASE WHEN m17 THEN NULL ELSE value END AS price,
  CASE WHEN m17 THEN NULL WHEN event_type = 'purchase' THEN CAST(event_id % 3 + 1 AS INTEGER)
       ELSE 0 END AS quantity,
  (m17 OR m23) AS _is_malformed
FROM (SELECT *, event_id % 17 = 0 AS m17, event_id % 23 = 0 AS m23,
             CAST(json_extract(props, '$.k') AS INTEGER) AS pid FROM events)
""")
def q_json_parse(spark, sf_dir):
    """Clickstream JSON by the bronze schema, malformed rows flagged."""
    raw = D.clickstream_json(_events(spark, sf_dir)).withColumnRenamed("event_id", "src_id")
    return P.parse_json_columns(raw, CLICKSTREAM_SCHEMA, keep=("src_id",))


@register("log_parse", sql=f"""
SELECT event_id AS src_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
  '10.' || (event_id % 200) || '.' || (user_id % 250) || '.' || (event_id * 7 % 250 + 1) AS ip,
  CASE event_type WHEN 'click' THEN 'catalog-service' WHEN 'view' THEN 'api-gateway'
       WHEN 'purchase' THEN 'checkout-service' WHEN 'signup' THEN 'api-gateway' ELSE 'payment-service' END
    AS service,
  CASE event_id % 3 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' ELSE 'PUT' END AS method,
  CASE event_type WHEN 'click' THEN '/search' WHEN 'view' THEN '/product' WHEN 'purchase' THEN '/checkout'
       WHEN 'signup' THEN '/home' ELSE '/checkout' END AS path,
  CASE WHEN event_id % 101 = 5 THEN NULL
       WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 500 ELSE 504 END
       WHEN event_id % 8 = 0 THEN 404 WHEN event_id % 8 = 1 THEN 400
       WHEN event_id % 8 = 2 THEN 201 ELSE 200 END AS status_code,
  CAST(floor(value * 100) % 2990 + 10 AS INTEGER) AS latency_ms
FROM events
WHERE event_id % 34 NOT IN (0, 17)
""")
def q_log_parse(spark, sf_dir):
    """Access-log lines to seven typed fields; non-matching lines drop."""
    raw = D.server_log_lines(_events(spark, sf_dir)).withColumnRenamed("event_id", "src_id")
    return P.parse_log_lines(raw, keep=("src_id",))


@register("log_quarantine", sql=f"""
SELECT event_id AS src_id,
  CASE WHEN event_id % 34 = 0 THEN ' ' ELSE '' END || {_LOG_LINE_SQL} AS raw_line
FROM events
WHERE event_id % 34 IN (0, 17)
""")
def q_log_quarantine(spark, sf_dir):
    """P6 quarantine: the raw lines that do not match the pattern."""
    raw = D.server_log_lines(_events(spark, sf_dir)).withColumnRenamed("event_id", "src_id")
    _, bad = P.split_log_lines(raw, keep=("src_id",))
    return bad


@register("validate_valid", sql="""
SELECT event_id AS src_id, 'e-' || event_id AS event_id, event_type,
  CASE WHEN m = 0 THEN 'true' ELSE CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN m = 6 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS ts,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time,
  value AS amount
FROM (SELECT *, event_id % 10 AS m FROM events)
WHERE m IN (0, 2, 6, 9)
""")
def q_validate_valid(spark, sf_dir):
    """V2-V7: records that pass the clickstream contract, typed."""
    raw = D.contract_records(_events(spark, sf_dir)).withColumnRenamed("event_id", "src_id")
    return C.validate(raw, "clickstream_events", keep=("src_id",)).valid.drop("record")


@register("validate_errors", sql="""
SELECT event_id AS src_id,
  CASE m WHEN 1 THEN 'missing required fields [''user_id'']'
         WHEN 3 THEN 'field ''user_id'' must be one of (int, str)'
         WHEN 4 THEN 'missing required fields [''event_type'']'
         WHEN 5 THEN 'field ''amount'' must be one of (int, float)'
         WHEN 7 THEN 'field ''event_id'' must be of type str'
         ELSE 'expected an object' END AS error,
  1 AS n_errors
FROM (SELECT *, event_id % 10 AS m FROM events)
WHERE m IN (1, 3, 4, 5, 7, 8)
""")
def q_validate_errors(spark, sf_dir):
    """V5-V7 quarantine: the first failed check and the number of failures."""
    raw = D.contract_records(_events(spark, sf_dir)).withColumnRenamed("event_id", "src_id")
    bad = C.validate(raw, "clickstream_events", keep=("src_id",)).quarantine
    return bad.select("src_id", "error", F.size("errors").alias("n_errors"))


@register("validate_strict", sql="""
SELECT event_id AS src_id, 'e-' || event_id AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id FROM events
""")
def q_validate_strict(spark, sf_dir):
    """V7 strict: every event as a record that keeps the contract; one that did not would stop the query."""
    raw = _events(spark, sf_dir).select(F.col("event_id").alias("src_id"), F.to_json(F.struct(
        F.concat(F.lit("e-"), F.col("event_id").cast("string")).alias("event_id"), "event_type", "user_id")).alias("value"))
    return C.validate_strict(raw, "clickstream_events", "src_id").select("src_id", "event_id", "event_type", "user_id")


@register("bare_log_lines", sql="""
SELECT event_id AS src_id, CASE event_id % 5 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN 'true' WHEN 2 THEN event_type
  WHEN 3 THEN event_type || ' by ' || user_id ELSE 'in an object' END AS message
FROM events
""")
def q_bare_log_lines(spark, sf_dir):
    """V1-V2: log records that are text, number-like text, a JSON string or an object, all as messages."""
    eid, kind = F.col("event_id"), F.col("event_type")
    line = (F.when(eid % 5 == 0, eid.cast("string")).when(eid % 5 == 1, F.lit("true"))
            .when(eid % 5 == 2, F.concat(F.lit('"'), kind, F.lit('"')))
            .when(eid % 5 == 3, F.concat_ws(" ", kind, F.lit("by"), F.col("user_id").cast("string")))
            .otherwise(F.lit('{"message":"in an object"}')))
    raw = _events(spark, sf_dir).select(eid.alias("src_id"), line.alias("value"))
    return C.validate(raw, "server_logs", keep=("src_id",)).valid.select("src_id", "message")
