"""Bronze schemas, raw-record contracts and the log line pattern.

Fixed values: these must equal the source system's for results to agree,
so they are written out plainly, in their natural order, and kept together.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

# Server log line: "<ts> <ip> <service> <method> <path> <status_code> <latency>ms"
LOG_PATTERN = r"^(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\d+)\s+(\d+)ms$"
LOG_FIELDS = ("timestamp", "ip", "service", "method", "path", "status_code", "latency_ms")

CLICKSTREAM_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
])

ORDER_CHANGES_SCHEMA = T.StructType([
    T.StructField("order_id", T.IntegerType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("payment_status", T.StringType()),
    T.StructField("order_placed_at", T.StringType()),
])

SHIPMENT_EVENT = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("time", T.StringType()),
])

# The shipping payload also carries the per-shipment event list; unlike the
# source system we keep it (the carrier-latency mart needs it).
SHIPMENT_SCHEMA = T.StructType([
    T.StructField("order_id", T.IntegerType()),
    T.StructField("carrier", T.StringType()),
    T.StructField("tracking_number", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("status_last_updated_at", T.StringType()),
    T.StructField("events", T.ArrayType(SHIPMENT_EVENT)),
])

SERVER_LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("service", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("latency_ms", T.IntegerType()),
])

# Raw-record contracts: required fields, then the typed fields in declared
# order. Type names: "str", "int", "float"; a tuple is a union.
CONTRACTS: dict[str, dict] = {
    "clickstream_events": {
        "required": ["event_id", "event_type", "user_id"],
        "types": {
            "event_id": "str",
            "event_type": "str",
            "user_id": ("int", "str"),
            "ts": "str",
            "event_time": "str",
            "amount": ("int", "float"),
        },
    },
    "server_logs": {
        "required": ["message"],
        "types": {
            "timestamp": "str",
            "level": "str",
            "message": "str",
        },
    },
    "order_changes": {
        "required": ["order_id", "order_status", "order_placed_at"],
        "types": {
            "order_id": ("int", "str"),
            "order_status": "str",
            "order_placed_at": "str",
            "user_id": ("int", "str"),
            "product_id": ("int", "str"),
            "total_amount": ("int", "float"),
        },
    },
    "shipment_data": {
        "required": ["order_id", "status", "status_last_updated_at"],
        "types": {
            "order_id": ("int", "str"),
            "status": "str",
            "status_last_updated_at": "str",
            "carrier": "str",
            "tracking_number": "str",
        },
    },
}

# Order life cycle: allowed (from, to) status changes. PLACED may move on
# only once the payment is PAID; staying in a status is always allowed.
ORDER_TRANSITIONS = (
    ("PLACED", "SHIPPED"),
    ("PLACED", "CANCELLED"),
    ("SHIPPED", "DELIVERED"),
)
PAYMENT_TRANSITIONS = (
    ("PENDING", "PAID"),
    ("PENDING", "FAILED"),
)

# Silver records: nested keys are joined with this separator; a document
# {"shipments": [...]} is unwrapped to its list and its records are tagged
# with this source name; other sources come from the file name; metadata
# columns and the wrapper key of non-object elements.
FLATTEN_SEPARATOR = "_"
SHIPMENTS_KEY = "shipments"
ENVELOPE_KEY = "records"
SHIPPING_SOURCE = "shipping"
SOURCE_NAME = "source_name"
RECORD_INDEX = "record_index"
VALUE_KEY = "value"

# Contract check messages.
MSG_UNKNOWN_SOURCE = "Unknown Bronze source schema: {source}"
MSG_NOT_OBJECT = "expected an object"
MSG_MISSING = "missing required fields [{names}]"
MSG_TYPE = "field '{name}' must be of type {type}"
MSG_TYPES = "field '{name}' must be one of ({types})"
MSG_INVALID = "Invalid record at index {index} for {source}: {error}"

# --- end of fixed values ----------------------------------------------------

BRONZE_SCHEMAS: dict[str, T.StructType] = {
    "clickstream_events": CLICKSTREAM_SCHEMA,
    "order_changes": ORDER_CHANGES_SCHEMA,
    "shipment_data": SHIPMENT_SCHEMA,
    "server_logs": SERVER_LOG_SCHEMA,
}

AUDIT_COLUMN = "_ingested_at"


def bronze_ddl(schema: T.StructType) -> str:
    """The table DDL of a bronze schema plus the audit column.

    Real types are kept (decimal, array, struct ...) instead of collapsing
    unknown ones to string.
    """
    if AUDIT_COLUMN in schema.fieldNames():
        return schema.toDDL()
    widened = T.StructType(list(schema.fields))  # StructType.add mutates in place
    return widened.add(AUDIT_COLUMN, T.TimestampType()).toDDL()
