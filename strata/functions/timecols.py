"""Time arithmetic that does not depend on the session time zone.

``timestamp_ntz`` values are wall-clock times with no zone; casting them to
``timestamp`` reads them in the session time zone, which shifts differences
across daylight-saving changes. Here they are read as UTC instead, so
differences, buckets and watermarks are the same in every session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "1970-01-01 00:00:00"


def is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch; a ``timestamp_ntz`` is read as UTC."""
    col = F.col(name)
    if is_ntz(df, name):
        return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), col)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(col)
    return F.unix_micros(col.cast("timestamp"))


def as_instant(df: DataFrame, name: str) -> Column:
    """A ``timestamp`` for watermarks and windows; ``timestamp_ntz`` read as UTC."""
    if is_ntz(df, name):
        return F.timestamp_micros(epoch_micros(df, name))
    return F.col(name).cast("timestamp")


def instant_as_ntz(spark, ts: Column) -> Column:
    """Back from :func:`as_instant`: the instant's UTC wall clock."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    local = ts.cast("timestamp_ntz")
    if tz in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        return local
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
