"""Stateless parsing of raw values.

Every function maps columns to columns with built-in expressions, so the
same code runs on a batch DataFrame and on a streaming one, fused into the
scan's whole-stage codegen with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import computed_once
from strata.functions.timecols import instant_as_ntz
from strata.schemas import AUDIT_COLUMN, LOG_FIELDS, LOG_PATTERN

CORRUPT = "_corrupt_record"
MALFORMED = "_is_malformed"


def as_text(df: DataFrame, column: str = "value", alias: str = "value") -> DataFrame:
    """Raw bytes (e.g. a message value) to a string column."""
    return df.select(F.col(column).cast("string").alias(alias))


def with_audit_time(df: DataFrame) -> DataFrame:
    """The ingestion time (one value per micro-batch / per query)."""
    return df.withColumn(AUDIT_COLUMN, F.current_timestamp())


def parse_json_columns(df: DataFrame, schema: T.StructType, column: str = "value",
                       keep: tuple[str, ...] = (), drop_malformed: bool = False,
                       keep_corrupt_text: bool = False) -> DataFrame:
    """Parse JSON text by a fixed schema and promote the fields to columns.

    PERMISSIVE like the source system: unparsable or mistyped rows stay,
    with the fields that did not parse set to null. ``_is_malformed`` tells
    those rows apart (a null or empty value, a syntax error, a non-object,
    or a field of the wrong type); ``drop_malformed`` removes them instead.
    Keys are case-sensitive, quoted numbers are not coerced, trailing text
    after the object is ignored and a duplicate key keeps the last value.
    """
    if CORRUPT in schema.fieldNames():
        raise ValueError(f"schema must not contain {CORRUPT}")
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    raw = F.col(column)
    kept_raw = F.col("_raw")
    malformed = kept_raw.isNull() | (F.trim(kept_raw) == F.lit("")) | F.col(f"_parsed.{CORRUPT}").isNotNull()
    fields = [F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields]
    extra = [F.col(f"_parsed.{CORRUPT}").alias(CORRUPT)] if keep_corrupt_text else []
    staged = computed_once(df.select(*[F.col(k) for k in keep], raw.alias("_raw")),
                           F.struct(F.col("_raw").alias("raw"),
                                    F.from_json(F.col("_raw"), with_corrupt,
                                                {"columnNameOfCorruptRecord": CORRUPT}).alias("parsed")),
                           "_s", list(keep))
    staged = staged.select(*[F.col(k) for k in keep], F.col("_s.raw").alias("_raw"),
                           F.col("_s.parsed").alias("_parsed"))
    out = (staged
             .select(*[F.col(k) for k in keep], *fields, *extra,
                     malformed.alias(MALFORMED)))
    if drop_malformed:
        out = out.where(~F.col(MALFORMED)).drop(MALFORMED)
    return out


def log_line_matches(line: Column) -> Column:
    return line.isNotNull() & line.rlike(LOG_PATTERN)


def log_fields(line: Column) -> list[Column]:
    """The seven fields of a log line; status and latency as int.

    ``try_cast`` keeps the row when a number does not fit an int (it becomes
    null), where a plain cast would fail the query under ANSI mode.
    """
    cols = []
    for i, name in enumerate(LOG_FIELDS, start=1):
        c = F.regexp_extract(line, LOG_PATTERN, i)
        if name in ("status_code", "latency_ms"):
            c = c.try_cast("int")
        cols.append(c.alias(name))
    return cols


def parse_log_lines(df: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parsed log rows; lines that do not match the pattern drop out."""
    line = F.col(column)
    return df.where(log_line_matches(line)).select(*[F.col(k) for k in keep], *log_fields(line))


def split_log_lines(df: DataFrame, column: str = "value",
                    keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """P6 with a quarantine: (parsed rows, rejected raw lines).

    Both outputs are narrow projections of the same input; when both are
    written, cache or persist the input first so it is read once.
    """
    line = F.col(column)
    good = df.where(log_line_matches(line)).select(*[F.col(k) for k in keep], *log_fields(line))
    bad = df.where(~F.coalesce(log_line_matches(line), F.lit(False))).select(
        *[F.col(k) for k in keep], line.alias("raw_line"))
    return good, bad


def utc_stamp(fmt: str = "yyyyMMdd'T'HHmmss'Z'") -> Column:
    """Current UTC time formatted (the session time zone is UTC)."""
    return F.date_format(F.current_timestamp(), fmt)


def parse_time(text: Column) -> Column:
    """ISO-8601 text (with offset or Z) to a timestamp; null when unparsable."""
    return F.try_to_timestamp(text)


def to_utc_wall_clock(spark, ts: Column) -> Column:
    """An instant (``timestamp``) as its UTC wall-clock ``timestamp_ntz``,
    whatever the session time zone."""
    return instant_as_ntz(spark, ts)
