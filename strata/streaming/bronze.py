"""Bronze streams: raw messages to append-only tables (S1, S2, K1, K2, K6, E1,
R1-R5).

Sources are plain streaming DataFrames with a ``value`` column, so the same
code runs on a Kafka source (where its connector jar is deployed) and on a
file source (tests). Tables are created if absent and never dropped, so a
restart over an existing checkpoint appends exactly where it stopped.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.functions import parse as P
from strata.schemas import bronze_ddl

DEFAULT_TRIGGER = {"processingTime": "30 seconds"}


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "earliest", fail_on_data_loss: bool = False,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """A Kafka topic as a stream of ``value`` strings (needs the
    Kafka connector on the classpath). Key, partition, offset and timestamp
    are dropped, as in the source system."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return P.as_text(reader.load())


def kafka_batch(spark: SparkSession, bootstrap_servers: str, topic: str, max_messages: int) -> DataFrame:
    """A bounded batch pull of at most ``max_messages`` messages."""
    df = (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
          .option("subscribe", topic).option("startingOffsets", "earliest")
          .option("endingOffsets", "latest").load())
    return P.as_text(df).limit(max_messages)


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of text files as a ``value`` stream (the offline stand-in)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def json_bronze(raw: DataFrame, schema: T.StructType, drop_malformed: bool = False) -> DataFrame:
    """P1-P3 on a message stream: typed columns, malformed flag, audit time."""
    return P.with_audit_time(P.parse_json_columns(raw, schema, drop_malformed=drop_malformed))


def log_bronze(raw: DataFrame) -> DataFrame:
    """P4-P6 + P3 on a log-line stream: parsed rows only."""
    return P.with_audit_time(P.parse_log_lines(raw))


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None,
                 fmt: str = "parquet") -> str:
    """K2: create the namespace and table if absent; never drop; errors raise."""
    if "." in name:
        ns = name.rsplit(".", 1)[0]
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {ns}")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({bronze_ddl(schema)}) USING {fmt}{loc}")
    return name


def append_stream(df: DataFrame, checkpoint: str, table: str | None = None, path: str | None = None,
                  trigger: Mapping | None = None, query_name: str | None = None,
                  fmt: str = "parquet") -> StreamingQuery:
    """K1: append a stream to a table (or a path) with its own checkpoint."""
    writer = (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
              .trigger(**dict(trigger or DEFAULT_TRIGGER)))
    if query_name:
        writer = writer.queryName(query_name)
    if table:
        return writer.toTable(table)
    if path:
        return writer.format(fmt).start(path)
    raise ValueError("table or path required")


def validated_append(raw: DataFrame, source: str, out_path: str, quarantine_path: str, checkpoint: str,
                     schema: T.StructType | None = None, trigger: Mapping | None = None,
                     keep: tuple[str, ...] = ()) -> StreamingQuery:
    """Contract check between parsing and landing, on a message stream.

    Each micro-batch is split by the source's contract (V2-V7): valid
    records are parsed by ``schema`` (or kept as log lines) and land under
    ``out_path/batch_id=<n>``, rejected ones with their reasons under
    ``quarantine_path/batch_id=<n>``; ``keep`` columns ride along in both.
    Both writes overwrite their batch folder, so a replayed batch does not
    duplicate rows.
    """
    from strata.operators.contracts import checked_records, split_checked

    def land(batch: DataFrame, batch_id: int) -> None:
        # The micro-batch is read once (cached as raw text, spread over all
        # slots when it arrives as too few partitions); both writes validate
        # from the cache. Caching the parsed VARIANT frame instead ran out of
        # heap on small drivers, so the raw text is what is kept.
        staged = batch.persist()
        try:
            out = split_checked(checked_records(staged, source, column="value", keep=keep + ("value",)),
                                source, keep + ("value",))
            valid = out.valid.select(*keep, "value")
            if schema is not None:
                valid = P.with_audit_time(P.parse_json_columns(valid, schema, keep=keep))
            else:
                valid = P.with_audit_time(valid)
            valid.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
            # the batch_id=<n> folder is the batch column when the table is read
            out.quarantine.drop("value").write.mode("overwrite").parquet(
                f"{quarantine_path.rstrip('/')}/batch_id={batch_id}")
        finally:
            staged.unpersist()

    return (raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land)
            .trigger(**dict(trigger or DEFAULT_TRIGGER)).start())


@dataclass
class BronzeSource:
    """One bronze stream: a raw ``value`` stream and how to parse it."""

    name: str
    raw: DataFrame
    schema: T.StructType | None = None  # None: server log lines


def run_bronze_streams(spark: SparkSession, sources: list[BronzeSource], out_base: str,
                       checkpoint_base: str, trigger: Mapping | None = None,
                       tables: bool = False) -> list[StreamingQuery]:
    """Start one append query per source in this session.

    With ``tables`` each source lands in table ``bronze.<name>`` (created if
    absent), else under ``<out_base>/<name>``. Wait with
    ``spark.streams.awaitAnyTermination()`` (or stop the returned queries).
    """
    queries = []
    for src in sources:
        parsed = log_bronze(src.raw) if src.schema is None else json_bronze(src.raw, src.schema)
        ckpt = f"{checkpoint_base.rstrip('/')}/{src.name}"
        if tables:
            table = f"bronze.{src.name}"
            ensure_table(spark, table, T.StructType([f for f in parsed.schema.fields
                                                     if f.name != "_ingested_at"]),
                         location=f"{out_base.rstrip('/')}/{src.name}")
            queries.append(append_stream(parsed, ckpt, table=table, trigger=trigger, query_name=src.name))
        else:
            queries.append(append_stream(parsed, ckpt, path=f"{out_base.rstrip('/')}/{src.name}",
                                         trigger=trigger, query_name=src.name))
    return queries


def run_until_any_ends(spark: SparkSession, queries: list[StreamingQuery], timeout_s: float | None = None
                       ) -> StreamingQuery | None:
    """Wait until one of ``queries`` ends (or ``timeout_s`` passes), then
    stop the others; a query that ended with an error re-raises it here.
    Returns the query that ended first (None on timeout). Terminations of
    other queries in the session do not count."""
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    spark.streams.resetTerminated()
    ended = next((q for q in queries if not q.isActive), None)
    while ended is None:
        left = None if deadline is None else deadline - time.monotonic()
        if left is not None and left <= 0:
            return None
        if left is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(max(1, int(left * 1000)))
        spark.streams.resetTerminated()
        ended = next((q for q in queries if not q.isActive), None)
    for q in queries:
        if q.isActive:
            q.stop()
    if ended.exception() is not None:
        raise RuntimeError(f"stream {ended.name or ended.id} failed") from Exception(str(ended.exception()))
    return ended
