"""Jobs: the pipeline entry points as plain functions.

Each job is one lazy plan per output, executed by its write: no loop over
files or records on the driver.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas as S
from strata.operators import normalize as N
from strata.operators import reconcile as R
from strata.sinks import files as sinks
from strata.sources import files as sources


_LANDED = "_landed_source"
_PATH = "_path"
QUARANTINE = "_quarantine"
NOT_JSON = "not JSON, or beyond the parser's limits"
# Parts of a silver table that grows by batches.
RECORDS, REJECTED = "records", "quarantine"


def bronze_documents(spark: SparkSession, input_path: str, base_dir: str | None = None,
                     dataset_name: str | None = None) -> DataFrame:
    """Every document below a path: ``_path``, ``doc``, ``dataset``, ``_landed_source``.

    JSON files are documents of their own, named by their path. In raw
    landings (K3) each line is a document; source and dataset are the
    landing's source.
    """
    landed, others = sources.landing_folders(spark, input_path)
    # local paths come back as file:/... or file:///...; compare without the scheme
    local_base = re.sub(r"^file:/+", "/", base_dir or input_path)
    name = F.lit(dataset_name) if dataset_name else N.dataset_from_path(
        F.regexp_replace(F.col("path"), r"^file:/+", "/"), local_base)
    files = sources.read_json_documents(spark, others if landed else input_path)
    documents = files.select(F.col("path").alias(_PATH), "doc", name.alias("dataset"), F.lit(None).cast("string").alias(_LANDED))
    if not landed:
        return documents
    dataset = F.lit(dataset_name) if dataset_name else F.col("landed_source")
    return documents.unionByName(sources.read_landing(spark, landed).select(
        F.col("path").alias(_PATH), "doc", dataset.alias("dataset"), F.col("landed_source").alias(_LANDED)))


def silver_records(spark: SparkSession, input_path: str, base_dir: str | None = None,
                   unwrap_keys: tuple[str, ...] = (N.SHIPMENTS,), dataset_name: str | None = None,
                   form: str = "wide", schema_path: str | None = None, docs: DataFrame | None = None) -> DataFrame:
    """Bronze JSON files and raw landings to silver records with ``dataset`` (E3/E4 plan).

    ``form="wide"``: one column per flattened key over all inputs;
    ``form="map"``: each record as ``map<string, variant>`` keeping only its
    own keys (for sources whose shapes disagree). ``schema_path`` keeps the
    wide shape between runs (inferred on the first). Documents that are not
    JSON give no record: :func:`unparsed_documents` has them.
    """
    if docs is None:
        docs = bronze_documents(spark, input_path, base_dir, dataset_name)
    source = F.coalesce(F.col(_LANDED), N.document_source(F.col("doc"), F.col(_PATH)))
    if form == "wide":
        return N.normalize(docs, source, doc_col="doc", keep=("dataset",), unwrap_keys=unwrap_keys,
                           schema_path=schema_path)
    if form == "map":
        return N.normalize_map(docs, source, doc_col="doc", keep=("dataset",), unwrap_keys=unwrap_keys)
    raise ValueError(f"unknown form: {form}")


def unparsed_documents(docs: DataFrame) -> DataFrame:
    """Bronze documents that give no record: ``dataset``, ``path``, ``doc``, ``error``."""
    return N.unparsed_documents(docs).select("dataset", F.col(_PATH).alias("path"), "doc", F.lit(NOT_JSON).alias("error"))


def _silver_job(spark: SparkSession, input_path: str, output_dir: str, base_dir: str | None,
                dataset_name: str | None, **kw) -> str:
    docs = bronze_documents(spark, input_path, base_dir, dataset_name)
    out = sinks.write_silver(silver_records(spark, input_path, docs=docs, **kw), output_dir)
    sinks.write_table(unparsed_documents(docs), f"{output_dir.rstrip('/')}/{QUARANTINE}")
    return out


def silver_file_job(spark: SparkSession, input_path: str, output_dir: str,
                    dataset_name: str | None = None, **kw) -> str:
    """One bronze file to a silver dataset (default name: the file stem)."""
    if dataset_name is None:
        dataset_name = input_path.rstrip("/").split("/")[-1].rsplit(".", 1)[0]
    return _silver_job(spark, input_path, output_dir, None, dataset_name, **kw)


def silver_folder_job(spark: SparkSession, input_dir: str, output_dir: str, **kw) -> str:
    """Every ``*.json`` under a folder, one partitioned write. Documents
    that are not JSON go to ``<output_dir>/_quarantine``, which readers of the
    datasets skip."""
    return _silver_job(spark, input_dir, output_dir, input_dir, None, **kw)


def silver_stream_job(spark: SparkSession, input_dir: str, output_dir: str, checkpoint: str, schema: T.DataType,
                      glob: str = "*.json", lines: bool = False, unwrap_keys: tuple[str, ...] = (N.SHIPMENTS,),
                      base_dir: str | None = None, max_files: int | None = None) -> str:
    """E4, incremental: the documents that came below ``input_dir`` since the last run, appended to silver.

    A file stream finds the new files by its checkpoint, so a run reads each
    document once and nothing that an earlier run has read; the file index is
    Spark's own, no names pass through Python. Documents are whole files, or
    lines of raw landings (K3) with ``lines``. One pass makes records and
    quarantine. A batch is a folder of its own that a replay rewrites; inside,
    rows are clustered by dataset (see ``sinks.write_clustered``), so the
    number of files does not grow with that of the bronze files.

    Spark's sources skip names that start with ``_`` or ``.``.
    """
    docs = sources.stream_documents(spark, input_dir, glob, lines, max_files)
    local_base = re.sub(r"^file:/+", "/", base_dir or input_dir)
    if lines:
        dataset = source = sources.landed_source(F.col("path"))
    else:
        dataset = N.dataset_from_path(F.regexp_replace(F.col("path"), r"^file:/+", "/"), local_base)
        source = None
    docs = docs.select(F.col("path").alias(_PATH), "doc", dataset.alias("dataset"))
    rows = N.normalize(docs, source if source is None else F.col("dataset"), keep=("dataset", _PATH), unwrap_keys=unwrap_keys,
                       schema=schema, path_col=_PATH, rejected="_doc")
    bad = F.col("_doc").isNotNull()
    rows = rows.withColumns({"state": F.when(bad, REJECTED).otherwise(RECORDS), "_error": F.when(bad, NOT_JSON)})

    def append(batch: DataFrame, number: int) -> None:
        # Ranges come from a sample of all rows: kept on the executors' disks, these are made once.
        made = batch.persist(StorageLevel.DISK_ONLY)
        try:
            sinks.write_clustered(made, f"{output_dir.rstrip('/')}/batch_id={number}", ("dataset", S.RECORD_INDEX), ("state",))
        finally:
            made.unpersist()

    query = (rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return output_dir


def read_silver(spark: SparkSession, output_dir: str) -> DataFrame:
    """The records of a silver table that :func:`silver_stream_job` keeps, with their ``batch_id``."""
    return spark.read.parquet(output_dir).where(F.col("state") == RECORDS).drop("state", "_doc", "_error", _PATH)


def read_quarantine(spark: SparkSession, output_dir: str) -> DataFrame:
    """The documents that gave no record: ``dataset``, ``path``, ``doc``, ``error``, ``batch_id``."""
    return spark.read.parquet(output_dir).where(F.col("state") == REJECTED).select(
        "dataset", F.col(_PATH).alias("path"), F.col("_doc").alias("doc"), F.col("_error").alias("error"), "batch_id")


def gold_reconcile_job(orders: DataFrame, shipments: DataFrame, output_dir: str,
                       order_key: str = R.KEY, shipment_key: str | None = None,
                       zero_is_missing: bool = True) -> dict[str, str]:
    """E5: reconcile two silver datasets; write the report and its id tables.

    The per-key counts are written once (``_key_counts``) and every output
    is derived from that table, so the inputs are scanned and shuffled once
    and a lost executor recomputes from the written table, not the inputs.
    """
    base = output_dir.rstrip("/")
    counts = R.key_counts(orders, shipments, order_key, shipment_key, zero_is_missing)
    counts_path = sinks.write_table(counts, f"{base}/_key_counts")
    rec = R.from_counts(orders.sparkSession.read.parquet(counts_path))
    return {
        "report": sinks.write_report(rec.report, f"{base}/report"),
        "missing_shipments": sinks.write_table(rec.missing, f"{base}/missing_shipments"),
        "duplicate_orders": sinks.write_table(rec.duplicates, f"{base}/duplicate_orders"),
        "orphan_shipments": sinks.write_table(rec.orphans, f"{base}/orphan_shipments"),
        "key_counts": counts_path,
    }


def run_bronze_batch(spark: SparkSession, out_base: str, topics: dict[str, DataFrame],
                     tables: dict[str, DataFrame], payloads: dict[str, DataFrame] | None = None,
                     max_messages: int = 5) -> DataFrame:
    """One bounded bronze pull: up to ``max_messages`` per topic, whole
    tables, API payloads; each lands as raw JSON lines (K3). Returns the run
    summary (A8): per source kind the number of sources and of rows landed,
    read back from the landing folder (so it counts what was written).
    """
    run_id = uuid.uuid4().hex
    began = datetime.now(timezone.utc).date()
    kinds: dict[str, str] = {}
    for name, df in topics.items():  # topics first, in the given order
        sinks.write_raw(df.limit(max_messages), out_base, name, run_id)
        kinds[name] = "kafka_topics"
    for name, df in tables.items():
        sinks.write_raw(df, out_base, name, run_id)
        kinds[name] = "postgres_tables"
    for name, df in (payloads or {}).items():
        sinks.write_raw(df, out_base, name, run_id)
        kinds[name] = "api_payloads"
    days = {began, datetime.now(timezone.utc).date()}
    return _run_summary(spark, out_base, run_id, kinds, [d.isoformat() for d in sorted(days)])


def _run_summary(spark: SparkSession, out_base: str, run_id: str, kinds: dict[str, str], days: list[str]) -> DataFrame:
    """Sources and rows per kind. Only this run's partitions are read, with
    no schema inference; a source that landed no row has no partition and counts 0."""
    landing = T.StructType([T.StructField("source", T.StringType()), T.StructField("ingest_date", T.DateType()),
                            T.StructField("run_id", T.StringType())])
    kind_df = spark.createDataFrame(sorted(kinds.items()), "source string, source_kind string")
    folders = [f"{out_base.rstrip('/')}/source=*/ingest_date={day}/run_id={run_id}" for day in days]
    folders = [f for f in folders if sources.matches(spark, f)]
    landed = (spark.read.option("basePath", out_base).schema(landing).json(folders) if folders
              else spark.createDataFrame([], landing))
    per_source = kind_df.join(landed.groupBy("source").agg(F.count(F.lit(1)).alias("rows")), "source", "left")
    return (per_source.groupBy("source_kind")
            .agg(F.count_distinct("source").alias("sources"),
                 F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows")))
