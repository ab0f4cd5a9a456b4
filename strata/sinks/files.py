"""File sinks (K3-K5): partitioned, append-safe, no per-second object names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.schemas import AUDIT_COLUMN, RECORD_INDEX


def write_raw(df: DataFrame, base_path: str, source: str, run_id: str | None = None) -> str:
    """K3: land raw records as JSON lines under
    ``<base>/source=<s>/ingest_date=<d>/[run_id=<r>/]``.

    One record per line (splittable), tagged with its UTC ingest time and,
    unless it has one, its ``record_index``: the position in its file. Silver
    takes source and dataset from the folder. Appends never overwrite earlier
    landings (Spark's part names are unique).
    With ``run_id`` every run gets its own partition, so a run's rows can be
    read back without listing earlier runs. Returns the source's folder.
    """
    if RECORD_INDEX not in df.columns:
        # The low 33 bits number the rows of a task, and a task writes one file here.
        df = df.withColumn(RECORD_INDEX, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    out = (df.withColumn("source", F.lit(source))
             .withColumn(AUDIT_COLUMN, F.current_timestamp())
             .withColumn("ingest_date", F.to_date(F.to_utc_timestamp(F.col(AUDIT_COLUMN), F.current_timezone()))))
    parts = ["source", "ingest_date"]
    if run_id is not None:
        out = out.withColumn("run_id", F.lit(run_id))
        parts.append("run_id")
    out.write.mode("append").partitionBy(*parts).json(base_path)
    return f"{base_path.rstrip('/')}/source={source}"


def write_silver(df: DataFrame, out_dir: str, dataset_col: str = "dataset", fmt: str = "parquet") -> str:
    """K4: one partition per dataset; rewriting a dataset leaves the others.

    Dynamic partition overwrite replaces only the datasets present in ``df``.
    VARIANT columns are stored as parquet variant; JSON output needs them as
    text first. Rows are rebalanced by dataset: a dataset's rows make few
    files, and one with very many is split at the advisory size.
    """
    (df.hint("rebalance", F.col(dataset_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(dataset_col).format(fmt).save(out_dir))
    return out_dir


def write_clustered(df: DataFrame, out_dir: str, cluster_by: tuple[str, ...], partition_by: tuple[str, ...] = ()) -> str:
    """Rows in ranges of ``cluster_by``, sorted, so that file and row-group statistics let a filter skip
    most of the table. There are as many files as the rows fill: many small
    datasets share a file, and a large one spans several. ``out_dir`` is replaced."""
    order = (*partition_by, *cluster_by)
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(out_dir)
    return out_dir


def write_report(report: DataFrame, out_dir: str) -> str:
    """K5: a small report (one row) as a single JSON file."""
    report.coalesce(1).write.mode("overwrite").json(out_dir)
    return out_dir


def write_table(df: DataFrame, out_dir: str, mode: str = "overwrite") -> str:
    """Parquet table write used for the id tables of a report."""
    df.write.mode(mode).parquet(out_dir)
    return out_dir


def write_bucketed(df: DataFrame, table: str, keys: list[str], num_buckets: int, path: str | None = None,
                   mode: str = "overwrite") -> str:
    """A table bucketed (and sorted) on ``keys``: later aggregates and joins
    on the same keys between tables with the same bucket count read it
    without a shuffle. Use it for silver datasets reconciled repeatedly."""
    writer = df.write.mode(mode).format("parquet").bucketBy(num_buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table
