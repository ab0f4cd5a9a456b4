"""Readers for the parquet tables a job is pointed at.

Column lists are passed down so that the scan's ReadSchema only carries
what the plan uses; Catalyst would prune anyway, but naming the columns
keeps plans readable and makes the intent explicit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one table; ``columns`` (optional) become the projection."""
    if name not in TABLES:
        raise ValueError(f"unknown table: {name}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Read one table as a file stream (new files in the folder are picked up).

    The tables are single files named ``<name>.parquet`` in a shared folder,
    so the source watches the folder and filters by file name.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table: {name}")
    schema = spark.read.parquet(table_path(sf_dir, name)).schema
    reader = (spark.readStream.format("parquet").schema(schema)
              .option("pathGlobFilter", f"{name}.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(sf_dir)
