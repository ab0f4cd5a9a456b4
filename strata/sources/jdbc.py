"""Relational sources over JDBC.

Partitioned reads: ``partitionColumn`` with bounds splits the scan into
``num_partitions`` range queries run by the executors in parallel, and
filters / projections on the DataFrame are pushed into those queries.
Table names go through an allow-list instead of being pasted into SQL.
The JDBC driver jar of the database has to be on the classpath; no
database is started or reached from tests.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Source tables of the order system with their split columns.
SOURCE_TABLES: dict[str, str] = {
    "users": "user_id",
    "products": "product_id",
    "orders": "order_id",
}


def jdbc_options(url: str, table: str, partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int | None = None,
                 properties: Mapping[str, str] | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options of a (partitioned) table scan; the table must be allowed."""
    if table not in SOURCE_TABLES:
        raise ValueError(f"table not allowed: {table}")
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned reads need lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    opts.update(dict(properties or {}))
    return opts


def read_source_table(spark: SparkSession, url: str, table: str, lower: int | None = None,
                      upper: int | None = None, num_partitions: int | None = None,
                      properties: Mapping[str, str] | None = None) -> DataFrame:
    """Full scan of an allowed table, split on its key when bounds are given."""
    split = SOURCE_TABLES[table] if table in SOURCE_TABLES and num_partitions else None
    opts = jdbc_options(url, table, split, lower, upper, num_partitions, properties)
    return spark.read.format("jdbc").options(**opts).load()


def read_bounded(spark: SparkSession, url: str, table: str, limit: int,
                 properties: Mapping[str, str] | None = None) -> DataFrame:
    """At most ``limit`` rows of an allowed table; the database applies the
    cap (``LIMIT`` pushed down by Spark), ``limit`` on top keeps it exact."""
    opts = jdbc_options(url, table, properties=properties)
    return spark.read.format("jdbc").options(**opts).load().limit(limit)
