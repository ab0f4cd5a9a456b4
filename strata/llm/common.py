"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.session import scratch_path


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[dict]], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df``; it yields column dicts.

    A narrow step: no shuffle, and memory is bounded by one batch.
    """
    fields = T._parse_datatype_string(schema)
    target = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type, from_pandas=False) if not isinstance(columns[f.name], pa.Array)
                     else columns[f.name].cast(f.type) for f in target], schema=target)

    return df.mapInArrow(run, fields)


def materialise(spark: SparkSession, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` below the cluster's shared checkpoint folder and read it back.

    Cuts the lineage without ``localCheckpoint``: the files survive the loss
    of any executor, and steps that read the result twice do not recompute it.
    """
    path = scratch_path(spark, name)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """The texts of a batch; null counts as empty."""
    for value in batch.column(column):
        yield value.as_py() or ""
