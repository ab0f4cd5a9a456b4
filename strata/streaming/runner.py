"""Run a streaming plan to completion over what is available (tests, twins)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.session import scratch_path


def run_available(df: DataFrame, spark: SparkSession, name: str, output_mode: str = "append",
                  fmt: str = "parquet") -> DataFrame:
    """Process everything the sources have now (``availableNow``) into a fresh
    folder under the shared checkpoint location, and read the result back."""
    base = scratch_path(spark, name)
    q = (df.writeStream.outputMode(output_mode).format(fmt)
         .option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start(f"{base}/data"))
    q.awaitTermination()
    return spark.read.format(fmt).load(f"{base}/data")


class Arrivals:
    """A table that arrives in batches: rows whose ``batch`` expression is 0
    first, then those with 1, and so on; each row arrives once."""

    def __init__(self, spark: SparkSession, name: str, df: DataFrame, batch: Column, batches: int):
        self.spark, self.schema, self.batches = spark, df.schema, batches
        self.path = scratch_path(spark, f"{name}-arrivals")
        self.numbered = df.withColumn("_batch", F.greatest(F.lit(0), F.least(F.lit(batches - 1), batch)))

    def deliver(self, number: int) -> None:
        self.numbered.where(F.col("_batch") == number).drop("_batch").write.mode("append").parquet(self.path)

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(self.path)


def run_in_arrivals(arrivals: Sequence[Arrivals], start: Callable[..., StreamingQuery]) -> None:
    """Deliver batch after batch and run the stream over what has come, each
    time from its checkpoint. ``start`` gets the streams and starts a query
    that ends once it has processed what there is."""
    for number in range(max(a.batches for a in arrivals)):
        for a in arrivals:
            if number < a.batches:
                a.deliver(number)
        start(*(a.stream() for a in arrivals)).awaitTermination()
