"""Validity intervals kept up to date (B8, incremental).

The table is cut into a fixed number of buckets by key. A batch of changes
rewrites only the buckets it touches, and in them only the tail of each changed
key: intervals that ended before its earliest new change stay as they are.
Late changes therefore split the interval they fall into, wherever it lies.

A bucket's rows of one batch are a folder of their own, and a small table says
which batch wrote each bucket last. Nothing that a reader may hold is ever
rewritten, and a batch that is delivered again replaces its own folders.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators import keyed as K

BUCKETS = 32
_BUCKET, _VERSION = "_bucket", "_version"


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys])


def _last_versions(spark: SparkSession, path: str, before: int | None) -> list[tuple[int, int]]:
    """(bucket, batch that wrote it last); a row per bucket, so at most as many as there are buckets."""
    try:
        written = spark.read.parquet(f"{path}/buckets")
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []
    if before is not None:
        written = written.where(F.col("batch_id") < before)
    return [(r[0], r[1]) for r in written.groupBy(_BUCKET).agg(F.max("batch_id")).collect()]


def _rows(spark: SparkSession, path: str, versions: list[tuple[int, int]]) -> DataFrame | None:
    """The rows of some buckets as of the given batches; the filter is on partition columns alone."""
    if not versions:
        return None
    by_version: dict[int, list[int]] = {}
    for bucket, version in versions:
        by_version.setdefault(version, []).append(bucket)
    wanted = reduce(lambda a, b: a | b, [(F.col(_VERSION) == v) & F.col(_BUCKET).isin(b) for v, b in sorted(by_version.items())])
    return spark.read.parquet(f"{path}/rows").where(wanted).drop(_VERSION)


def merge_history(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str],
                  batch_id: int, buckets: int = BUCKETS) -> None:
    """Bring the history at ``path`` up to date with a batch of changes, early, late or repeated.

    A change is known by its keys, ``ts`` and ``tiebreak``; one that is there already is left as it is.
    """
    keys, order = list(keys), [ts, *tiebreak]
    columns = changes.columns
    base = path.rstrip("/")
    new = changes.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).dropDuplicates([*keys, *order])
    touched = sorted(r[0] for r in new.select(_BUCKET).distinct().collect())
    held = _rows(spark, base, [v for v in _last_versions(spark, base, batch_id) if v[0] in set(touched)])
    if held is not None:
        firsts = new.groupBy(*keys).agg(F.min(ts).alias("_first")).alias("c")
        marked = held.alias("h").join(firsts, _same(keys), "left").select("h.*", "_first")
        # An interval that ended by the first new change is not affected; the one that holds it, and all later ones, are.
        open_ = F.col("_first").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("_first")))
        done = marked.where(~open_).drop("_first")
        tail = marked.where(open_).select(*columns, _BUCKET)
        known = [F.col(f"c.{c}").eqNullSafe(F.col(f"h.{c}")) for c in (*keys, *order)]
        new = new.alias("c").join(held.alias("h"), reduce(lambda a, b: a & b, known), "left_anti").unionByName(tail)
    made = K.scd2_history(new, keys, ts, tiebreak)
    if held is not None:
        made = made.unionByName(done)
    (made.withColumn(_VERSION, F.lit(batch_id)).repartition(_BUCKET).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(_VERSION, _BUCKET).parquet(f"{base}/rows"))
    spark.createDataFrame([(b,) for b in touched], f"{_BUCKET} int").coalesce(1).write.mode("overwrite").parquet(
        f"{base}/buckets/batch_id={batch_id}")


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """Every change with ``valid_from``, ``valid_to`` and ``is_current``; None before the first batch."""
    rows = _rows(spark, path.rstrip("/"), _last_versions(spark, path.rstrip("/"), None))
    return None if rows is None else rows.drop(_BUCKET)


def history_stream(changes: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str, tiebreak: Sequence[str],
                   buckets: int = BUCKETS) -> StreamingQuery:
    """:func:`merge_history` for every micro-batch of a stream of changes."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_history(batch.sparkSession, path, batch, keys, ts, tiebreak, batch_id, buckets)

    return changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge).trigger(availableNow=True).start()
