"""Per-key sequence functions that survive a hot key (lag, lead, carry-forward).

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task; with one key holding a third of all rows that task holds a third
of the data. Here the rows are hash-partitioned on ``(key, bucket)``, with
``bucket`` a time slice of the ordering column, and the window runs per
``(key, bucket)``, so a hot key is spread over as many tasks as it has
buckets. Values that cross a bucket edge come from a small per-(key, bucket)
summary (one row per key and bucket, built from the same exchange) over
which a per-key window runs; it has ``span / bucket width`` rows per key,
independent of the key's row count.

The partitioning on ``(key, bucket)`` is explicit: left to itself the planner
would satisfy both the ``(key, bucket)`` and the per-key requirement with a
hash on the key alone, which puts a hot key back on one task. The summary
and its join back only shuffle summary rows; the big side is shuffled once.
Without keys, the summary window runs over buckets alone (one small task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.timecols import epoch_micros

BUCKET = "_seq_bucket"
# Width of a time slice: a key busy all day is spread over 24 tasks a day.
BUCKET_SECONDS = 3_600


def time_bucket(df: DataFrame, ts: str, width_seconds: int) -> Column:
    """Bucket number of a time column: whole ``width_seconds`` slices since
    the epoch (time-zone independent, see :mod:`strata.functions.timecols`)."""
    return F.floor(epoch_micros(df, ts) / F.lit(width_seconds * 1_000_000)).cast("bigint")


def stage(df: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """Add the bucket column and hash-partition on ``(keys, bucket)``."""
    return df.withColumn(BUCKET, bucket).repartition(*keys, BUCKET)


def _bucket_window(keys: list[str]):
    return Window.partitionBy(*keys).orderBy(BUCKET) if keys else Window.orderBy(BUCKET)


def _join_edges(inner: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    return inner.join(edges, [*keys, BUCKET], "left")


def neighbors_staged(staged: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str],
                     prev: bool = True, nxt: bool = True) -> DataFrame:
    """:func:`neighbors` on a :func:`stage`-d frame; keeps ``BUCKET``."""
    keys, order, carry = list(keys), list(order), [c for c in carry if c not in order]
    row = F.struct(*[F.col(c) for c in order + carry])
    w_in = Window.partitionBy(*keys, BUCKET).orderBy(*[F.col(c) for c in order])
    cols = []
    if prev:
        cols.append(F.lag(row).over(w_in).alias("_prev_in"))
    if nxt:
        cols.append(F.lead(row).over(w_in).alias("_next_in"))
    inner = staged.select("*", *cols)
    summary = staged.groupBy(*keys, BUCKET).agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
    w_b = _bucket_window(keys)
    edge_cols = []
    if prev:
        edge_cols.append(F.lag("_last").over(w_b).alias("_prev_edge"))
    if nxt:
        edge_cols.append(F.lead("_first").over(w_b).alias("_next_edge"))
    joined = _join_edges(inner, summary.select(*keys, BUCKET, *edge_cols), keys)
    out = []
    if prev:
        out.append(F.coalesce("_prev_in", "_prev_edge").alias("prev"))
    if nxt:
        out.append(F.coalesce("_next_in", "_next_edge").alias("next"))
    return joined.select(*staged.columns, *out)


def neighbors(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str],
              bucket: Column, prev: bool = True, nxt: bool = True) -> DataFrame:
    """Add ``prev`` / ``next`` struct columns: the ``order + carry`` values of
    the previous / next row of the same key in ``order`` (null at the ends).

    ``order`` must be a total order within a key (add a unique tie-breaker)
    and ``bucket`` must not decrease along it (a time bucket of the first
    ordering column).
    """
    out = neighbors_staged(stage(df, keys, bucket), keys, order, carry, prev, nxt)
    return out.drop(BUCKET)


def carry_forward_max_staged(staged: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                             name: str) -> DataFrame:
    """:func:`carry_forward_max` on a :func:`stage`-d frame; keeps ``BUCKET``."""
    keys, order = list(keys), list(order)
    with_v = staged.withColumn("_v", value)
    w_in = (Window.partitionBy(*keys, BUCKET).orderBy(*[F.col(c) for c in order])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = with_v.withColumn("_run", F.max("_v").over(w_in))
    summary = with_v.groupBy(*keys, BUCKET).agg(F.max("_v").alias("_bmax"))
    w_b = _bucket_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    edges = summary.select(*keys, BUCKET, F.max("_bmax").over(w_b).alias("_before"))
    joined = _join_edges(inner, edges, keys)
    return joined.select(*staged.columns, F.greatest("_run", "_before").alias(name))


def carry_forward_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                      bucket: Column, name: str) -> DataFrame:
    """``name`` = max of ``value`` over the key's rows up to and including
    this one in ``order`` (e.g. the start time of the current session)."""
    return carry_forward_max_staged(stage(df, keys, bucket), keys, order, value, name).drop(BUCKET)


def running_sum_staged(staged: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                       name: str) -> DataFrame:
    """:func:`running_sum` on a :func:`stage`-d frame; keeps ``BUCKET``."""
    keys, order = list(keys), list(order)
    with_v = staged.withColumn("_v", value)
    w_in = (Window.partitionBy(*keys, BUCKET).orderBy(*[F.col(c) for c in order])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = with_v.withColumn("_run", F.sum("_v").over(w_in))
    summary = with_v.groupBy(*keys, BUCKET).agg(F.sum("_v").alias("_bsum"))
    w_b = _bucket_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    edges = summary.select(*keys, BUCKET, F.coalesce(F.sum("_bsum").over(w_b), F.lit(0)).alias("_before"))
    joined = _join_edges(inner, edges, keys)
    return joined.select(*staged.columns,
                         (F.coalesce(F.col("_run"), F.lit(0)) + F.col("_before")).alias(name))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                bucket: Column, name: str) -> DataFrame:
    """``name`` = sum of ``value`` over the key's rows up to and including this
    one in ``order``."""
    return running_sum_staged(stage(df, keys, bucket), keys, order, value, name).drop(BUCKET)


def running_aggs_staged(staged: DataFrame, keys: Sequence[str], order: Sequence[str],
                        specs: dict[str, tuple[Column, str]]) -> DataFrame:
    """Several running aggregates in one window pass: ``specs`` maps an output
    name to ``(value, "sum" | "max")``; each is the aggregate over the key's
    rows up to and including this one in ``order``. One in-bucket window, one
    per-bucket summary and one edge join for all of them."""
    keys, order = list(keys), list(order)
    fns = {"sum": F.sum, "max": F.max}
    with_v = staged.select("*", *[v.alias(f"_v_{n}") for n, (v, _) in specs.items()])
    w_in = (Window.partitionBy(*keys, BUCKET).orderBy(*[F.col(c) for c in order])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = with_v.select("*", *[fns[k](f"_v_{n}").over(w_in).alias(f"_run_{n}") for n, (_, k) in specs.items()])
    summary = with_v.groupBy(*keys, BUCKET).agg(*[fns[k](f"_v_{n}").alias(f"_b_{n}") for n, (_, k) in specs.items()])
    w_b = _bucket_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    edges = summary.select(*keys, BUCKET, *[fns[k](f"_b_{n}").over(w_b).alias(f"_before_{n}")
                                            for n, (_, k) in specs.items()])
    joined = _join_edges(inner, edges, keys)
    out = []
    for n, (_, k) in specs.items():
        if k == "sum":
            out.append((F.coalesce(F.col(f"_run_{n}"), F.lit(0)) + F.coalesce(F.col(f"_before_{n}"), F.lit(0)))
                       .alias(n))
        else:
            out.append(F.greatest(f"_run_{n}", f"_before_{n}").alias(n))
    return joined.select(*staged.columns, *out)
