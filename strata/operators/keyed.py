"""Keyed tables: latest state, history, upserts, life-cycle and dedup (B1, B8,
B11, C1-C3).

Every "pick one row per key" here is an aggregate of ``max``/``min`` over a
struct whose leading fields are the ordering columns, never a
``row_number`` window: the aggregate is combined map-side, so a key with a
third of all rows still reaches the shuffle as one partial row per task.
Ties are broken by the remaining struct fields, so results are
deterministic.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import sequence as S
from strata.functions.timecols import epoch_micros


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool,
          few_repeats: bool = False) -> DataFrame:
    """The greatest or smallest row per key. Where keys seldom repeat, folding
    before the shuffle only sorts for nothing: ``few_repeats`` shuffles first."""
    if few_repeats:
        df = df.repartition(*keys)
    keys, order = list(keys), list(order)
    payload = [c for c in df.columns if c not in keys and c not in order]
    if not order and not payload:
        return df.select(*keys).distinct()
    row = F.struct(*[F.col(c) for c in order + payload])
    agg = F.max(row) if latest else F.min(row)
    picked = df.groupBy(*keys).agg(agg.alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in order + payload]).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key (current state)."""
    return _pick(df, keys, order, latest=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], few_repeats: bool = False) -> DataFrame:
    """B1 (batch): keep the first row per key by ``order`` (deduplication)."""
    return _pick(df, keys, order, latest=False, few_repeats=few_repeats)


def deduplicate(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """B1: one row per key; without ``order`` the smallest whole row is kept."""
    return first_per_key(df, keys, order or [])


def rows_to_insert(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                   order: Sequence[str] | None = None) -> DataFrame:
    """C1, the rows to append: incoming rows reduced to one per key (the
    first by ``order``) whose key the target lacks. Only the target's key
    column(s) are read; append the result instead of rewriting the table."""
    keys = list(keys)
    fresh = first_per_key(incoming.select(*target.columns), keys, order or [])
    return fresh.join(target.select(*keys).distinct(), keys, "left_anti")


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                     order: Sequence[str] | None = None) -> DataFrame:
    """C1 (``ON CONFLICT DO NOTHING``): target plus incoming rows whose key is
    new (the table after the insert; :func:`rows_to_insert` for the append)."""
    return target.unionByName(rows_to_insert(target, incoming, keys, order))


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str],
                  updates: dict[str, str], insert_missing: bool = False,
                  change_time: str | None = None) -> DataFrame:
    """Keyed update from a change feed.

    The latest change per key (by ``order``) updates the target columns named
    in ``updates`` (target column -> change column); keys without a change
    keep their values. ``insert_missing`` turns the update into an upsert.
    ``change_time`` (a change column) is returned as ``updated_at``.
    """
    keys, order = list(keys), list(order)
    need = list(dict.fromkeys(keys + order + list(updates.values()) + ([change_time] if change_time else [])))
    latest = latest_per_key(changes.select(*need), keys, order)
    renamed = latest.select(*keys, *[F.col(src).alias(f"_chg_{dst}") for dst, src in updates.items()],
                            *([F.col(change_time).alias("_chg_time")] if change_time else []),
                            F.lit(True).alias("_has_chg"))
    how = "full" if insert_missing else "left"
    joined = target.join(renamed, keys, how)
    cols = []
    for c in target.columns:
        if c in updates:
            cols.append(F.when(F.col("_has_chg"), F.col(f"_chg_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    if change_time:
        cols.append(F.col("_chg_time").alias("updated_at"))
    return joined.select(*cols)


def scd2_history(changes: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str],
                 bucket_seconds: int = S.BUCKET_SECONDS) -> DataFrame:
    """Every change with ``valid_from``, ``valid_to`` (the next change's
    time, null for the last) and ``is_current``, per key.

    Uses the bucketed lead of :mod:`strata.functions.sequence`, so a key with
    very many changes is spread over its time buckets.
    """
    order = [ts] + list(tiebreak)
    nb = S.neighbors(changes, keys, order, [], S.time_bucket(changes, ts, bucket_seconds), prev=False)
    return nb.select(*changes.columns, F.col(ts).alias("valid_from"), F.col(f"next.{ts}").alias("valid_to"),
                     F.col("next").isNull().alias("is_current"))


def transition_violations(changes: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str],
                          status: str, allowed: Iterable[tuple[str, str]], allow_same: bool = True,
                          allow_initial: Iterable[str] | None = None,
                          needs: dict[str, Column] | None = None,
                          bucket_seconds: int = S.BUCKET_SECONDS) -> DataFrame:
    """Changes whose (previous status, status) pair is not allowed.

    The allowed pairs are a constant list compiled into the predicate (no
    join). ``allow_initial`` (optional) restricts the first status of a key.
    ``needs`` (optional) gives, for a previous status, a condition on the
    change row without which the status may not be left (an order leaves
    PLACED only once it is paid). Output: the change row with ``prev_status`` and ``prev_ts``.
    """
    order = [ts] + list(tiebreak)
    pairs = sorted({f"{a}\u0000{b}" for a, b in allowed})
    nb = S.neighbors(changes, keys, order, [status], S.time_bucket(changes, ts, bucket_seconds), nxt=False)
    prev_status = F.col(f"prev.{status}")
    cur = F.col(status)
    ok_pair = F.concat(prev_status, F.lit("\u0000"), cur).isin(*pairs) if pairs else F.lit(False)
    if allow_same:
        ok_pair = ok_pair | (prev_status == cur)
    for left, condition in (needs or {}).items():
        ok_pair = ok_pair & ((prev_status != F.lit(left)) | (cur == F.lit(left)) | F.coalesce(condition, F.lit(False)))
    first_ok = F.lit(True) if allow_initial is None else cur.isin(*list(allow_initial))
    ok = F.when(F.col("prev").isNull(), first_ok).otherwise(F.coalesce(ok_pair, F.lit(False)))
    return nb.where(~ok).select(*changes.columns, prev_status.alias("prev_status"),
                                F.col(f"prev.{ts}").alias("prev_ts"))


def sessionize(events: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str],
               gap_seconds: int, bucket_seconds: int = S.BUCKET_SECONDS) -> DataFrame:
    """``session_start`` per event: a new session starts when the gap to
    the key's previous event exceeds ``gap_seconds``; a session is then
    ``(key, session_start)``.

    One shuffle of the events on ``(key, time bucket)`` and one window pass:
    inside a bucket, ``lag`` gives the gap and a running max the latest start
    so far. A per-bucket summary (first and last time, latest inner start)
    decides across bucket edges whether a bucket's first event starts a
    session and what the latest start before the bucket is; the event's
    session start is the greatest of the three.
    """
    keys = list(keys)
    order = [ts] + list(tiebreak)
    gap_us = F.lit(gap_seconds * 1_000_000)
    staged = S.stage(events.withColumn("_us", epoch_micros(events, ts)), keys,
                     S.time_bucket(events, ts, bucket_seconds))
    w = Window.partitionBy(*keys, S.BUCKET).orderBy(*[F.col(c) for c in order])
    prev_us = F.lag("_us").over(w)
    inner = staged.withColumn("_prev_us", prev_us)
    inner_start = F.when(F.col("_prev_us").isNotNull() & (F.col("_us") - F.col("_prev_us") > gap_us), F.col(ts))
    inner = inner.withColumn("_run_start", F.max(inner_start).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    summary = inner.groupBy(*keys, S.BUCKET).agg(
        F.min(F.struct("_us", *order)).alias("_first"), F.max("_us").alias("_last_us"),
        F.max("_run_start").alias("_inner_max"))
    w_b = (Window.partitionBy(*keys).orderBy(S.BUCKET) if keys else Window.orderBy(S.BUCKET))
    prev_last = F.lag("_last_us").over(w_b)
    first_starts = prev_last.isNull() | (F.col("_first._us") - prev_last > gap_us)
    edges = summary.select(*keys, S.BUCKET, F.when(first_starts, F.col(f"_first.{ts}")).alias("_first_start"),
                           "_inner_max")
    edges = edges.select(*keys, S.BUCKET, "_first_start", F.max(F.greatest("_first_start", "_inner_max")).over(
        w_b.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    joined = inner.join(edges, [*keys, S.BUCKET], "left")
    start = F.greatest("_run_start", "_first_start", "_before").alias("session_start")
    return joined.select(*events.columns, start)
