"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint is the bitwise majority over the hashes of its word
shingles. Fingerprints are cut into segments. If two differ in at most
``max_distance`` bits, then by the pigeonhole rule they agree in some segment
up to a small radius, so each fingerprint looks up the Hamming balls around
its segments in tables of all fingerprints, and every match is verified over
all bits. No link is lost, and none is found by sampling.

Equal fingerprints are one entry, whatever the number of copies. A segment
value that very many fingerprints share is dealt out as a grid of blocks; a
block returns a spanning forest of its links, so the output stays linear.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, materialise
from strata.llm.components import connected_components

BITS = 64


@dataclass(frozen=True)
class SimHashParams:
    shingle_words: int = 4
    max_distance: int = 4
    seed: int = 42
    segments: int = 3
    # Fingerprints with the same segment value that one task compares at once.
    block: int = 4096


# --- fingerprints -----------------------------------------------------------------------------

def fingerprint(text: str, params: SimHashParams) -> int:
    """Unsigned fingerprint of a whole text; 0 without words.

    Only A-Z are lower-cased, and only the six ASCII white-space bytes part words.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n, k, seed = len(words), params.shingle_words, params.seed
    joined = b" ".join(words)
    if n <= k:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    shingles = n - k + 1
    for at in range(0, shingles, 65_536):
        stop = min(shingles, at + 65_536)
        hashes = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[at:stop].tolist(),
                                                                       ends[at + k - 1:stop + k - 1].tolist())),
                             dtype="<u8", count=stop - at)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > shingles, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, params: SimHashParams, id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, fp): the fingerprint as a signed 64-bit integer. Null texts count as empty."""
    source = docs.select(id_col, *carry, text_col)
    kept = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in (id_col, *carry))

    def run(batch: pa.RecordBatch):
        made = np.array([fingerprint(t or "", params) for t in batch.column(text_col).to_pylist()], dtype=np.uint64)
        yield {**{c: batch.column(c) for c in (id_col, *carry)}, "fp": made.view(np.int64)}

    return map_batches(source, run, f"{kept}, fp bigint")


# --- multi-index search -----------------------------------------------------------------------

def segment_plan(params: SimHashParams) -> list[tuple[int, int, int]]:
    """(shift, width, radius) per segment, so that every close pair meets in one.

    With ``d = max_distance`` and ``m`` segments, let ``r = d // m``. If the first
    ``d - m * r + 1`` segments differed in more than r bits each and the others in
    more than r - 1, the sum would exceed d; hence those radii suffice.
    """
    m, d = params.segments, params.max_distance
    radius, shift, plan = d // m, 0, []
    for s in range(m):
        width = BITS // m + (s < BITS % m)
        own = radius if s <= d - m * radius else radius - 1
        if own >= 0:
            plan.append((shift, width, own))
        shift += width
    return plan


def _ball(width: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` bits among ``width``."""
    masks = {0}
    for _ in range(radius):
        masks |= {x ^ (1 << b) for x in masks for b in range(width)}
    return sorted(masks)


def _segment(fp, shift: int, width: int):
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _neighbours(value, base, masks: list[int]):
    return F.transform(F.array(*[F.lit(x).cast("long") for x in masks]), lambda x: value.bitwiseXOR(x) + base)


def _entries(prints: DataFrame, params: SimHashParams) -> tuple[DataFrame, DataFrame]:
    """(key, fp) rows of the tables, and of the lookups. A key holds segment number and value."""
    fp = F.col("fp")
    tables, lookups = [], []
    for s, (shift, width, radius) in enumerate(segment_plan(params)):
        value, base = _segment(fp, shift, width), F.lit(s << 33).cast("long")
        tables.append(F.array(value + base))
        lookups.append(_neighbours(value, base, _ball(width, radius)))
    return (prints.select(F.explode(F.concat(*tables)).alias("key"), "fp"),
            prints.select(F.explode(F.concat(*lookups)).alias("key"), "fp"))


def links(prints: DataFrame, params: SimHashParams) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` with at most ``max_distance`` bits apart.

    Every close pair is joined by a path of returned links; in segment values
    that few fingerprints share the pairs themselves are returned.
    """
    spark = prints.sparkSession
    tables, lookups = _entries(prints, params)
    hot = materialise(spark, tables.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > params.block)
                      .select("key", F.ceil(F.col("n") / params.block).cast("int").alias("blocks")), "hot-segments")
    both = tables.withColumn("probe", F.lit(False)).unionByName(lookups.withColumn("probe", F.lit(True)))
    cold = both.join(hot, "key", "left_anti").select("key", F.lit(0).alias("cell"), "probe", "fp")
    # A hot value: entry blocks x lookup blocks; each row goes to its block's row or column of the grid.
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda i: F.when(F.col("probe"), i * F.col("blocks") + own).otherwise(own * F.col("blocks") + i))
    warm = both.join(hot, "key").select("key", F.explode(cells.cast("array<int>")).alias("cell"), "probe", "fp")
    dealt = (cold.unionByName(warm).repartition("key", "cell").sortWithinPartitions("key", "cell", "probe"))
    distance = params.max_distance

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            now = np.stack([batch.column(c).cast(pa.int64()).to_numpy(zero_copy_only=False)
                            for c in ("key", "cell", "probe", "fp")])
            held.append(now)
            # Only whole groups are compared; the last one may go on in the next batch.
            joined = np.concatenate(held, axis=1)
            last = np.flatnonzero((joined[0] != joined[0, -1]) | (joined[1] != joined[1, -1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [joined[:, cut:]]
            if cut:
                yield from _compare(joined[:, :cut], distance)
        if held:
            yield from _compare(np.concatenate(held, axis=1), distance)

    found = dealt.mapInArrow(search, "a bigint, b bigint")
    return found


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
# A group with more combinations is compared row by row of its matrix and returns a spanning forest.
_SMALL = 4096
# Combinations expanded at once over many small groups.
_EXPAND = 4_000_000


def _compare(rows: np.ndarray, distance: int) -> Iterator[pa.RecordBatch]:
    """Verified links of whole groups, sorted by key, cell and probe."""
    key, cell, probe, fp = rows
    edges = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1]), [True])))
    starts, stops = edges[:-1], edges[1:]
    probes = np.add.reduceat(probe, starts) if len(starts) else np.zeros(0, dtype=np.int64)
    entries = stops - starts - probes
    combos = entries * probes
    for g in np.flatnonzero(combos > _SMALL):
        mid = starts[g] + entries[g]
        yield from _batches(*_forest(fp[starts[g]:mid], fp[mid:stops[g]], distance))
    small = np.flatnonzero((combos > 0) & (combos <= _SMALL))
    at = 0
    ends = np.cumsum(combos[small])
    while at < len(small):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _EXPAND, side="right")))
        some = small[at:stop]
        count = combos[some]
        group = np.repeat(np.arange(len(some)), count)
        place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        left = starts[some][group] + place % entries[some][group]
        right = starts[some][group] + entries[some][group] + place // entries[some][group]
        a, b = fp[left], fp[right]
        near = (np.bitwise_count((a ^ b).view(np.uint64)) <= distance) & (a < b)
        yield from _batches(a[near], b[near])
        at = stop


def _forest(entries: np.ndarray, probes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever the links between two sets of fingerprints connect.

    Each entry is compared with all lookups once. It links to the lookups that
    no earlier entry reached, and to one lookup of every group of entries that
    reached the others; the output is linear in the two sets.
    """
    owner = np.full(len(probes), -1, dtype=np.int64)
    root = np.arange(len(entries))
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    for e, value in enumerate(entries):
        near = np.flatnonzero(np.bitwise_count((probes ^ value).view(np.uint64)) <= distance)
        owners = owner[near]
        fresh = near[owners < 0]
        met, at = np.unique(root[owners[owners >= 0]], return_index=True)
        chosen = np.concatenate((fresh, near[owners >= 0][at]))
        owner[fresh] = e
        root[np.isin(root, met)] = e
        a.append(np.full(len(chosen), value))
        b.append(probes[chosen])
    left, right = np.concatenate(a), np.concatenate(b)
    return left[left != right], right[left != right]


def _batches(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(a), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(a[at:at + 100_000]), pa.array(b[at:at + 100_000])], schema=_LINKS)


# --- components -------------------------------------------------------------------------------

def _rooted(prints: DataFrame, params: SimHashParams, id_col: str) -> DataFrame:
    """(fp, least, root): distinct fingerprints with their least id and their component's root."""
    spark = prints.sparkSession
    classes = materialise(spark, prints.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprint-classes")
    roots = connected_components(links(classes.select("fp"), params))
    linked = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    return materialise(spark, linked, "fingerprint-roots")


def simhash_components(docs: DataFrame, params: SimHashParams | None = None, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links, the document's
    own included; null ids count for nothing there, and a component of null
    ids has a null ``component_id``. Null and empty texts have fingerprint
    zero and are linked like any other. Repeated rows each get a row. Very long
    texts are shingled whole; a task holds one text and its hashes. Other columns
    are ignored, and an empty table gives an empty result.
    """
    params = params or SimHashParams()
    prints = materialise(docs.sparkSession, fingerprints(docs, params, id_col, text_col), "fingerprints")
    linked = _rooted(prints, params, id_col)
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(ids, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_per_component(docs: DataFrame, params: SimHashParams | None = None, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one for each component, with all their columns.

    The row with the smallest id stays, null ids last; of rows with the same
    id that with the smallest MD5 of its text (null as empty), and of equal
    rows one. Nulls, empty and long texts: as in :func:`simhash_components`.
    """
    params = params or SimHashParams()
    mark = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    marked = docs.select(F.col(id_col).alias("id"), mark.alias("mark"), F.col(text_col).alias("text"))
    prints = materialise(docs.sparkSession, fingerprints(marked, params, "id", "text", ("mark",)), "fingerprints")
    linked = _rooted(prints.select("id", "fp"), params, "id")
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "mark")
    chosen = (prints.join(linked.select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("best"))
              .select(F.col("best.id").alias("chosen_id"), F.col("best.mark").alias("chosen_mark")).distinct())
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), F.col(id_col).alias("id"), mark.alias("mark"))
    kept = rows.join(chosen, F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("mark") == F.col("chosen_mark")), "left_semi")
    return kept.dropDuplicates(["id", "mark"]).select("row.*")
