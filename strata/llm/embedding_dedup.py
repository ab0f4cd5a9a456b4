"""Embedding near-duplicates by random-hyperplane hashing and exact verification.

Every table hashes a vector to the signs of its products with some random
hyperplanes. Vectors that share a table's hash are compared by exact cosine in
double precision; nothing below the threshold is linked. The number of signs
follows the number of vectors, so that buckets stay of bounded mean size, and
the number of tables follows from the recall wanted right at the threshold
(closer pairs are found more surely).

Equal vectors are one entry with a count. A bucket with very many entries is
dealt out as a grid of blocks. A pair counts in the first table that finds it,
so links are counted without ever being listed, and each block returns link
counts and a spanning forest: output linear in its rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, materialise
from strata.llm.components import connected_components


@dataclass(frozen=True)
class NearDupParams:
    threshold: float = 0.9
    # Chance that a pair right at the threshold shares a bucket of some table.
    recall: float = 0.99
    # Entries per bucket that random vectors would give.
    bucket: int = 64
    # Entries that one cell of a large bucket's grid compares with as many others.
    block: int = 1024
    seed: int = 7

    def signs(self, vectors: int) -> int:
        """Hyperplanes per table for so many distinct vectors."""
        return min(62, max(4, math.ceil(math.log2(max(1, vectors) / self.bucket))))

    def tables(self, signs: int) -> int:
        """Tables that give the recall at the threshold."""
        agree = 1 - math.acos(self.threshold) / math.pi
        return math.ceil(math.log(1 - self.recall) / math.log(1 - agree ** signs))


def clean_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, key, vector): a digest that equal vectors share, and the doubles as bytes.

    Both are null for vectors that link with nothing: null, empty, zero, with
    null or non-finite components, or without an id.
    """
    source = vectors.select(id_col, vector_col)

    def run(batch: pa.RecordBatch):
        keys, data = [], []
        for vec_id, value in zip(batch.column(id_col), batch.column(vector_col)):
            array = None
            if vec_id.is_valid and value.is_valid and value.values.null_count == 0 and len(value.values):
                # Adding zero turns negative zeros into zeros.
                array = value.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
                peak = np.abs(array).max() if np.isfinite(array).all() else 0.0
                array = array if peak > 0 else None
            keys.append(None if array is None else hashlib.md5(array.tobytes(), usedforsecurity=False).digest())
            data.append(None if array is None else array.tobytes())
        yield {id_col: batch.column(id_col), "key": pa.array(keys, pa.binary()), "vector": pa.array(data, pa.binary())}

    return map_batches(source, run, f"`{id_col}` bigint, key binary, vector binary")


def _unit(data: list[bytes]) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that no square over- or underflows."""
    rows = np.frombuffer(b"".join(data), dtype="<f8").reshape(len(data), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


# Scales at which unit vectors and hyperplanes are whole numbers: their products are exact in doubles, so the side of
# a hyperplane does not depend on the order of a sum, and a hash found again in another task is the same.
ROW_SCALE, PLANE_SCALE = 1 << 20, 1 << 10


@lru_cache(maxsize=4)
def _planes(dimension: int, signs: int, tables: int, seed: int) -> np.ndarray:
    return np.rint(np.random.default_rng([seed, dimension]).standard_normal((dimension, tables * signs)) * PLANE_SCALE)


def _hashes(rows: np.ndarray, signs: int, tables: int, seed: int, upto: int | None = None) -> np.ndarray:
    """hashes[i, t]: the signs of row i in table t as an integer, for the first ``upto`` tables."""
    upto = tables if upto is None else upto
    planes = _planes(rows.shape[1], signs, tables, seed)[:, :upto * signs]
    bits = (np.rint(rows * ROW_SCALE) @ planes >= 0).reshape(len(rows), upto, signs)
    return bits @ (np.int64(1) << np.arange(signs, dtype=np.int64))


def _bucket_rows(classes: DataFrame, signs: int, tables: int, seed: int) -> DataFrame:
    """(bucket, table, node, copies, vector): a row per distinct vector and table.

    A row holds nothing of the other tables; the few hashes that are asked for later are found again from the vector.
    """
    def run(batch: pa.RecordBatch):
        nodes, copies, data = (batch.column(c).to_pylist() for c in ("node", "copies", "vector"))
        lengths = np.array([len(d) for d in data])
        for length in np.unique(lengths):
            some = np.flatnonzero(lengths == length)
            # A slice of rows at a time: the tables multiply them.
            for at in range(0, len(some), 512):
                part = some[at:at + 512]
                vectors = [data[i] for i in part]
                hashes = _hashes(_unit(vectors), signs, tables, seed)
                for t in range(tables):
                    # Table, dimension and hash in one key.
                    yield {"bucket": [f"{t}:{length}:{h}" for h in hashes[:, t].tolist()],
                           "table": [t] * len(part), "node": [nodes[i] for i in part],
                           "copies": [copies[i] for i in part], "vector": vectors}

    return map_batches(classes.select("node", "copies", "vector"), run,
                       "bucket string, table int, node bigint, copies bigint, vector binary")


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def found_links(classes: DataFrame, params: NearDupParams) -> DataFrame:
    """(a, b, n) over distinct vectors ``node, copies, vector``.

    Rows with b link a and b; rows without say that a has links to n vectors
    (copies counted). Summed over all rows every found pair counts once.
    """
    spark = classes.sparkSession
    count = classes.count()
    signs = params.signs(count)
    tables = params.tables(signs)
    rows = _bucket_rows(classes, signs, tables, params.seed)
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > params.block)
    hot = materialise(spark, sizes.select("bucket", F.ceil(F.col("size") / params.block).cast("int").alias("blocks")),
                      "hot-buckets")
    cold = rows.join(hot, "bucket", "left_anti").select("*", F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit(0).alias("own"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # A block meets every block: cells (i, j) with i <= j that hold its own number.
    grid = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                       lambda j: F.struct(F.least(own, j).alias("row"), F.greatest(own, j).alias("col")))
    warm = rows.join(hot, "bucket").select(*rows.columns, own.alias("own"), F.explode(grid).alias("cell"))
    warm = warm.select(*rows.columns, F.col("cell.row").alias("row"), F.col("cell.col").alias("col"), "own")
    dealt = (cold.unionByName(warm).repartition("bucket", "row", "col").sortWithinPartitions("bucket", "row", "col"))
    threshold, seed = params.threshold, params.seed

    def earlier(unit: np.ndarray, table: int) -> np.ndarray:
        return _hashes(unit, signs, tables, seed, table)

    names = ("bucket", "row", "col", "own", "table", "node", "copies", "vector")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in names)):
                if values[:3] != last:
                    if len(held) > 1:
                        yield from _cell(held, threshold, earlier)
                    last, held = values[:3], []
                held.append(values)
        if len(held) > 1:
            yield from _cell(held, threshold, earlier)

    return dealt.mapInArrow(search, "a bigint, b bigint, n bigint")


def _slices(i: np.ndarray, j: np.ndarray, size: int = 65_536) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(i), size):
        yield i[at:at + size], j[at:at + size]


def _cell(rows: list[tuple], threshold: float, earlier: Callable[[np.ndarray, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Links within a bucket, or between the two blocks of a cell."""
    _, row, col, _, table, _, _, _ = rows[0]
    nodes = np.array([r[5] for r in rows], dtype=np.int64)
    copies = np.array([r[6] for r in rows], dtype=np.int64)
    unit = _unit([r[7] for r in rows])
    own = np.array([r[3] for r in rows])
    left = np.flatnonzero(own == row)
    right = np.flatnonzero(own == col)
    links = np.zeros(len(rows), dtype=np.int64)
    group = np.arange(len(rows))
    a: list[int] = []
    b: list[int] = []
    for at in range(0, len(left), 256):
        some = left[at:at + 256]
        near = unit[some] @ unit[right].T >= threshold
        if row == col:
            near &= some[:, None] < right[None, :]
        i, j = np.nonzero(near)
        i, j = some[i], right[j]
        if table and len(i):
            # Pairs that an earlier table put together were counted there.
            ends, at_ends = np.unique(np.concatenate((i, j)), return_inverse=True)
            hashes = earlier(unit[ends], table)
            fresh = np.concatenate([~(hashes[x] == hashes[y]).any(axis=1) for x, y in _slices(at_ends[:len(i)], at_ends[len(i):])])
            i, j = i[fresh], j[fresh]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        for x in np.unique(i):
            # One link to each group that x does not belong to yet.
            others = j[i == x]
            groups, first = np.unique(group[others], return_index=True)
            new = groups != group[x]
            a.extend([int(nodes[x])] * int(new.sum()))
            b.extend(nodes[others[first[new]]].tolist())
            group[np.isin(group, groups)] = group[x]
    some = np.flatnonzero(links)
    if len(some):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((nodes[some], np.array(a, dtype=np.int64)))),
             pa.array([None] * len(some) + b, pa.int64()),
             pa.array(links[some].tolist() + [None] * len(a), pa.int64())], schema=_FOUND)


def near_duplicates(vectors: DataFrame, params: NearDupParams | None = None, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    ``n_links`` counts other vectors linked directly, copies included;
    ``component_id`` is the smallest id reachable over links, its own
    included; ``kept`` says that it is the vector's own. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, and
    so do vectors of different lengths. A row without an id links with nothing
    and is not kept. Rows that share an id are one node: their links add up.
    An empty table gives an empty result; other columns are ignored.
    """
    params = params or NearDupParams()
    spark = vectors.sparkSession
    clean = materialise(spark, clean_vectors(vectors.select(F.col(id_col).cast("long").alias("id"),
                                                            F.col(vector_col).alias("value")), "id", "value"), "vectors")
    classes = materialise(spark, clean.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.max("vector").alias("vector")), "vector-classes")
    found = materialise(spark, found_links(classes, params), "vector-links")
    roots = connected_components(found.where(F.col("b").isNotNull()).select("a", "b"))
    links = found.where(F.col("n").isNotNull()).groupBy("a").agg(F.sum("n").alias("n"))
    named = (classes.select("key", "node", "copies").join(links.withColumnRenamed("a", "node"), "node", "left")
             .join(roots, "node", "left")
             .select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("root", "node").alias("component_id")))
    return clean.select("id", "key").join(named, "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(False)).alias("kept"))
