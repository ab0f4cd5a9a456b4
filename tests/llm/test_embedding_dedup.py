"""Embedding near-duplicates against all pairs."""

import math

import numpy as np

from strata.llm.embedding_dedup import NearDupParams, near_duplicates


def brute(rows):
    def clean(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = {i: np.array(v, dtype="f8") / np.linalg.norm(np.array(v, dtype="f8")) for i, v in rows if i is not None and clean(v)}
    ids = sorted(unit)
    linked = {i: [j for j in ids if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9] for i in ids}
    out = {}
    for i, _ in rows:
        if i is None:
            continue
        reach, queue = {i}, [i]
        while queue:
            for j in linked.get(queue.pop(), []):
                if j not in reach:
                    reach.add(j)
                    queue.append(j)
        out[i] = (len(linked.get(i, [])), min(reach), min(reach) == i)
    return out


def vectors(count=300, dim=32, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < count:
        centre = rng.standard_normal(dim)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((centre + rng.standard_normal(dim) * rng.uniform(0.01, 0.4)).astype("f4").astype(float).tolist())
    rows += [rows[3]] * 4 + [None, [], [0.0] * dim, [math.nan] * dim, [math.inf] + [0.0] * (dim - 1), [None] + [1.0] * (dim - 1)]
    rows += [[1.0, 2.0], [2.0, 4.0], [1e-30, 2e-30], [-0.0] * (dim - 1) + [1.0], [0.0] * (dim - 1) + [1.0]]
    return [(int(i) * 5 + 2, v) for i, v in enumerate(rows)]


def got_of(spark, rows, params):
    frame = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<float>, n_links string")
    return near_duplicates(frame.repartition(4), params).collect()


def test_links_and_components_match_all_pairs(spark):
    rows = vectors()
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    # So many tables that a missed pair is out of the question.
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got_of(spark, rows, NearDupParams(recall=1 - 1e-12))}
    assert got == want
    assert sum(n for n, _, _ in want.values()) > 300


def test_large_buckets_are_dealt_out(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(24)
    rows = [(i, (centre + rng.standard_normal(24) * 0.25).astype("f4").astype(float).tolist()) for i in range(220)]
    want = brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got_of(spark, rows, NearDupParams(recall=1 - 1e-12, block=16))}
    assert got == want


def test_default_recall_and_no_false_link(spark):
    rows = vectors(600, seed=8)
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    got = {r.vec_id: r.n_links for r in got_of(spark, rows, NearDupParams())}
    assert all(got[i] <= n for i, (n, _, _) in want.items())
    assert sum(got.values()) >= 0.95 * sum(n for n, _, _ in want.values())


def test_rows_without_ids_and_shared_ids(spark):
    v, w = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    got = got_of(spark, [(None, v), (1, v), (2, v), (7, w), (7, w)], NearDupParams())
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == sorted(
        [(None, 0, None, False), (1, 1, 1, True), (2, 1, 1, False), (7, 1, 7, True), (7, 1, 7, True)], key=str)


def test_empty_table(spark):
    assert got_of(spark, [], NearDupParams()) == []


def test_a_row_of_the_shuffle_does_not_grow_with_the_tables(spark):
    from strata.llm import embedding_dedup as X
    rows = spark.createDataFrame([(i, [float(i % 7), float(i), 1.0]) for i in range(1, 40)], "vec_id long, embedding array<double>")
    clean = X.clean_vectors(rows).selectExpr("vec_id AS node", "1L AS copies", "vector")
    few, many = (X._bucket_rows(clean, 8, tables, 7) for tables in (3, 40))
    size = "max(length(bucket) + length(vector))"
    assert set(few.columns) == {"bucket", "table", "node", "copies", "vector"} and many.count() == 40 * 39
    assert many.selectExpr(size).first()[0] <= few.selectExpr(size).first()[0] + 1


def test_hashes_do_not_depend_on_the_rows_beside(spark):
    from strata.llm import embedding_dedup as X
    rows = np.random.default_rng(3).standard_normal((200, 48))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    whole = X._hashes(rows, 12, 20, 7)
    assert all((X._hashes(rows[i:i + 1], 12, 20, 7, 9)[0] == whole[i, :9]).all() for i in range(200))
