"""SimHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from strata.llm import simhash as S
from strata.llm.components import connected_components
from strata.llm.simhash import SimHashParams, fingerprint, simhash_components


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """(id, component) by a search over all pairs of distinct fingerprints."""
    prints = sorted({brute_fingerprint(t or "") for _, t in rows})
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(prints):
        for y in prints[:i]:
            if (x ^ y).bit_count() <= 4:
                parent[find(x)] = find(y)
    least = {}
    for i, t in rows:
        r = find(brute_fingerprint(t or ""))
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, f"{brute_fingerprint(t or ''):016x}", least.get(find(brute_fingerprint(t or "")))) for i, t in rows),
                  key=str)


def near_copies(rng, count, words=60):
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    for _ in range(count):
        copy = list(base)
        if rng.random() < 0.7:
            copy[rng.randrange(words)] = f"x{rng.randrange(10 ** 6)}"
        yield " ".join(copy)


def test_components_match_brute_force(spark):
    rng = random.Random(5)
    texts = [t for _ in range(12) for t in near_copies(rng, 12)]
    texts += [None, "", " \t\n", "One", "one", "one two", "Ä é Z", "a b c d", "A  B\tC\nD", "x " * 5000]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)] + [(1, texts[0]), (None, texts[3]), (None, "nobody else here")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, fingerprint string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash_components(docs).collect()), key=str)
    want = brute_components(rows)
    assert got == want
    assert len({c for _, _, c in want}) < len(texts)


def test_shared_segment_values_are_dealt_out_and_lose_no_link(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    prints = {base ^ sum(1 << b for b in rng.sample(range(22, 64), rng.randrange(1, 9))) for _ in range(400)}
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {}
    for block in (4096, 16):
        found = connected_components(S.links(frame, SimHashParams(block=block)))
        roots[block] = sorted((r.node, r.root) for r in found.collect())
    assert roots[4096] == roots[16]
    parent = {p: p for p in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(signed):
        for y in signed[:i]:
            if ((x ^ y) & (1 << 64) - 1).bit_count() <= 4:
                a, b = sorted((find(x), find(y)))
                parent[b] = a
    want = sorted((p, find(p)) for p in signed if sum(find(q) == find(p) for q in signed) > 1)
    assert roots[16] == want and want


def test_forest_and_pairs_connect_alike():
    rng = np.random.default_rng(3)
    for _ in range(20):
        values = rng.integers(0, 1 << 12, size=40).astype(np.int64)
        entries, probes = np.unique(values[:25]), np.unique(values)
        a, b = S._forest(entries, probes, 2)
        assert all(int(x ^ y).bit_count() <= 2 for x, y in zip(a, b))
        parent = {int(v): int(v) for v in values}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            parent[find(x)] = find(y)
        for x in entries.tolist():
            for y in probes.tolist():
                if (x ^ y).bit_count() <= 2:
                    assert find(x) == find(y)


@pytest.mark.parametrize("segments,distance", [(3, 4), (4, 4), (2, 3), (5, 4), (3, 2)])
def test_segment_plan_covers_every_close_pair(segments, distance):
    plan = S.segment_plan(SimHashParams(segments=segments, max_distance=distance))
    rng = random.Random(segments)
    for _ in range(2000):
        diff = sum(1 << b for b in rng.sample(range(64), distance))
        assert any((diff >> shift & (1 << width) - 1).bit_count() <= radius for shift, width, radius in plan)


def test_fingerprint_matches_the_definition():
    rng = random.Random(2)
    for t in ["", " ", "a", "a b c d e", "A b\x0bc\x0cd E é", "é" * 10, *near_copies(rng, 20)]:
        assert fingerprint(t, SimHashParams()) == brute_fingerprint(t)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_components(docs).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (300, 299)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in connected_components(frame).collect()}
    want = {i: 1 for i in range(1, 61)} | {100 + i: 100 for i in range(50)} | {299: 299, 300: 299}
    assert got == want
