"""Targets against plain resharing, copies against their bounds, steps against the closed form."""

import math
import random
import re

import pytest

from pyspark.sql import functions as F

from strata.llm.source_mix import mix_sources, newton_multipliers, take_copies

WEIGHTS = (5.0, 2.0, 1.0)


def brute_targets(sizes, cap=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            free.discard(s)
        left = sum(sizes.values()) - sum(out.values())
    return out


def documents(seed, sources, count):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        source = sources[0] if rng.random() < 0.4 else rng.choice(sources)
        rows.append((i, " ".join("w" * rng.randrange(1, 4) for _ in range(int(rng.paretovariate(1.2) * 5))), source))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, size string")


@pytest.mark.parametrize("sources", [["a", "B", "é", None, "z"], ["one"], [f"s{i}" for i in range(23)]])
def test_targets_and_copies(spark, sources):
    rows = documents(len(sources), sources, 700) + [(None, "no id here", sources[0]), (5, None, sources[-1]), (6, "", sources[0]),
                                                    (7, " \x85 \x1c\t", sources[0]), (8, "x y", sources[0]), (8, "x y", sources[0])]
    got = mix_sources(frame(spark, rows), WEIGHTS).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = brute_targets(sizes)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s, t in want.items():
        # Whole copies of a document that is most of its source leave half of it; any other source comes near.
        assert abs(taken[s] - t) <= (largest[s] / 2 if largest[s] > 0.2 * t else max(3, 0.02 * t)), (s, taken[s], t)


def test_reruns_agree_whatever_the_partitions(spark):
    rows = documents(3, ["a", "b", "c"], 300)
    key = lambda r: (r.doc_id, r.taken)
    first = sorted(map(key, mix_sources(frame(spark, rows), WEIGHTS).collect()))
    again = sorted(map(key, mix_sources(frame(spark, rows).repartition(7), WEIGHTS).collect()))
    assert first == again


def words_at(cells, scale, multiplier, cap):
    return sum(n * min(cap, math.exp(min(5.0, multiplier * size / scale))) * size for size, n in cells)


@pytest.mark.parametrize("cap", [3.0, 1.5])
def test_newton_reaches_the_minimum_of_the_dual(spark, cap):
    """Multipliers against bisection, for targets from almost nothing to almost the cap."""
    rng = random.Random(9)
    cells = {s: [(int(rng.paretovariate(1.1) * 3) + i, rng.randrange(1, 40)) for i in range(0, 60, rng.randrange(1, 4))]
             for s in ("a", "b", "c", "d", "e", "f", "g")}
    cells = {s: list(dict(v).items()) for s, v in cells.items()}
    ratios = dict(zip(cells, (1e-3, 0.05, 0.5, 1.0, 0.8 * cap, 0.999 * cap, cap)))
    size = {s: sum(k * n for k, n in v) for s, v in cells.items()}
    sources = spark.createDataFrame([(s, size[s], ratios[s] * size[s]) for s in cells] + [("empty", 0, 0.0)],
                                    "source string, source_size long, target double")
    frame_ = spark.createDataFrame([(s, k, n) for s, v in cells.items() for k, n in v] + [("empty", 0, 5)], "source string, size long, n long")
    got = {r.source: r for r in newton_multipliers(sources, frame_, cap).collect()}
    assert got["empty"]["lambda"] is None and got["g"]["lambda"] is None
    for s in "abcdef":
        scale = size[s] / sum(n for _, n in cells[s])
        low, high = -50 * scale, math.log(cap) * scale + 1
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if words_at(cells[s], scale, mid, cap) < ratios[s] * size[s] else (low, mid)
        assert math.isclose(words_at(cells[s], scale, got[s]["lambda"], cap), ratios[s] * size[s], rel_tol=1e-8)
        assert math.isclose(got[s]["lambda"], low, rel_tol=1e-5, abs_tol=1e-6), s


def test_rates_tilt_per_document(spark):
    """Of one source, longer documents have rates exponentially above (or below) those of shorter ones, up to the cap."""
    rows = [(i, " ".join(["w"] * (1 + i % 50)), "grows") for i in range(1000)] + [(1000 + i, " ".join(["w"] * (1 + i % 50)), "shrinks") for i in range(2000)]
    got = mix_sources(frame(spark, rows), (1.0, 1.0)).collect()
    for source, sign in (("grows", 1), ("shrinks", -1)):
        rate = {r.size: r.rate for r in got if r.source == source}
        slopes = {s: math.log(x) / s for s, x in rate.items() if 0.01 < x < 3}
        assert len(slopes) > 3 and all(v * sign > 0 for v in slopes.values())
        assert max(slopes.values()) - min(slopes.values()) < 1e-3
    assert max(r.rate for r in got) <= 3


def test_a_third_of_the_rows_without_ids_is_spread(spark):
    """Equal rows with null ids are counted, and numbered in buckets, never as one window."""
    rows = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(
        F.concat_ws(" ", F.lit("text"), F.col("id"))).alias("text"), F.lit("s").alias("source"))
    mixed = mix_sources(rows, (1.0,)).collect()
    assert len(mixed) == 6000 and sum(r.taken for r in mixed) == sum(r.size for r in mixed)
    from strata.llm import source_mix as X
    measured = rows.select(F.col("doc_id").alias("id"), "source", X.word_count(F.col("text")).alias("size"), F.md5("text").alias("text_key"),
                           F.monotonically_increasing_id().alias("row"))
    groups = measured.groupBy("source", "size", "id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    placed = X._places(measured, groups).where("size = 3").orderBy("place").collect()
    assert [r.place for r in placed] == list(range(1, 2001))
    plan = X._places(measured, groups)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") == 1 and "salt" in plan


def test_sources_without_words(spark):
    got = mix_sources(frame(spark, [(1, None, "a"), (2, "", "b")]), WEIGHTS).collect()
    assert [(r.size, r.target, r.copies, r.taken) for r in got] == [(0, 0.0, 1, 0)] * 2


def test_rows_are_taken_as_often_as_their_copies(spark):
    rows = documents(6, ["a", "b", None], 200) + [(3, "same same", "a"), (3, "same also", "a"), (3, "same same", "a")]
    mixed = mix_sources(frame(spark, rows), WEIGHTS).collect()
    taken = take_copies(frame(spark, rows), WEIGHTS)
    assert taken.columns == ["doc_id", "text", "source", "size"]
    got = taken.collect()
    assert len(got) == sum(r.copies for r in mixed)
    count = {}
    for r in got:
        count[r.doc_id, r.source] = count.get((r.doc_id, r.source), 0) + 1
    want = {}
    for r in mixed:
        want[r.doc_id, r.source] = want.get((r.doc_id, r.source), 0) + r.copies
    assert count == {k: v for k, v in want.items() if v}


def test_main_path_has_no_python(spark):
    plan = mix_sources(frame(spark, documents(1, ["a", "b"], 30)), WEIGHTS)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    assert mix_sources(frame(spark, []), WEIGHTS).collect() == []
