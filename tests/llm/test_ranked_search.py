"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np

from strata.llm.ranked_search import ImpactLists, SearchParams, best_positions, rank_documents, term_counts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(items, docs, k):
    found = [(doc_id, terms_of(text)) for doc_id, text in docs]
    n_docs, total = sum(1 for _, t in found if t), sum(len(t) for _, t in found)
    df = Counter(t for _, terms in found for t in set(terms))
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, terms in found:
            tf = Counter(terms)
            m = 50 + (50 * len(terms) * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m))
                        for t in set(terms_of(text)) if tf[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=str)


def search(spark, items, docs, **params):
    frame = rank_documents(spark.createDataFrame(items, "item_id long, text string"),
                           spark.createDataFrame(docs, "doc_id long, text string").repartition(3), SearchParams(**params))
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_terms():
    for text in ("Ab-ÄB x1_y z\tÉé", "", " ", "é" * 5 + "\x7f" + "A1", "日本 語"):
        assert term_counts(text) == Counter(t.encode() for t in terms_of(text))
    assert term_counts(None) == Counter()


def test_long_text_is_cut_between_terms(monkeypatch):
    monkeypatch.setattr("strata.llm.ranked_search.PIECE", 7)
    text = "alpha beta " * 50 + "gamma" * 30
    assert term_counts(text) == Counter(t.encode() for t in terms_of(text))


def test_best_positions_against_all_scores():
    rng = np.random.default_rng(5)
    for round_ in range(200):
        n_docs, n_terms = int(rng.integers(1, 400)), int(rng.integers(1, 12))
        held = rng.random((n_docs, n_terms)) < rng.random(n_terms)
        doc, term = np.nonzero(held)
        impact = rng.integers(1, rng.choice([3, 1000]), len(doc))
        weights = rng.integers(0, 50, n_terms)
        floor = rng.integers(1, 20000, int(rng.integers(0, 5)))
        k = int(rng.integers(1, 20))
        scores = np.zeros(n_docs, dtype=np.int64)
        np.add.at(scores, doc, weights[term] * impact)
        lists = ImpactLists(doc, term, impact, n_docs, n_terms)
        docs, found, completed = best_positions(lists, np.arange(n_terms), weights, k, int(rng.choice([1, 4, 32])), floor)
        assert len(set(docs.tolist())) == len(docs) and (scores[docs] == found).all() and completed <= n_docs
        everything = np.sort(np.concatenate([floor, scores[scores > 0]]))
        bar = everything[-k] if len(everything) >= k else 1
        # All ties at the bar are among the candidates.
        assert set(np.flatnonzero(scores >= bar).tolist()) <= set(docs.tolist())


def test_search_stops_before_the_lists_end():
    n = 20_000
    doc = np.repeat(np.arange(n), 2)
    term = np.tile([0, 1], n)
    rng = np.random.default_rng(1)
    impact = rng.integers(1, 100, 2 * n)
    impact[:200] = 1000
    _, _, completed = best_positions(ImpactLists(doc, term, impact, n, 2), np.arange(2), np.array([3, 2]), 50, 32, np.empty(0, np.int64))
    assert completed < 2000


def test_against_plain_scoring(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "É", "x-y"]
    def text(n):
        return " ".join(vocabulary[min(int(rng.expovariate(0.1)), len(vocabulary) - 1)] for _ in range(n))
    docs = [(i, text(rng.choice((1, 5, 30, 200)))) for i in range(300)]
    docs += [(i, "w1 w2 w3") for i in range(300, 360)]          # ties beyond k
    docs += [(7, docs[7][1]), (None, "w1 w40"), (400, None), (401, ""), (402, "--")]
    items = [(i, text(rng.choice((1, 4, 40)))) for i in range(25)]
    items += [(3, items[3][1]), (None, "w5 w6"), (90, None), (91, " "), (92, "nowhere"), (93, "w1 W1 w1")]
    want = plain(items, docs, 50)
    assert search(spark, items, docs) == want
    # Small blocks, several passes and a filter that lets everything in give the same.
    assert search(spark, items, docs, block_postings=200, queries_per_pass=4, filter_bits=2, first_depth=1) == want


def test_empty_tables(spark):
    assert search(spark, [], [(1, "a")]) == [] and search(spark, [(1, "a")], []) == [] and search(spark, [(1, "a")], [(1, None)]) == []


def test_other_columns_do_not_clash(spark):
    items = spark.createDataFrame([(1, "a b", 5, "x")], "item_id long, text string, score int, term string")
    docs = spark.createDataFrame([(1, "a", 2, 3, "q")], "doc_id long, text string, item_id int, rank int, query string")
    assert [tuple(r)[:3] for r in rank_documents(items, docs).collect()] == [(1, 1, 1)]
