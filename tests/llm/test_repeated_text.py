"""Removal of repeated strings against a table of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strata.llm import repeated_text as R
from strata.llm.repeated_text import RepeatParams, remove_repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        cover = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                cover[i:i + length] = b"\1" * length
        spans = sum(c and (i == 0 or not cover[i - 1]) for i, c in enumerate(cover))
        rest = bytes(x for x, c in zip(b, cover) if not c)
        out.append((len(b), len(b) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(length // 3), prose(length)
    texts = [None, "", "short", prose(length), passage, passage + "x", "x" + passage, "=" * (3 * length), "ab" * (2 * length),
             prose(40) + passage + prose(60), prose(5) + passage + prose(9) + passage, "\x00" * (length + 5), passage[:length // 2]]
    for _ in range(14):
        words = base.split(" ")
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    # Exactly as long as the least repeat, one less, and one more.
    for extra in (-1, 0, 1):
        piece = hashlib.sha512(str(extra).encode()).hexdigest() * 8
        piece = piece[:length + extra]
        texts += [prose(11) + "|" + piece + "|" + prose(12), prose(13) + "/" + piece + "/" + prose(8)]
    texts += [texts[3], texts[20], texts[20]]
    return texts


@pytest.mark.parametrize("length,seed,sampling", [(400, 1, "least"), (100, 2, "least"), (64, 3, "least"), (400, 4, "cover"),
                                                  (64, 5, "cover")])
def test_matches_all_strings(spark, length, seed, sampling):
    texts = corpus(seed, length)
    rows = [(i * 2 + 1, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_spans string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in remove_repeats(docs, RepeatParams(length, sampling)).collect()}
    want = dict(zip((r[0] for r in rows), brute(texts, length)))
    assert got == want
    assert sum(v[1] for v in want.values()) > 0


@pytest.mark.parametrize("pairs,group", [(2, 4096), (2, 3), (1000, 5)])
def test_every_way_of_comparing_starts_agrees(spark, monkeypatch, pairs, group):
    monkeypatch.setattr(R, "PAIRS", pairs)
    monkeypatch.setattr(R, "GROUP", group)
    rng = random.Random(7)
    base = [f"{rng.randrange(10 ** 5)}" for _ in range(200)]
    texts = []
    for _ in range(25):
        words = list(base)
        for _ in range(rng.randrange(1, 7)):
            words[rng.randrange(len(words))] = str(rng.randrange(10 ** 5))
        texts.append(" ".join(words))
    params = RepeatParams(100)
    contexts_ways = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(contexts_ways, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs, params).collect()}
    assert got == dict(enumerate(brute(texts, 100)))


@pytest.mark.parametrize("sampling", ["least", "cover"])
@pytest.mark.parametrize("group", [2, 4096])
def test_a_start_is_no_repeat_of_itself(spark, monkeypatch, sampling, group):
    # Several samples of the cover have one name here and answer for one start.
    monkeypatch.setattr(R, "GROUP", group)
    rng = random.Random(8)
    texts = ["ab" * 150 + "".join(rng.choice("cdefgh") for _ in range(n)) for n in (60, 90, 120)] + corpus(6, 100)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in remove_repeats(docs, RepeatParams(100, sampling)).collect()}
    assert got == dict(enumerate(brute(texts, 100)))


@pytest.mark.parametrize("most", [13, 60, 73, 200, 400])
def test_difference_covers_cover(most):
    v, members = R.difference_cover(most)
    assert v <= most
    assert all(any((i + d) % v in members and (j + d) % v in members for d in range(v))
               for i in range(0, v, 5) for j in range(v))


def test_samples_agree_inside_equal_strings():
    params = RepeatParams(100)
    rng = np.random.default_rng(0)
    near, far = params.reach
    for _ in range(50):
        common = bytes(rng.integers(97, 100, size=100, dtype=np.uint8))
        offsets = []
        for _ in range(2):
            lead, tail = (bytes(rng.integers(97, 123, size=int(n), dtype=np.uint8)) for n in rng.integers(0, 300, size=2))
            at = R.samples(lead + common + tail, params) - len(lead)
            offsets.append(int(at[at >= near][0]))
        assert offsets[0] == offsets[1] and near <= offsets[0] <= far


def test_kept_text_drops_broken_characters_and_keeps_columns(spark):
    passage = "é" * 210
    docs = spark.createDataFrame([(1, "a" + passage + "z", "en"), (2, "b" + passage + "y", "fr"), (3, None, "de"), (None, "q", "x")],
                                 "doc_id long, text string, lang string")
    got = {r.doc_id: (r.kept_text, r.lang) for r in remove_repeats(docs, RepeatParams(400), carry=("lang",), kept="text").collect()}
    assert got == {1: ("az", "en"), 2: ("by", "fr"), 3: ("", "de"), None: ("q", "x")}


def test_copies_are_sampled_once(spark):
    params = RepeatParams(100)
    rng = random.Random(9)
    texts = [" ".join(str(rng.randrange(10 ** 6)) for _ in range(80)) for _ in range(2)]
    docs = spark.createDataFrame([(i, texts[0]) for i in range(300)] + [(300, texts[1]), (301, texts[0] + texts[1])],
                                 "doc_id long, text string").repartition(6)
    folded = R._distinct_texts(docs, params, "text")
    assert sorted(r.copies for r in folded.collect()) == [1, 1, 300]
    samples = R._named_samples(folded, params).collect()
    assert len({(r.text_key, r.at) for r in samples}) == len(samples)
    got = {r.doc_id: (r.n_removed, r.n_bytes) for r in remove_repeats(docs, params).collect()}
    assert got == {i: (len(t), len(t)) for i, t in enumerate([texts[0]] * 300 + [texts[1], texts[0] + texts[1]])}


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
