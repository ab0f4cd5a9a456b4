"""Ranked lexical search by the Best Position Algorithm over impact lists.

One pass over the documents writes a compact index: for each document its
length and, of its terms, those that some query may hold. A task that reads a
part of the index sorts every term's postings there by impact, best first,
and answers each query over its own documents:

* sorted access reads all lists of the query in step, from the best impacts on;
* every document met is completed at once by direct access, which finds its
  place in all other lists of the query, and its whole score;
* those places count as seen too. The best position of a list is the last one
  up to which all positions are seen, in whatever way; it runs ahead of the
  position last read;
* no document that is still unseen can score more than the impacts at the best
  positions add up to. The search stops when that sum is strictly below the
  k-th best score, so that ties are never cut.

The k best documents so far stay with the task and raise the bar for its next
block. The tasks' answers are merged by rank. Documents are never shuffled, the
query set is read in blocks of a bounded number of queries, and what picks the
index's terms is a bitmap of fixed size: terms let in by chance fall out
when document frequencies are joined.

Defined results: a document whose text is null or holds no term is in no
list and counts for nothing. A query without terms, or none of whose terms
occurs, has no rows. Every row of either table stands for itself: repeated
document rows are ranked each, repeated query rows are answered each. Equal
scores are ranked by id, null ids last. Columns other than ids and texts are
ignored. Very long texts are counted in pieces cut between terms. An empty
table on either side gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.llm.common import map_batches, materialise

# Fixed values of the ranking formula.
IMPACT_SCALE, TF_SCALE, LENGTH_SCALE, WEIGHT_SCALE = 1_000_000_000, 1000, 20, 1000
LENGTH_FLOOR, LENGTH_SLOPE = 50, 50

# A term is a run of digits, letters and non-ASCII characters; in UTF-8 all bytes from 0x80 on belong to one.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
PIECE = 1 << 22


@dataclass(frozen=True)
class SearchParams:
    k: int = 50
    # The filter's bits, a power of two; its size does not grow with the queries.
    filter_bits: int = 1 << 21
    # Queries that a pass over the index answers, and go through the driver at a time.
    queries_per_pass: int = 2048
    # Postings of a block, which bound a task's memory, and the depth of the first round of sorted access.
    block_postings: int = 2_000_000
    first_depth: int = 32


def term_counts(text: str | None) -> Counter[bytes]:
    """How often each term occurs in a whole text."""
    counts: Counter[bytes] = Counter()
    if text:
        data = text.encode().translate(_TERM_BYTES)
        at = 0
        while at < len(data):
            end = data.find(b" ", at + PIECE) if at + PIECE < len(data) else -1
            end = len(data) if end < 0 else end
            counts.update(data[at:end].split())
            at = end
    return counts


def term_weight(n_docs: int, doc_freq: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * doc_freq + 1)))


def length_norm(length: int, n_docs: int, all_terms: int) -> int:
    return LENGTH_FLOOR + (LENGTH_SLOPE * length * n_docs) // max(all_terms, 1)


# --- one block of documents -------------------------------------------------------------------

class ImpactLists:
    """The postings of a block of documents: by term in order of impact, and by document for direct access."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int) -> None:
        """``doc`` ascending; ``impact`` without the term's weight, which does not change a list's order."""
        order = np.lexsort((-impact, term))
        self.n_docs = n_docs
        self.starts = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.doc, self.impact = doc[order], impact[order]
        # By document: the term and the place in its list of each posting.
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.doc_starts = np.searchsorted(doc, np.arange(n_docs + 1))
        self.doc_terms, self.doc_places = term, place

    def direct(self, docs: np.ndarray, list_of_term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All postings of ``docs`` in a query's lists: index into ``docs``, list number, place."""
        sizes = self.doc_starts[docs + 1] - self.doc_starts[docs]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1])) + np.repeat(self.doc_starts[docs] - (ends - sizes), sizes)
        lists = list_of_term[self.doc_terms[at]]
        hit = np.flatnonzero(lists >= 0)
        owner = np.searchsorted(ends, hit, side="right")
        return owner, lists[hit], self.doc_places[at[hit]]


def best_positions(lists: ImpactLists, terms: np.ndarray, weights: np.ndarray, k: int, first_depth: int,
                   floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents of a block that may be among the ``k`` best, their scores, and how many were completed.

    ``floor`` holds the scores known from other blocks.
    """
    begin, size = lists.starts[terms], lists.starts[terms + 1] - lists.starts[terms]
    there = (size > 0) & (weights > 0)
    terms, weights, begin, size = terms[there], weights[there], begin[there], size[there]
    if not len(terms):
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    list_of_term = np.full(len(lists.starts) - 1, -1, dtype=np.int64)
    list_of_term[terms] = np.arange(len(terms))
    offset = np.cumsum(size) - size
    seen_place = np.zeros(int(size.sum()), dtype=bool)
    seen_doc = np.zeros(lists.n_docs, dtype=bool)
    best = np.zeros(len(terms), dtype=np.int64)
    top_scores, found_docs, found_scores = floor, [], []
    depth, read, completed = first_depth, 0, 0
    while True:
        met = np.concatenate([lists.doc[b + read:b + min(depth, s)] for b, s in zip(begin.tolist(), size.tolist()) if s > read] or [np.empty(0, np.int64)])
        met = met[~seen_doc[met]]
        if len(met):
            new = np.unique(met)
            seen_doc[new] = True
            completed += len(new)
            owner, in_list, place = lists.direct(new, list_of_term)
            seen_place[offset[in_list] + place - begin[in_list]] = True
            gains = weights[in_list] * lists.impact[place]
            scores = np.zeros(len(new), dtype=np.int64)
            np.add.at(scores, owner, gains)
            good = scores > 0
            new, scores = new[good], scores[good]
            if len(top_scores) >= k:
                bar = top_scores.min() if len(top_scores) == k else np.partition(top_scores, len(top_scores) - k)[len(top_scores) - k]
                good = scores >= bar
                new, scores = new[good], scores[good]
            found_docs.append(new)
            found_scores.append(scores)
            top_scores = np.concatenate([top_scores, scores])
            if len(top_scores) > k:
                top_scores = np.partition(top_scores, len(top_scores) - k)[-k:]
        bound = 0
        for i in range(len(terms)):
            rest = seen_place[offset[i] + best[i]:offset[i] + size[i]]
            if len(rest):
                gap = int(rest.argmin())
                best[i] += gap if not rest[gap] else len(rest)
            if best[i] < size[i]:
                # The impact at the best position; before any is seen, at the first.
                bound += int(weights[i]) * int(lists.impact[begin[i] + max(int(best[i]) - 1, 0)])
        if bound == 0 or len(top_scores) >= k and bound < int(top_scores.min()):
            break
        read, depth = depth, depth * 2
    docs = np.concatenate(found_docs) if found_docs else np.empty(0, np.int64)
    return docs, np.concatenate(found_scores) if found_scores else np.empty(0, np.int64), completed


def keep_best(scores: np.ndarray, ids: list, k: int) -> tuple[np.ndarray, list]:
    """The ``k`` best by score, then id, null ids last."""
    order = sorted(range(len(ids)), key=lambda i: (-int(scores[i]), ids[i] is None, ids[i] or 0))[:k]
    return scores[order], [ids[i] for i in order]


# --- the Spark job ----------------------------------------------------------------------------

def _query_terms(items: DataFrame) -> DataFrame:
    """A numbered row for each query, with its distinct terms."""
    def terms(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {"item_id": batch.column("item_id"), "terms": [sorted(term_counts(t.as_py())) for t in batch.column("text")]}

    kind = dict(items.dtypes)["item_id"]
    found = map_batches(items.select("item_id", "text"), terms, f"item_id {kind}, terms array<string>")
    return found.withColumn("query", F.monotonically_increasing_id())


def _index(docs: DataFrame, admitted: bytes) -> DataFrame:
    """Length, admitted terms and their counts of every document."""
    mask = len(admitted) - 1
    crc = zlib.crc32

    def postings(batch: pa.RecordBatch) -> Iterator[dict]:
        lengths, terms, counts = [], [], []
        for value in batch.column("text"):
            found = term_counts(value.as_py())
            lengths.append(found.total())
            kept = [t for t in found if admitted[crc(t) & mask]]
            terms.append(kept)
            counts.append([found[t] for t in kept])
        yield {"doc_id": batch.column("doc_id"), "length": lengths, "terms": terms, "counts": counts}

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(docs.select("doc_id", "text"), postings,
                       f"doc_id {kind}, length bigint, terms array<string>, counts array<bigint>")


def _blocks(batches: Iterator[pa.RecordBatch], vocabulary: pa.Array, n_docs: int, all_terms: int,
            block_postings: int) -> Iterator[tuple[ImpactLists, list]]:
    """Impact lists over the rows of some batches at a time, and the rows' ids."""
    docs, terms, impacts, ids, held = [], [], [], [], 0

    def block() -> tuple[ImpactLists, list]:
        return ImpactLists(np.concatenate(docs), np.concatenate(terms), np.concatenate(impacts), len(ids), len(vocabulary)), list(ids)

    for batch in batches:
        postings = batch.column("terms")
        number = pc.fill_null(pc.index_in(postings.flatten(), value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        asked = number >= 0
        owner = np.repeat(np.arange(len(batch)), pc.list_value_length(postings).to_numpy(zero_copy_only=False))[asked]
        tf = batch.column("counts").flatten().to_numpy(zero_copy_only=False)[asked]
        norms = np.array([length_norm(n, n_docs, all_terms) for n in batch.column("length").to_pylist()], dtype=np.int64)
        docs.append(owner + len(ids))
        terms.append(number[asked])
        impacts.append((IMPACT_SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * norms[owner]))
        ids.extend(batch.column("doc_id").to_pylist())
        held += len(owner)
        if held >= block_postings:
            yield block()
            docs, terms, impacts, ids, held = [], [], [], [], 0
    if held:
        yield block()


def _answer(index: DataFrame, queries: list[tuple[int, list[tuple[str, int]]]], n_docs: int, all_terms: int,
            params: SearchParams) -> DataFrame:
    """The best documents of every part of the index for each of the queries."""
    numbers: dict[str, int] = {}
    for _, terms in queries:
        for term, _ in terms:
            numbers.setdefault(term, len(numbers))
    asked = [(number, np.array([numbers[t] for t, _ in terms], dtype=np.int64), np.array([w for _, w in terms], dtype=np.int64))
             for number, terms in queries]
    words = list(numbers)
    fields = T.StructType([T.StructField("query", T.LongType()), index.schema["doc_id"], T.StructField("score", T.LongType())])
    target = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, list]] = {}
        for lists, ids in _blocks(batches, pa.array(words, pa.string()), n_docs, all_terms, params.block_postings):
            for number, terms, weights in asked:
                scores, kept = best.get(number, (np.empty(0, np.int64), []))
                docs, found, _ = best_positions(lists, terms, weights, params.k, params.first_depth, scores)
                if len(docs):
                    best[number] = keep_best(np.concatenate([scores, found]), [*kept, *(ids[d] for d in docs.tolist())], params.k)
        for number, (scores, kept) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(([number] * len(kept), kept, scores), target)], schema=target)

    return index.select("doc_id", "length", "terms", "counts").mapInArrow(run, fields)


def rank_documents(items: DataFrame, docs: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``k`` best of ``docs`` for each of ``items`` (both: id and text)."""
    spark = docs.sparkSession
    queries = materialise(spark, _query_terms(items), "search-queries")
    wanted = queries.select("query", F.explode("terms").alias("term"))
    admitted = bytearray(params.filter_bits)
    for row in wanted.select(F.expr(f"crc32(encode(term, 'UTF-8')) % {params.filter_bits}").alias("bit")).distinct().collect():
        admitted[row.bit] = 1
    index = materialise(spark, _index(docs, bytes(admitted)), "search-index")
    n_docs, all_terms = index.agg(F.count(F.when(F.col("length") > 0, 1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    # Each document holds a term once in the index, so a term's rows are its document frequency.
    freqs = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weighted = materialise(spark, wanted.join(freqs, "term"), "search-terms")
    passes = max(1, -(-queries.count() // params.queries_per_pass))
    found = None
    for number in range(passes):
        rows = (weighted.where(F.pmod(F.xxhash64("query"), F.lit(passes)) == number)
                .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("term", "df"))).alias("terms")).collect())
        part = _answer(index, [(r["query"], [(t.term, term_weight(n_docs, t.df)) for t in r.terms]) for r in rows], n_docs, all_terms, params)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.k)
    return ranked.join(queries.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
