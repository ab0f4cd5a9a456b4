"""Removal of every byte that a long repeated string covers.

A suffix start is "repeated" if the string of ``min_length`` bytes there starts
anywhere else too. The steps are those of a distributed difference-cover
suffix sort, cut down to what a comparison of ``min_length`` bytes needs:

1. **Sample.** Some positions of each text are sampled so that any two equal
   strings of ``min_length`` bytes hold a sample at the same offset. With
   ``sampling="cover"`` these are the positions whose remainder modulo v lies
   in a difference cover, which holds for every pair of positions. With
   ``sampling="least"`` they are the least hashes of all windows of ``w``
   positions, which holds for equal strings only, all that is asked here, and
   takes about a fifth of the samples.
2. **Name.** Every sample is named by the bytes around it, samples are sorted
   by name, and neighbours compared. A name found once ends the matter: no
   string through that sample repeats. If the whole stretch that a sample
   answers for has an equal neighbour, all its starts are repeated.
3. **Merge the rest.** Starts whose stretch differs from its neighbours in
   part are ordered by the bytes around their sample and neighbours' common
   prefixes decide each start.

Text is compared within groups of equal names only. Exact copies are folded
before anything is sampled, so a thousand copies cost one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, materialise

# Bytes that order a position among its neighbours.
GRAM = 16
# Members of a name's group compared pair by pair, and sorted start by start, in one task.
PAIRS = 24
GROUP = 4096


@dataclass(frozen=True)
class RepeatParams:
    min_length: int = 400
    sampling: str = "least"

    def __post_init__(self):
        if self.sampling not in ("least", "cover"):
            raise ValueError(f"unknown sampling: {self.sampling}")

    @property
    def window(self) -> int:
        """Positions per window: the largest w with ``3 w <= min_length - GRAM + 3``."""
        third = (self.min_length - GRAM + 3) // 3
        if third < 4:
            raise ValueError("min_length is too short to sample")
        return third

    @property
    def reach(self) -> tuple[int, int]:
        """Least and greatest distance from a start to a sample that answers for it."""
        if self.sampling == "cover":
            return 0, difference_cover(self.min_length // 2)[0] - 1
        return self.window - 1, 2 * self.window - 2


# --- samples ----------------------------------------------------------------------------------

def difference_cover(most: int) -> tuple[int, list[int]]:
    """(v, D): for any i and j some d < v has (i + d) and (j + d) modulo v in D; v is at most ``most``.

    The covers of Colbourn and Ling: v = 24 r^2 + 36 r + 13 with 6 r + 4 members.
    """
    r = 0
    while 24 * (r + 1) ** 2 + 36 * (r + 1) + 13 <= most:
        r += 1
    v = 24 * r * r + 36 * r + 13
    if v > most:
        raise ValueError("min_length is too short for a difference cover")
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return v, [0, *np.cumsum(steps).tolist()]


def _grams(data: bytes) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes at every position."""
    n = len(data) - GRAM + 1
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += words[8:8 + n]
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every window of ``width`` values, by windows of doubling width."""
    step = 1
    while 2 * step <= width:
        values, step = pick(values[:-step], values[step:]), 2 * step
    rest = width - step
    return pick(values[:-rest], values[rest:]) if rest else values


def samples(data: bytes, params: RepeatParams) -> np.ndarray:
    """The sampled positions of a text.

    Least positions: those that are least in some window; ties all count.
    Whether a position is sampled depends on the bytes of the windows that
    hold it, so equal strings agree on the samples deep enough inside them.
    """
    if params.sampling == "cover":
        v, members = difference_cover(params.min_length // 2)
        near_bytes = params.min_length - v + 1
        return np.flatnonzero(np.isin(np.arange(max(0, len(data) - near_bytes + 1)) % v, members))
    w = params.window
    h = _grams(data)
    if len(h) < w:
        return np.zeros(0, dtype=np.int64)
    # The largest of the minima of a position's windows equals its hash iff it is least in one of them.
    edge = np.zeros(w - 1, dtype=np.uint64)
    most = _sliding(np.concatenate((edge, _sliding(h, w, np.minimum), edge)), w, np.maximum)
    return np.flatnonzero(most == h)


def _sample_rows(data: bytes, params: RepeatParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sample, first start, last start) of all samples that answer for a start."""
    length = params.min_length
    near, far = params.reach
    at = samples(data, params)
    if params.sampling == "cover":
        first = np.maximum(at - far, 0)
    else:  # a start has one sample: the next one deep enough
        first = np.maximum(np.concatenate(([-1], at[:-1])) - near + 1, 0)
    last = np.minimum(at - near, len(data) - length)
    some = first <= last
    return at[some], first[some], last[some]


def _distinct_texts(docs: DataFrame, params: RepeatParams, text_col: str) -> DataFrame:
    """(text_key, text, copies): every text long enough to repeat once, folded map-side before the shuffle."""
    text = F.col(text_col)
    rows = docs.where(F.octet_length(text) >= params.min_length).select(
        F.unhex(F.md5(text)).alias("text_key"), F.octet_length(text).alias("n_bytes"), text.alias("text"))
    return (rows.groupBy("text_key", "n_bytes").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
            .select("text_key", "text", "copies"))


# ``many``: 0 for a sample found once in its text, 1 for one of several with the same stretch, which
# stands for all of them, or one of a text with copies, and 2 for the starts of the others, which need no further comparison.
_ROWS = "many byte, name bigint, stretch bigint, text_key binary, at int, first int, last int"


def _named_samples(texts: DataFrame, params: RepeatParams) -> DataFrame:
    """A row per sample of the distinct texts: the name of its near bytes, of its whole stretch, the text and its starts.

    Samples of one text with equal stretches (a text that repeats a line has
    many) repeat each other. They are folded before the shuffle: one stands
    for them, and the starts of the others are merged into few rows. All
    starts of a text with copies are repeated.
    """
    length = params.min_length
    near, far = params.reach

    def run(batch: pa.RecordBatch):
        columns: dict[str, list] = {c.split()[0]: [] for c in _ROWS.split(", ")}
        held = 0
        digest = xxhash.xxh3_64_intdigest
        for key, text, copies in zip(batch.column("text_key").to_pylist(), batch.column("text"), batch.column("copies").to_pylist()):
            data = text.as_buffer().to_pybytes()
            at, first, last = _sample_rows(data, params)
            if not len(at):
                continue
            at_list, first_list, last_list = at.tolist(), first.tolist(), last.tolist()
            names = np.array([digest(data[a - near:a + length - far]) for a in at_list], dtype=np.uint64)
            # The stretch's offsets are part of its name.
            stretches = np.array([digest(data[p:q + length], (a - p) << 16 | (a - q))
                                  for a, p, q in zip(at_list, first_list, last_list)], dtype=np.uint64)
            pairs = np.stack((names, stretches), axis=1)
            _, one, own, count = np.unique(pairs, axis=0, return_index=True, return_inverse=True, return_counts=True)
            stands = np.zeros(len(at), dtype=bool)
            stands[one] = True
            many = np.where(stands, ((count[own.reshape(-1)] > 1) | (copies > 1)).astype(np.int8), np.int8(2))
            kept = np.ones(len(at), dtype=bool)
            rest = np.flatnonzero(~stands)
            if len(rest):
                # Runs of starts that touch become one row, dealt out by a number of its own.
                breaks = np.concatenate(([True], first[rest][1:] > last[rest][:-1] + 1))
                heads = rest[breaks]
                last = last.copy()
                last[heads] = last[rest][np.concatenate((np.flatnonzero(breaks)[1:] - 1, [len(rest) - 1]))]
                kept[rest[~breaks]] = False
                names = names.copy()
                names[heads] = np.array([digest(key, p) for p in first[heads].tolist()], dtype=np.uint64)
            for column, values in zip(columns.values(), (many, names.view(np.int64), stretches.view(np.int64),
                                                          np.array([key] * len(at), dtype=object), at, first, last)):
                column.append(values[kept])
            held += len(at)
            if held >= 200_000:
                yield _joined(columns)
                columns, held = {c: [] for c in columns}, 0
        if held:
            yield _joined(columns)

    return map_batches(texts, run, _ROWS)


def _joined(columns: dict[str, list]) -> dict:
    return {c: (np.concatenate(parts).tolist() if c == "text_key" else np.concatenate(parts)) for c, parts in columns.items()}


# --- sorted names, neighbours compared --------------------------------------------------------

_STATES = "name bigint, text_key binary, at int, first int, last int, state string"
REPEATED, OPEN, WITNESS = "repeated", "open", "witness"


def _judge_neighbours(rows: DataFrame) -> DataFrame:
    """Rows that matter, with their state, from the order by (name, stretch).

    ``repeated``: a neighbour has the same stretch, or the row stands for several. ``open``: only the name is
    shared. ``witness``: a repeated row that open rows may be compared with.
    One row of look-back and look-ahead decides, however large a group is.
    """
    # Rows that need no comparison come first, apart from the names.
    dealt = rows.repartition("name").sortWithinPartitions((F.col("many") != 2), "name", "stretch")
    schema = pa.schema([("name", pa.int64()), ("text_key", pa.binary()), ("at", pa.int32()), ("first", pa.int32()),
                        ("last", pa.int32()), ("state", pa.string())])

    def judged(held: list[pa.RecordBatch], before: tuple | None, final: bool) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        n = table.num_rows - (0 if final else 1)
        if n <= 0:
            return
        many, name, stretch = (table.column(c).to_numpy() for c in ("many", "name", "stretch"))
        lead = before or (None, None)
        same_name = np.concatenate(([lead[0] is not None and name[0] == lead[0]], name[1:] == name[:-1], [False]))
        # A row that needs no comparison has no neighbour.
        apart = many == 2
        same_name[:-1] &= ~apart
        same_name[1:] &= ~apart
        same = np.concatenate(([same_name[0] and stretch[0] == lead[1]], stretch[1:] == stretch[:-1], [False])) & same_name
        back, ahead = same[:n], same[1:n + 1]
        repeated = back | ahead | (many[:n] > 0)
        border = (same_name[:n] & ~back) | (same_name[1:n + 1] & ~ahead)
        for state, mask in ((REPEATED, repeated), (OPEN, border & ~repeated), (WITNESS, border & repeated)):
            some = np.flatnonzero(mask)
            if len(some):
                part = table.select(["name", "text_key", "at", "first", "last"]).take(pa.array(some))
                part = part.append_column("state", pa.array([state] * len(some)))
                yield from part.cast(schema).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        before: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            yield from judged(held, before, final=False)
            # The last row waits for what comes next.
            rest = pa.Table.from_batches(held)
            if rest.num_rows > 1:
                row = rest.slice(rest.num_rows - 2, 1)
                before = (None, None) if row.column("many")[0].as_py() == 2 else (
                    row.column("name")[0].as_py(), row.column("stretch")[0].as_py())
            held = rest.slice(rest.num_rows - 1).to_batches()
        if held:
            yield from judged(held, before, final=True)

    return dealt.mapInArrow(run, _STATES)


# --- the rest: starts compared by their bytes -------------------------------------------------

_CONTEXT = "name bigint, text_key binary, at int, first int, last int, open boolean, bytes binary"


def _contexts(rows: DataFrame, texts: DataFrame, params: RepeatParams) -> DataFrame:
    """The bytes of the stretches of open and witness rows of the distinct texts."""
    wanted = (rows.where(F.col("state") != REPEATED)
              .groupBy("text_key", "name", "at", "first", "last").agg(F.max(F.col("state") == OPEN).alias("open"))
              .groupBy("text_key").agg(F.collect_list(F.struct("name", "at", "first", "last", "open")).alias("stretches")))
    texts = texts.select("text_key", F.col("text").cast("binary").alias("data")).join(wanted, "text_key")
    length = params.min_length
    start, size = F.col("s.first"), F.col("s.last") - F.col("s.first") + F.lit(length)
    return texts.select("text_key", "data", F.explode("stretches").alias("s")).select(
        "s.name", "text_key", "s.at", "s.first", "s.last", "s.open", F.substring(F.col("data"), start + 1, size).alias("bytes"))


def _aligned(rows: list[tuple], length: int, far: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with the sample in column ``far``, least and greatest distance of a start) per row."""
    out = np.zeros((len(rows), 2 * length), dtype=np.uint8)
    low = np.array([at - last for _, _, at, _, last, _, _ in rows])
    high = np.array([at - first for _, _, at, first, _, _, _ in rows])
    for i, row in enumerate(rows):
        out[i, far - high[i]:far - high[i] + len(row[6])] = np.frombuffer(row[6], dtype=np.uint8)
    return out, low, high


def _paired(rows: list[tuple], pairs: tuple[np.ndarray, np.ndarray], params: RepeatParams) -> Iterator[tuple]:
    """Repeated starts of the pairs' members from the bytes that each pair has in common around its sample."""
    length, (_, far) = params.min_length, params.reach
    data, low, high = _aligned(rows, length, far)
    for at in range(0, len(pairs[0]), 20_000):
        i, j = pairs[0][at:at + 20_000], pairs[1][at:at + 20_000]
        differ = data[i] != data[j]
        left = differ[:, :far][:, ::-1]
        before = np.where(left.any(axis=1), left.argmax(axis=1), far)
        right = differ[:, far:]
        after = np.where(right.any(axis=1), right.argmax(axis=1), right.shape[1])
        # A start at distance d needs d equal bytes before the sample and length - d from it on.
        least = np.maximum(length - after, np.maximum(low[i], low[j]))
        most = np.minimum(before, np.minimum(high[i], high[j]))
        for k in np.flatnonzero(least <= most):
            for x in (i[k], j[k]):
                if rows[x][5]:
                    yield rows[x][1], rows[x][2] - int(most[k]), rows[x][2] - int(least[k])


def _sorted_starts(rows: list[tuple], params: RepeatParams) -> Iterator[tuple]:
    """Repeated starts of one group, by sorting the strings of every distance and comparing neighbours."""
    length, (near, far) = params.min_length, params.reach
    data, low, high = _aligned(rows, length, far)
    for distance in range(near, far + 1):
        some = np.flatnonzero((low <= distance) & (distance <= high))
        if len(some) < 2:
            continue
        strings = np.ascontiguousarray(data[some, far - distance:far - distance + length]).view(f"S{length}").reshape(-1)
        _, names, counts = np.unique(strings, return_inverse=True, return_counts=True)
        for x in some[counts[names] > 1]:
            if rows[x][5]:
                yield rows[x][1], rows[x][2] - distance, rows[x][2] - distance


_SPANS = "text_key binary, first int, last int"
_SPAN_SCHEMA = pa.schema([("text_key", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])


def _span_batches(spans: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held = list(spans)
    for at in range(0, len(held), 50_000):
        part = held[at:at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), _SPAN_SCHEMA)], schema=_SPAN_SCHEMA)


def _compare_contexts(contexts: DataFrame, params: RepeatParams) -> DataFrame:
    """Repeated starts among the open rows, group by group of equal names."""
    dealt = contexts.repartition("name").sortWithinPartitions("name")
    names = [c.split()[0] for c in _CONTEXT.split(", ")]

    def solved(groups: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
        small, left, right, at = [], [], [], 0
        for group in groups:
            if len(group) > PAIRS:
                yield from _span_batches(_sorted_starts(group, params))
            elif len(group) > 1 and any(r[5] for r in group):
                i, j = np.triu_indices(len(group), 1)
                left.append(i + at)
                right.append(j + at)
                small += group
                at += len(group)
        if small:
            yield from _span_batches(_paired(small, (np.concatenate(left), np.concatenate(right)), params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[list[tuple]] = []
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                if not groups or groups[-1][0][0] != row[0]:
                    if held >= 8192:
                        yield from solved(groups)
                        groups, held = [], 0
                    groups.append([])
                groups[-1].append(row)
                held += 1
        yield from solved(groups)

    return dealt.mapInArrow(run, _SPANS)


def _compare_starts(contexts: DataFrame, params: RepeatParams) -> DataFrame:
    """The same for groups too large for one task: each start by the digest of its string."""
    length = params.min_length

    def strings(batch: pa.RecordBatch):
        for key, first, last, is_open, data in zip(*(batch.column(c).to_pylist()
                                                     for c in ("text_key", "first", "last", "open", "bytes"))):
            starts = list(range(first, last + 1))
            yield {"string": [hashlib.md5(data[p - first:p - first + length], usedforsecurity=False).digest() for p in starts],
                   "text_key": [key] * len(starts), "start": starts, "open": [is_open] * len(starts)}

    rows = map_batches(contexts, strings, "string binary, text_key binary, start int, open boolean")
    # A start may come in through several samples; only different starts repeat each other.
    place = F.struct("text_key", "start")
    shared = (rows.groupBy("string").agg(F.min(place).alias("least"), F.max(place).alias("most"))
              .where(F.col("least") != F.col("most")).select("string"))
    return rows.where("open").join(shared, "string").select(
        "text_key", F.col("start").alias("first"), F.col("start").alias("last"))


# --- spans and what is left -------------------------------------------------------------------

def repeated_starts(docs: DataFrame, params: RepeatParams, text_col: str = "text") -> DataFrame:
    """(text_key, first, last): runs of repeated starts per distinct text (its MD5). Runs may touch or overlap."""
    spark = docs.sparkSession
    texts = materialise(spark, _distinct_texts(docs, params, text_col), "distinct-texts")
    rows = materialise(spark, _judge_neighbours(_named_samples(texts, params)), "repeated-samples")
    contexts = materialise(spark, _contexts(rows, texts, params), "sample-contexts")
    hot = materialise(spark, contexts.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP)
                      .select("name"), "hot-names")
    spans = _compare_contexts(contexts.join(hot, "name", "left_anti"), params).unionByName(
        _compare_starts(contexts.join(hot, "name", "left_semi"), params))
    return rows.where(F.col("state") != OPEN).select("text_key", "first", "last").unionByName(spans)


def merged_spans(starts: list[tuple[int, int]], min_length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes [begin, end) that strings at the starts cover."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(starts):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + min_length))
        else:
            out.append((first, last + min_length))
    return out


def remove_repeats(docs: DataFrame, params: RepeatParams | None = None, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = (), kept: str = "digest") -> DataFrame:
    """One row per document: id, ``carry`` columns, ``n_bytes``, ``n_removed``, ``n_spans`` and what is left.

    What is left is ``kept_sha256``, or ``kept_text`` with ``kept="text"``
    (a character that lost some of its bytes goes as a whole).

    Strings are judged on the input, in every text and across texts, exact
    copies and the same text included; they never cross a text's end. Null and
    empty texts, and texts shorter than ``min_length``, lose nothing. Equal
    rows lose the same bytes, for they repeat each other. Null ids stay. An
    empty table gives an empty result; other columns are ignored.
    """
    params = params or RepeatParams()
    runs = (repeated_starts(docs, params, text_col).distinct()
            .groupBy("text_key").agg(F.collect_list(F.struct("first", "last")).alias("runs")))
    columns = list(dict.fromkeys((id_col, *carry)))
    source = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(text_col).cast("binary").alias("data"),
                         F.unhex(F.md5(F.col(text_col))).alias("key"))
    joined = source.join(runs, F.col("key") == F.col("text_key"), "left").drop("key", "text_key")
    types = [docs.schema[c].dataType.simpleString() for c in columns]
    last = "kept_text" if kept == "text" else "kept_sha256"
    min_length = params.min_length

    def cut(batch: pa.RecordBatch):
        rows = []
        for data, starts in zip(batch.column("data"), batch.column("runs").to_pylist()):
            raw = data.as_buffer().to_pybytes() if data.is_valid else b""
            spans = merged_spans([(s["first"], s["last"]) for s in starts or ()], min_length)
            parts, at = [], 0
            for begin, end in spans:
                parts.append(raw[at:begin])
                at = end
            rest = b"".join((*parts, raw[at:]))
            left = _whole_characters(parts, raw[at:]) if kept == "text" else hashlib.sha256(rest).hexdigest()
            rows.append((len(raw), len(raw) - len(rest), len(spans), left))
        names = ("n_bytes", "n_removed", "n_spans", last)
        yield {**{f"c{i}": batch.column(f"c{i}") for i in range(len(columns))},
               **dict(zip(names, zip(*rows) if rows else [[] for _ in names]))}

    ddl = ", ".join([*(f"c{i} {t}" for i, t in enumerate(types)), "n_bytes bigint", "n_removed bigint", "n_spans bigint",
                     f"{last} string"])
    made = map_batches(joined, cut, ddl)
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], "n_bytes", "n_removed", "n_spans", last)


def _whole_characters(parts: list[bytes], rest: bytes) -> str:
    return "".join(p.decode("utf-8", "ignore") for p in (*parts, rest))
