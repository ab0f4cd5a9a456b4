"""SentencePiece encoding and decoding with exact source offsets.

The text is normalised by the model's compiled character map: at every place
the longest key of the map's prefix trie is replaced, anything else is copied,
and for every normalised byte the source byte it came from is recorded. The
library encodes the text; the pieces tile the normalised bytes, so their
lengths project each piece through that alignment to a span of source bytes.
Spans of consecutive pieces meet: together they cover the text.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from strata.llm.common import map_batches
from strata.llm.pieces import MARK, PieceModel, piece_model

_MARK_BYTES = MARK.encode()


class CompiledMap:
    """The longest-prefix character map that a model file carries.

    Layout (a fixed public format): the byte length of the trie as a 32-bit
    integer, the units of a double-array trie, then the replacements as
    strings that end with a zero byte; a key's value is its replacement's
    place among them.
    """

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist()
        self.strings = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(source bytes, replacement) of the longest key that begins at ``at``."""
        units, found = self.units, None
        node = 0
        unit = units[0]
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        start = found[1]
        return found[0], self.strings[start:self.strings.index(b"\0", start)]


@dataclass(frozen=True)
class Normalised:
    """Normalised bytes and, for each of their borders, the place in the source."""

    data: bytes
    sources: np.ndarray


class Normaliser:
    """Normalises as the model's specification says, and records the alignment."""

    def __init__(self, path: str):
        proto = model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec = proto.normalizer_spec
        self.dummy_prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        self.escape = spec.escape_whitespaces
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.map = CompiledMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.space = _MARK_BYTES if self.escape else b" "
        # With no map and no squeezing only spaces change: the alignment is a running sum.
        self.plain = self.map is None and not self.squeeze and self.escape and not self.suffix

    def __call__(self, text: str) -> Normalised:
        source = text.encode()
        if not source:
            return Normalised(b"", np.zeros(1, dtype=np.int64))
        return self._plain(source) if self.plain else self._mapped(source)

    def _plain(self, source: bytes) -> Normalised:
        raw = np.frombuffer(source, dtype=np.uint8)
        # A space becomes the mark; borders inside a replaced run belong to the run's start.
        widths = np.where(raw == 0x20, len(_MARK_BYTES), 1)
        lead = _MARK_BYTES if self.dummy_prefix else b""
        sources = np.concatenate((np.zeros(len(lead), dtype=np.int64), np.repeat(np.arange(len(raw)), widths),
                                  [len(raw)]))
        return Normalised(lead + source.replace(b" ", _MARK_BYTES), sources)

    def _mapped(self, source: bytes) -> Normalised:
        pieces: list[tuple[int, int, bytes]] = []  # source begin, source end, normalised bytes
        at, n = 0, len(source)
        while at < n:
            hit = self.map.longest(source, at) if self.map else None
            if hit:
                step, new = hit
            else:
                first = source[at]
                step = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                new = source[at:at + step]
            pieces.append((at, at + step, new))
            at += step
        out = bytearray()
        borders = [0]

        def put(new: bytes, begin: int, end: int) -> None:
            for _ in new[:-1]:
                borders.append(begin)
            if new:
                borders.append(end)
            out.extend(new)

        if self.squeeze:
            while pieces and pieces[0][2].strip(b" ") == b"":
                pieces.pop(0)
            if pieces:
                borders[0] = pieces[0][0]
        if not pieces:
            return Normalised(b"", np.zeros(1, dtype=np.int64))
        if self.dummy_prefix and not self.suffix:
            put(self.space, pieces[0][0], pieces[0][0])
        after_space = self.squeeze
        for begin, end, new in pieces:
            if self.squeeze and after_space:
                new = new.lstrip(b" ")
            if new:
                after_space = new.endswith(b" ")
            put(new.replace(b" ", self.space), begin, end)
            if not self.squeeze:
                after_space = False
        if self.squeeze:
            while out.endswith(self.space):
                del out[-len(self.space):]
                del borders[-len(self.space):]
        if self.dummy_prefix and self.suffix:
            put(self.space, borders[-1], borders[-1])
        return Normalised(bytes(out), np.array(borders, dtype=np.int64))


_NORMALISERS: dict[str, Normaliser] = {}


def normaliser(path: str) -> Normaliser:
    """The normaliser of this Python worker, loaded once."""
    if path not in _NORMALISERS:
        _NORMALISERS[path] = Normaliser(path)
    return _NORMALISERS[path]


def piece_borders(model: PieceModel, normalised: Normalised, ids: np.ndarray) -> np.ndarray:
    """Source byte places where pieces meet: piece i is ``[out[i], out[i + 1])``.

    Characters unknown to the vocabulary have no fixed length; such a piece
    takes the normalised bytes up to where the next known piece is found.
    """
    lengths = model.piece_bytes[ids]
    unknown = np.flatnonzero(lengths < 0)
    if len(unknown):
        at = 0
        for i, length in enumerate(lengths.tolist()):
            if length < 0:
                tail = int(lengths[i + 1:].sum()) if not (lengths[i + 1:] < 0).any() else None
                if tail is not None:
                    length = len(normalised.data) - at - tail
                else:
                    following = model.sp.id_to_piece(int(ids[i + 1])).encode() if lengths[i + 1] > 0 else b""
                    found = normalised.data.find(following, at + 1) if following else -1
                    length = (found if found > at else at + 1) - at
                lengths[i] = length
            at += length
    borders = np.concatenate(([0], np.cumsum(lengths)))
    if borders[-1] != len(normalised.data):
        raise ValueError("pieces do not tile the normalised text")
    return normalised.sources[borders]


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``ids``, ``borders`` and the ``decoded`` text.

    ``ids`` are exactly the library's, without begin or end ids and without
    sampling. Piece i covers the source bytes from ``borders[i]`` up to
    ``borders[i + 1]``; the first and the last border are the text's ends
    (where normalisation drops outer spaces, the ends of what is left).
    ``decoded`` is the library's ``decode(ids)``.

    A null text counts as empty and gives no ids and one border, 0. Null ids
    stay, repeated rows are encoded one by one, an empty table gives an empty
    result, and other columns of ``docs`` are ignored. The step is narrow and
    takes whole texts.
    """
    source = docs.select(id_col, text_col)
    kind = source.schema[id_col].dataType.simpleString()

    def encode(batch: pa.RecordBatch):
        model, normalise = piece_model(model_path), normaliser(model_path)
        texts = [t or "" for t in batch.column(text_col).to_pylist()]
        keys = batch.column(id_col)
        start, part = 0, []
        size = 0
        # The arrays of a batch are far larger than its texts: they leave in slices.
        for i, (text, ids) in enumerate(zip(texts, model.encode(texts))):
            part.append((ids.astype(np.int32), piece_borders(model, normalise(text), ids), model.sp.decode(ids.tolist())))
            size += len(ids)
            if size >= 1_000_000 or i == len(texts) - 1:
                yield {id_col: keys.slice(start, len(part)), "ids": _lists([p[0] for p in part], pa.int32()),
                       "borders": _lists([p[1] for p in part], pa.int64()), "decoded": [p[2] for p in part]}
                start, part, size = i + 1, [], 0

    return map_batches(source, encode, f"`{id_col}` {kind}, ids array<int>, borders array<bigint>, decoded string")


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays), type=kind))


def encode_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same work as :func:`encode_pieces`, returned as digests.

    ``n_tokens``, the SHA-256 of the decimal ids joined by commas and of the
    decoded text in UTF-8, and ``borders_sha256`` of the spans' borders as
    little-endian 64-bit integers. The ids and spans of a large corpus are
    many times its size; here they never leave the task that made them.
    Nulls, repeats and empty tables: as there.
    """
    source = docs.select(id_col, text_col)
    kind = source.schema[id_col].dataType.simpleString()

    def encode(batch: pa.RecordBatch):
        model, normalise = piece_model(model_path), normaliser(model_path)
        texts = [t or "" for t in batch.column(text_col).to_pylist()]
        rows = []
        for text, ids in zip(texts, model.encode(texts)):
            listed = ids.tolist()
            borders = piece_borders(model, normalise(text), ids)
            rows.append((len(listed), hashlib.sha256(",".join(map(str, listed)).encode()).hexdigest(),
                         hashlib.sha256(model.sp.decode(listed).encode()).hexdigest(),
                         hashlib.sha256(borders.astype("<i8").tobytes()).hexdigest()))
        names = ("n_tokens", "ids_sha256", "decoded_sha256", "borders_sha256")
        yield {id_col: batch.column(id_col), **dict(zip(names, zip(*rows) if rows else [[] for _ in names]))}

    return map_batches(source, encode, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
                                       "borders_sha256 string")
