"""Token ids in a binary file format of patched frame-of-reference blocks.

A file holds the ids of consecutive documents, cut into blocks of a fixed
number of ids. Of each block the smallest id is subtracted; the rest is packed
at the width that a percentile of the values needs, and the few values that
are wider leave their high bits in a list of exceptions. An index of block
starts makes any block readable alone, and an index of document starts any
document.

File layout, little-endian:

    magic "PFR1"
    blocks, each: minimum (u32), width (u8), exceptions (u16), packed low bits,
        exception places (u16 each), exception high bits (u32 each)
    block index: byte start of every block and the end of the last (u64 each)
    document index: first id of every document and the end of the last (u64 each)
    document keys: one i64 each, then one byte each (0: the key is null)
    footer: ids per block (u32), documents (u64), ids (u64), byte start of the
        block index (u64), magic

A task writes the files of its range of documents and returns a manifest row
for each; the manifest's order is the order of the documents.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import map_batches, materialise
from strata.llm.storage import fresh_name, open_input, open_output
from strata.session import scratch_path

MAGIC = b"PFR1"
BLOCK_IDS = 1024
PERCENTILE = 95
# A file closes after the document that brings it to so many ids (about 32 MB at 16 bits).
FILE_IDS = 16_000_000
_BLOCK = struct.Struct("<IBH")
_FOOT = struct.Struct("<IQQQ4s")


# --- the block format -------------------------------------------------------------------------

def _pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, lowest bit first."""
    if width == 0:
        return b""
    if width == 16:
        return values.astype("<u2").tobytes()
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def _unpack(data: bytes, count: int, width: int) -> np.ndarray:
    if width == 0:
        return np.zeros(count, dtype=np.uint32)
    if width == 16:
        return np.frombuffer(data, dtype="<u2", count=count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=count * width, bitorder="little")
    wide = np.zeros((count, 32), dtype=np.uint8)
    wide[:, :width] = bits.reshape(count, width)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


def encode_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One block of at least one and at most 65,535 ids."""
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    at = min(len(rest) - 1, -(-len(rest) * percentile // 100) - 1)
    width = int(np.partition(rest, at)[at]).bit_length()
    wide = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, dtype=np.int64)
    high = (rest[wide] >> np.uint32(width)) if len(wide) else np.zeros(0, dtype=np.uint32)
    return b"".join((_BLOCK.pack(low, width, len(wide)), _pack(rest, width), wide.astype("<u2").tobytes(),
                     high.astype("<u4").tobytes()))


def decode_block(data: bytes, count: int) -> np.ndarray:
    low, width, exceptions = _BLOCK.unpack_from(data)
    at = _BLOCK.size
    packed = (count * width + 7) // 8
    rest = _unpack(data[at:at + packed], count, width)
    at += packed
    places = np.frombuffer(data, dtype="<u2", count=exceptions, offset=at)
    high = np.frombuffer(data, dtype="<u4", count=exceptions, offset=at + 2 * exceptions)
    if exceptions:
        rest = rest.copy()
        rest[places] |= high.astype(np.uint32) << np.uint32(width)
    return rest + np.uint32(low)


class TokenFileWriter:
    """Writes a file block by block; only the open block and the indexes stay in memory."""

    def __init__(self, sink: BinaryIO, block_ids: int = BLOCK_IDS, percentile: int = PERCENTILE):
        if not 1 <= block_ids <= 0xFFFF:
            raise ValueError("a block holds 1 to 65535 ids")
        self.sink, self.block_ids, self.percentile = sink, block_ids, percentile
        self.open_ids: list[np.ndarray] = []
        self.open_count = 0
        self.place = sink.write(MAGIC) and len(MAGIC)
        self.block_starts: list[int] = []
        self.starts: list[int] = [0]
        self.keys: list[int | None] = []

    @property
    def ids(self) -> int:
        return self.starts[-1]

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.starts.append(self.starts[-1] + len(ids))
        self.open_ids.append(ids)
        self.open_count += len(ids)
        if self.open_count >= self.block_ids:
            self._flush(whole_blocks=True)

    def _flush(self, whole_blocks: bool) -> None:
        ids = np.concatenate(self.open_ids) if self.open_ids else np.zeros(0, dtype=np.uint32)
        stop = len(ids) - len(ids) % self.block_ids if whole_blocks else len(ids)
        for at in range(0, stop, self.block_ids):
            block = encode_block(ids[at:at + self.block_ids], self.percentile)
            self.block_starts.append(self.place)
            self.sink.write(block)
            self.place += len(block)
        self.open_ids, self.open_count = [ids[stop:]], len(ids) - stop

    def close(self) -> None:
        self._flush(whole_blocks=False)
        self.sink.write(np.array([*self.block_starts, self.place], dtype="<u8").tobytes())
        self.sink.write(np.array(self.starts, dtype="<u8").tobytes())
        self.sink.write(np.array([k or 0 for k in self.keys], dtype="<i8").tobytes())
        self.sink.write(np.array([k is not None for k in self.keys], dtype="u1").tobytes())
        self.sink.write(_FOOT.pack(self.block_ids, len(self.keys), self.ids, self.place, MAGIC))
        self.sink.close()


class TokenFile:
    """Reads a file; any id range costs only the blocks that hold it."""

    def __init__(self, source: BinaryIO):
        self.source = source
        size = source.seek(0, 2)
        foot = self._bytes(size - _FOOT.size, _FOOT.size)
        self.block_ids, self.documents, self.ids, place, magic = _FOOT.unpack(foot)
        if magic != MAGIC or self._bytes(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        blocks = -(-self.ids // self.block_ids)
        self.block_starts = np.frombuffer(self._bytes(place, 8 * (blocks + 1)), dtype="<u8").astype(np.int64)
        place += 8 * (blocks + 1)
        self.starts = np.frombuffer(self._bytes(place, 8 * (self.documents + 1)), dtype="<u8").astype(np.int64)
        place += 8 * (self.documents + 1)
        keys = np.frombuffer(self._bytes(place, 8 * self.documents), dtype="<i8").tolist()
        known = self._bytes(place + 8 * self.documents, self.documents)
        self.keys = [k if ok else None for k, ok in zip(keys, known)]

    def _bytes(self, at: int, count: int) -> bytes:
        self.source.seek(at)
        return self.source.read(count)

    def read(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``."""
        if start >= stop:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        base = int(self.block_starts[first])
        data = self._bytes(base, int(self.block_starts[last + 1]) - base)
        blocks = [decode_block(data[int(self.block_starts[b]) - base:int(self.block_starts[b + 1]) - base],
                               min(self.block_ids, self.ids - b * self.block_ids)) for b in range(first, last + 1)]
        return np.concatenate(blocks)[start - first * self.block_ids:stop - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.read(int(self.starts[i]), int(self.starts[i + 1]))

    def stretches(self, ids: int = 1_000_000) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(number of the first, documents): all in order, about so many ids at a time."""
        i = 0
        while i < self.documents:
            stop = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + ids, side="right")) - 1)
            stretch, base = self.read(int(self.starts[i]), int(self.starts[stop])), int(self.starts[i])
            yield i, [stretch[int(self.starts[j]) - base:int(self.starts[j + 1]) - base] for j in range(i, stop)]
            i = stop


# --- tokens -----------------------------------------------------------------------------------

# A space between two characters that are no white space always begins a new word of a byte-level
# vocabulary, and a line break there is a word of its own. So texts can be cut there, and as words
# repeat, most pieces are looked up.
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Pieces kept per worker; a full cache is emptied, which costs time but never changes a result.
CACHE_WORDS = 1_000_000
CACHE_WORD_CHARS = 40
_MARKS = ".,;:!?"
# Letters below this are letters to every version of Unicode.
_OLD_LETTERS = "\u0250"


def byte_alphabet() -> dict[int, str]:
    """Byte to character as byte-level vocabularies write it: printable bytes
    stand for themselves, the others take the characters from 256 on in turn."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _plain(word: str) -> bool:
    """Letters only, and ones that all Unicode versions agree on."""
    return word.isalpha() and max(word) < _OLD_LETTERS
_ENCODERS: dict[str, ByteEncoder] = {}


class _Unsafe(Exception):
    """A text has white space that the quick cut does not know."""


class _Words(dict):
    """Ids (as bytes) of words with a fixed lead, encoded on first sight.

    A word may begin with a line break, which is then a word of its own; any
    other white space in it raises :class:`_Unsafe`.
    """

    def __init__(self, encode, letters, lead: str):
        super().__init__()
        self.encode, self.letters, self.lead = encode, letters, lead
        self.marks = {m: encode(m) for m in _MARKS}
        self.line_break = encode("\n")

    def __missing__(self, word: str) -> bytes:
        broken = word.startswith("\n")
        body = word[1:] if broken else word
        if body.split() != [body]:
            raise _Unsafe
        if body[-1] in self.marks and _plain(body[:-1]):
            # Letters and a closing mark are two words of the vocabulary's pattern.
            ids = self[word[:-1]] + self.marks[body[-1]]
        else:
            # Letters with the space before them are one.
            encode = self.letters if _plain(body) else self.encode
            ids = self.line_break + encode(body) if broken else encode(self.lead + body)
        if len(word) <= CACHE_WORD_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids


class ByteEncoder:
    """Ids of a byte-level vocabulary by the tokenizers library, word by word.

    Every distinct piece goes through the library's own pre-tokeniser and
    model. Files whose normaliser, pre-tokeniser or added tokens do not allow
    cutting are encoded whole by the library's ``encode``.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = byte_alphabet()
        self.words = _Words(self._piece, self._letters, " ")
        probe = "It's a  test,\nof words; naïve\n12 x"
        self.cuts = (self.tokenizer.normalizer is None
                     and type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel"
                     and not getattr(self.tokenizer.pre_tokenizer, "add_prefix_space", True)
                     and all(self._cut(t) == array("I", self._whole(t)).tobytes() for t in (probe, probe.replace("  ", " "))))

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, text: str) -> bytes:
        tokenize = self.tokenizer.model.tokenize
        words = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return array("I", [t.id for word, _ in words for t in tokenize(word)]).tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of one word of the pre-tokeniser, spelt in the vocabulary's alphabet."""
        spelt = word.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(spelt)]).tobytes()

    def _cut(self, text: str) -> bytes:
        # A break within a line of words stays with the word that follows it.
        words = text.replace("\n", " \n").split(" ")
        try:
            # Single spaces and line breaks part the words, and there is no other white space.
            return self._piece(words[0]) + b"".join(map(self.words.__getitem__, words[1:]))
        except _Unsafe:
            pieces = _CUT.split(text)
            return b"".join([self._piece(pieces[0]), *(self._piece(" " + p) if p.split() != [p] else self.words[p]
                                                       for p in pieces[1:])])

    def encode(self, text: str) -> np.ndarray:
        """``encode(text, add_special_tokens=False).ids`` as an array."""
        if not text:
            return np.zeros(0, dtype=np.uint32)
        if not self.cuts or any(s in text for s in self.special):
            return np.array(self._whole(text), dtype=np.uint32)
        return np.frombuffer(self._cut(text), dtype=np.uint32)


def byte_encoder(path: str) -> ByteEncoder:
    """The encoder of this Python worker, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]


# --- the distributed writer and reader --------------------------------------------------------

def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = None, id_col: str = "doc_id",
                 text_col: str = "text", block_ids: int = BLOCK_IDS, percentile: int = PERCENTILE,
                 file_ids: int = FILE_IDS) -> DataFrame:
    """Encode documents and write them in ascending key order; returns the manifest.

    The manifest has a row per file: ``path``, ``first_id`` (ids in all files
    before it), ``documents`` and ``ids``. Rows are dealt by key ranges, so a
    task holds one range and no task holds the corpus.

    Null texts count as empty; null keys come first; equal keys follow each
    other in text order (null first), so repeated rows give the same files on
    every run. Keys are integers. An empty table gives an empty manifest.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    dealt = source.repartitionByRange(F.col("key").asc_nulls_first())
    dealt = (dealt.withColumn("part", F.spark_partition_id())
             .sortWithinPartitions(F.col("key").asc_nulls_first(), F.col("text").asc_nulls_first()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer_path)
        tail = np.array([] if end_id is None else [end_id], dtype=np.uint32)
        writer, path, part, made = None, "", 0, 0

        def row() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_pylist(
                [{"part": part, "number": made, "path": path, "documents": len(writer.keys), "ids": writer.ids}],
                schema=_MANIFEST)

        for batch in batches:
            for key, text, part_value in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "part"))):
                if writer is None:
                    path = fresh_name(folder, ".pfr")
                    writer, part = TokenFileWriter(open_output(path), block_ids, percentile), part_value
                writer.add(key, np.concatenate((encoder.encode(text or ""), tail)))
                if writer.ids >= file_ids:
                    yield row()
                    writer, made = None, made + 1
        if writer is not None:
            yield row()

    manifest = materialise(spark, dealt.mapInArrow(write, _MANIFEST_DDL), "token-manifest")
    # One row per file; the running sums over parts and over a part's files are both short.
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_first", F.coalesce(F.sum("part_ids").over(before), F.lit(0)))
    ordered = (manifest.withColumn("inside", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
               .join(parts, "part")
               .select("path", (F.col("part_first") + F.col("inside")).alias("first_id"), "documents", "ids"))
    return materialise(spark, ordered, "token-files")


_MANIFEST_DDL = "part int, number int, path string, documents bigint, ids bigint"
_MANIFEST = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()),
                       ("documents", pa.int64()), ("ids", pa.int64())])


def read_tokens(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Read the files of a manifest back: key, ``start``, ``n_tokens``, ``ids_crc32`` per document.

    ``start`` counts the ids of all documents before; the checksum is of the
    ids as little-endian unsigned 32-bit integers.
    """
    def read(batch: pa.RecordBatch):
        for path, first in zip(batch.column("path").to_pylist(), batch.column("first_id").to_pylist()):
            with open_input(path) as source:
                file = TokenFile(source)
                for at, documents in file.stretches():
                    count = len(documents)
                    yield {id_col: file.keys[at:at + count], "start": first + file.starts[at:at + count],
                           "n_tokens": [len(d) for d in documents],
                           "ids_crc32": [zlib.crc32(d.astype("<u4").tobytes()) for d in documents]}

    # A row names a file of many megabytes: every file is a task of its own.
    files = manifest.select("path", "first_id")
    dealt = files.repartitionByRange(max(1, files.count()), "first_id")
    return map_batches(dealt, read, f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_folder(spark: SparkSession) -> str:
    """A fresh folder for token files below the shared checkpoint folder."""
    return scratch_path(spark, "tokens")
