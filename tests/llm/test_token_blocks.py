"""Token files: exact round trips and starts."""

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from strata.llm import token_blocks as T

MODEL = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "Hello  world", "it's we'll", "été 日本 😀", "x\x1c y\x85 z", "a \n b  ", "<|endoftext|> in a text",
         "word " * 4000, "y" * 3000, "tab\tand\r\nline"]


@pytest.mark.parametrize("seed", range(30))
def test_blocks_round_trip(seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, 1 << int(rng.integers(1, 33)), size=int(rng.integers(1, 3000)), dtype=np.uint32)
    ids[rng.random(len(ids)) < 0.02] = 0xFFFFFFFF
    for percentile in (1, 50, 95, 100):
        assert (T.decode_block(T.encode_block(ids, percentile), len(ids)) == ids).all()


class Sink(io.BytesIO):
    def close(self):
        self.kept = self.getvalue()
        super().close()


def test_files_round_trip_and_read_parts():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, size=int(n), dtype=np.uint32) for n in rng.integers(0, 700, size=60)]
    sink = Sink()
    writer = T.TokenFileWriter(sink, block_ids=128)
    for i, d in enumerate(docs):
        writer.add(None if i == 3 else i - 10, d)
    writer.close()
    file = T.TokenFile(io.BytesIO(sink.kept))
    assert file.keys[:5] == [-10, -9, -8, None, -6]
    assert all((file.document(i) == d).all() for i, d in enumerate(docs))
    again = [d for _, part in file.stretches(500) for d in part]
    assert len(again) == len(docs) and all((a == d).all() for a, d in zip(again, docs))
    whole = np.concatenate(docs)
    assert (file.read(300, 555) == whole[300:555]).all()
    assert len(sink.kept) < 4 * len(whole)


def test_an_empty_file():
    sink = Sink()
    T.TokenFileWriter(sink).close()
    file = T.TokenFile(io.BytesIO(sink.kept))
    assert file.documents == 0 and list(file.stretches()) == []


def test_chunked_encoding_equals_the_library():
    library = tokenizers.Tokenizer.from_file(MODEL)
    ours = T.byte_encoder(MODEL)
    assert ours.cuts
    for text in [t or "" for t in TEXTS] * 2:
        assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_written_and_read_back(spark):
    library = tokenizers.Tokenizer.from_file(MODEL)
    rows = [(7 * i % 101, t, "clash") for i, t in enumerate(TEXTS * 3)] + [(None, "null id", "x"), (7, None, "x"), (7, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    manifest = T.write_tokens(docs, T.tokens_folder(spark), MODEL, end_id=2, file_ids=5000)
    assert manifest.count() > 1
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in T.read_tokens(manifest).collect()))
    want, at = [], 0
    for key, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((at, key, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.read_tokens(T.write_tokens(docs, T.tokens_folder(spark), MODEL, end_id=2)).collect() == []
