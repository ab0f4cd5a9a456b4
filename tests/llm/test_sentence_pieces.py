"""Encoding, spans and decoding against the library."""

import hashlib

import public_tokenizers
import sentencepiece

from strata.llm.pieces import piece_model
from strata.llm.sentence_pieces import Normaliser, encode_digests, encode_pieces, normaliser, piece_borders

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "a", " a  b ", "Hello world", "été\n\tça ▁x", "日本語 😀 ok", "\x00\x01", "<s> </s> <unk>", "12 345",
         "x" * 5000, "word " * 3000]


def test_ids_spans_and_decoding(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "null id", "x"), (5, "Hello world", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_pieces(docs, MODEL).collect()
    assert len(got) == len(rows)
    texts = dict(enumerate(TEXTS)) | {None: "null id"}
    for r in got:
        text = texts[r.doc_id] or ""
        assert r.ids == sp.encode(text)
        assert r.decoded == sp.decode(r.ids)
        assert len(r.borders) == len(r.ids) + 1
        if text:
            assert r.borders[0] == 0 and r.borders[-1] == len(text.encode())
            assert r.borders == sorted(r.borders)
            # Every ordinary piece without a space is the very bytes of its span.
            for i, (b, e) in zip(r.ids, zip(r.borders, r.borders[1:])):
                piece = sp.id_to_piece(i)
                if not sp.is_byte(i) and "▁" not in piece:
                    assert text.encode()[b:e].decode() == piece


def test_digests(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in encode_digests(docs, MODEL).collect():
        ids = sp.encode(TEXTS[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert encode_pieces(docs, MODEL).collect() == [] and encode_digests(docs, MODEL).collect() == []


def test_compiled_map_equals_the_library(tmp_path):
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=True, escape_whitespaces=True,
                                                    remove_extra_whitespaces=True)
    file = tmp_path / "nfkc.model"
    file.write_bytes(library.serialized_model_proto())
    ours = Normaliser(str(file))
    assert ours.map is not None and not ours.plain
    for text in ["", "  ", "①②  ﬁne  ｱ\tｶﾞ x  ", "Ｈｅｌｌｏ　Ｗｏｒｌｄ", "e\u0301 a", "한국어 ½", "a\n\nb", " 　x", "plain text"]:
        got = ours(text)
        assert got.data.decode() == library.normalize(text)
        assert len(got.sources) == len(got.data) + 1
        assert list(got.sources) == sorted(got.sources)
    got = ours("①  ﬁne")
    assert got.data.decode() == "▁1▁fine"
    # The ligature's two letters come from its three bytes.
    assert got.sources.tolist() == [0, 0, 0, 0, 3, 3, 3, 4, 5, 8, 9, 10][:len(got.sources)]


def test_plain_alignment():
    model, normalise = piece_model(MODEL), normaliser(MODEL)
    assert normalise.plain
    for text in ("a b", "  x", "é ü "):
        ids = next(iter(model.encode([text])))
        borders = piece_borders(model, normalise(text), ids)
        assert b"".join(text.encode()[b:e] for b, e in zip(borders, borders[1:])) == text.encode()
