"""The pipeline's stages against brute force, each on what its predecessor kept."""

import random

import public_tokenizers
import sentencepiece

import __spark_entry__ as E
import corpus_pipeline as P
from strata.llm.quality_rules import quality_figures
from test_repeated_text import brute as brute_repeats
from test_simhash import brute_components


# Ordinary words, so that the quality rules have nothing to say against texts made of them.
WORDS = """about above across after again against almost along always among another answer around because become before behind
believe better between beyond bring bridge brother building business carry certain change children choose city clear close color
common complete consider continue country course cover create decide develop different direction distance during early earth east
enough evening every example family farmer father feel field figure final follow forest found friend garden general give ground
group happen harbor history house hundred important inside island journey keep language large later learn leave letter light little
listen machine market matter meadow measure minute moment money morning mother mountain music nation nature never night north nothing
notice number object ocean often open order other paper parent people perhaps picture place plain plant point possible power present
problem produce question quick quiet reach ready reason record remember river road round school science season second sentence seven
several shape short should simple single sister small something south special spring stand start station stone story street strong
summer surface system table teacher thing thought thousand together toward travel under until valley village visit voice watch water
weather west whether while winter without woman wonder world write year young""".split()


def prose(rng, n):
    """Sentences of four to twelve words."""
    out = []
    while n > 0:
        k = min(n, rng.randint(4, 12))
        out.append(" ".join(rng.choice(WORDS) for _ in range(k)).capitalize() + ".")
        n -= k
    return " ".join(out)


def write_documents(spark, folder):
    rng = random.Random(11)
    texts = [prose(rng, 120) for _ in range(30)]
    for _ in range(4):
        base = prose(rng, 200).split()
        texts.append(" ".join(base))
        for _ in range(5):
            changed = list(base)
            changed[rng.randrange(len(changed))] = rng.choice(WORDS)
            texts.append(" ".join(changed))
    passage = prose(rng, 55)
    assert P.REPEAT_BYTES < len(passage) < 400
    texts += [f"{texts[i]} {passage} {prose(rng, 40)}" for i in range(5)]
    texts += [None, "", "too short", "again " * 60, texts[0], texts[0]]
    rows = [(i, t, "en", f"src{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return rows


def test_stages_against_brute_force(spark, tmp_path):
    write_documents(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    assert [name for name, _ in P.STAGES] == ["quality_rules", "simhash_near_dedup", "repeated_text", "source_mix", "sentence_pieces"]
    for at, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        rows = kept.collect()
        if at < len(P.STAGES) - 1:
            assert kept.columns == list(P.COLUMNS)
        if name == "quality_rules":
            want = {r.doc_id for r in quality_figures(docs, model).collect() if r.kept}
            assert {r.doc_id for r in rows} == want and 40 < len(want) < len(before)
        elif name == "simhash_near_dedup":
            parts = brute_components([(r.doc_id, r.text) for r in before.values()])
            assert sorted(r.doc_id for r in rows) == sorted({c for _, _, c in parts})
            assert all(r == before[r.doc_id] for r in rows) and len(rows) < len(before)
        elif name == "repeated_text":
            want = dict(zip(before, brute_repeats([r.text for r in before.values()], P.REPEAT_BYTES)))
            assert {r.doc_id: len(r.text.encode()) for r in rows} == {i: w[0] - w[1] for i, w in want.items()}
            assert all(r.n_chars == len(r.text) for r in rows) and sum(w[1] > P.REPEAT_BYTES for w in want.values()) >= 5
        elif name == "source_mix":
            assert all(r == before[r.doc_id] for r in rows)
            assert max(sum(r.doc_id == i for r in rows) for i in before) <= 3
            words = sum(len(r.text.split()) for r in before.values())
            assert abs(sum(len(r.text.split()) for r in rows) - words) <= 0.1 * words
        else:
            assert sorted((r.doc_id, r.ids) for r in rows) == sorted(
                (r.doc_id, sp.encode(r.text)) for r in docs.collect())
        docs = kept


def test_run_applies_all_stages(spark, tmp_path):
    write_documents(spark, tmp_path)
    got = P.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids", "borders"] and got.count() > 20


def test_nulls_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    rng = random.Random(3)
    text = prose(rng, 60)
    for rows in ([], [(None, text, None, None, None, "x"), (None, prose(rng, 80), None, None, None, "x"), (1, None, "en", "s", 0, "x"),
                      (2, text, "en", "s", 9, "x"), (2, text, "en", "s", 9, "x")]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in P.STAGES:
            docs = stage(spark, docs, "")
            # Of the texts some reach every stage, the two without an id among them.
            assert docs.count() >= (2 if rows else 0), name
        docs.collect()


def test_every_numbered_query_is_registered():
    names = E.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
