"""The corpus pipeline: every stage calls one operator of ``strata.llm``.

A stage is ``(name, function)`` with ``function(spark, docs, sf_dir)``. Its
result is written as Parquet and read again as the next stage's ``docs``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import materialise
from strata.llm.queries import MIX_WEIGHTS, PIECE_MODEL
from strata.llm.quality_rules import quality_figures
from strata.llm.repeated_text import RepeatParams, remove_repeats
from strata.llm.sentence_pieces import encode_pieces
from strata.llm.simhash import SimHashParams, keep_one_per_component
from strata.llm.source_mix import take_copies
from strata.sources.tables import read_table

# A passage of over 50 words takes 244 bytes or more in 99 of 100 windows of 51 words of the documents (median 305).
REPEAT_BYTES = 240
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. Null and empty texts have no words and go too."""
    figures = quality_figures(docs.select(*COLUMNS), public_tokenizers.path(PIECE_MODEL), carry=COLUMNS)
    return figures.where(F.col("kept")).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    return keep_one_per_component(docs.select(*COLUMNS), SimHashParams(shingle_words=4, max_distance=4, seed=42))


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``REPEAT_BYTES`` or more that repeat go; ``n_chars`` counts what is left."""
    cut = remove_repeats(docs.select(*COLUMNS), RepeatParams(min_length=REPEAT_BYTES), carry=("lang", "source"), kept="text")
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                      F.char_length("kept_text").cast("long").alias("n_chars"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those with no copies go."""
    return take_copies(docs.select(*COLUMNS), MIX_WEIGHTS, cap=3.0)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy: its piece ids and the borders of the pieces in the text's bytes."""
    made = encode_pieces(docs.select("doc_id", "text"), public_tokenizers.path(PIECE_MODEL))
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "borders")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("repeated_text", repeated_text),
    ("source_mix", source_mix),
    ("sentence_pieces", sentence_pieces),
]

# The stages tokenise and search whole texts, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = read_table(spark, sf_dir, "documents", *COLUMNS)
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = materialise(spark, docs, f"pipeline-{name}")
    return docs
