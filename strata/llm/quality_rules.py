"""Quality rules from tokeniser fertility.

A public vocabulary was fitted to ordinary text. Text unlike it shows in three
figures: few characters per token, a large share of byte-fallback pieces, and
a token distribution with too little or too much entropy for its length. Each
script has a band for every figure; a document outside a band is rejected.
Latin and Cyrillic have a second band for languages whose many marked letters
the vocabulary spells one by one (Vietnamese, Yoruba; Kazakh, Mongolian).

Cheap base rules (word count, symbols, repeated lines and word windows) are
measured in the same pass. The step is narrow: nothing is shuffled, and every
figure is of the whole text.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strata.llm.common import map_batches
from strata.llm.pieces import PieceModel, piece_model

SYMBOLS = "#*$%&|<>"
WHITE_SPACE = " \t\n\v\f\r"
WINDOW = 5

# Scripts told apart by a document's letters; anything else is "other".
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Han", "Hiragana", "Katakana",
           "Hangul", "Thai")
_NON_LATIN = regex.compile("(?V1)" + "|".join([
    *(f"(?P<{s}>\\p{{Script={s}}}+)" for s in SCRIPTS[1:]),
    "(?P<other>[\\p{L}--[\\p{Script=Common}\\p{Script=Latin}" + "".join(f"\\p{{Script={s}}}" for s in SCRIPTS[1:]) + "]]+)"]))
_LATIN = regex.compile(r"\p{Script=Latin}+")


@dataclass(frozen=True)
class Band:
    """Limits within which a document of some script is kept."""

    min_chars_per_token: float
    max_chars_per_token: float
    max_byte_share: float
    # Bits per token of the document's own token distribution. Few distinct tokens, however long the
    # text, give little; a floor in bits, unlike a share of the possible, asks no more of long texts.
    min_entropy: float
    # Entropy over characters per token. Where a script is spelt letter by letter, or in pairs of letters, letters
    # drawn at random cost more bits a character than words do.
    max_bits_per_char: float = math.inf
    # Digits and marks take about a token each in any text, so that a table, a list of references or a log has few
    # characters per token. Where they abound, letters decide: those of pieces that hold any.
    min_letters_per_piece: float = math.inf


# Set from clean text: the documents (Latin: 13 of 9086 below 2.0 characters per token, 3.51 bits a character at
# most) and sentences of 36 languages, beside noise (random lower-case letters: 1.75 to 1.91 characters per token,
# Russian ones 1.27 to 1.58, mojibake 1.10 at most). Scripts from Greek on are spelt letter by letter, so that
# their own letters in random order differ little from text; what tells them is bytes and bits a character.
BANDS: dict[str, Band] = {
    "Latin": Band(1.9, 9.0, 0.2, 2.5, 3.65, 1.6),
    "Latin marked": Band(1.2, 9.0, 0.25, 2.5),
    "Cyrillic": Band(1.9, 7.0, 0.2, 2.5, 3.8, 1.6),
    "Cyrillic marked": Band(1.42, 7.0, 0.2, 2.5),
    "Greek": Band(0.9, 6.0, 0.25, 2.5, 4.75),
    "Arabic": Band(0.85, 6.0, 0.25, 2.5, 4.85),
    "Hebrew": Band(0.9, 6.0, 0.25, 2.5, 4.35),
    "Devanagari": Band(0.8, 6.0, 0.25, 2.5, 5.4),
    "Han": Band(0.5, 4.0, 0.45, 2.5),
    "Hiragana": Band(0.65, 4.0, 0.35, 2.5),
    "Katakana": Band(0.65, 4.0, 0.35, 2.5),
    "Hangul": Band(0.5, 4.0, 0.45, 2.5),
    "Thai": Band(0.8, 6.0, 0.25, 2.5, 5.6),
    # Languages that the vocabulary may spell in bytes throughout.
    "other": Band(0.25, 9.0, 0.99, 2.0),
}
# ASCII digits and marks abound from this share of all characters but spaces; below the other share of letters there is
# no telling by letters, and a column of numbers is taken as it is. Clean text rich in marks (tables, references, logs,
# records, code) has 1.8 letters a piece and more, noise 1.4 at most (hex strings).
MANY_MARKS, FEW_LETTERS = 0.25, 0.05
# Letters beyond the common ones of their script, and the share of all its letters from which a text is "marked".
MARKED = {"Latin": (regex.compile(r"(?V1)[\p{Script=Latin}--[A-Za-z]]"), _LATIN, 0.10),
          "Cyrillic": (regex.compile(r"(?V1)[\p{Script=Cyrillic}--[\u0400-\u045f]]"), regex.compile(r"\p{Script=Cyrillic}+"), 0.03)}
_MARKS = np.array([c for c in range(33, 127) if not chr(c).isalpha()])
# Above 2 ** EVEN_FROM tokens a text repeats some: each doubling costs it EVEN_COST bits of the possible at least.
EVEN_FROM, EVEN_COST = 7, 0.25


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 10
    max_repeat_percent: int = 20
    # Below so many tokens the shares say little, and only the base rules judge.
    min_tokens: int = 32
    bands: Mapping[str, Band] = field(default_factory=lambda: dict(BANDS))


def script_of(text: str) -> str:
    """The script of most letters; "other" where none of the known ones leads."""
    if text.isascii():
        return "Latin"
    counts = dict.fromkeys((*SCRIPTS, "other"), 0)
    for match in _NON_LATIN.finditer(text):
        counts[match.lastgroup] += match.end() - match.start()
    if any(counts.values()):
        counts["Latin"] = sum(m.end() - m.start() for m in _LATIN.finditer(text))
    else:
        return "Latin"
    return max(counts, key=counts.get)


def is_marked(script: str, text: str) -> bool:
    """Whether many of a text's letters lie beyond the common ones of its script."""
    if script not in MARKED or text.isascii():
        return False
    rare, letters, share = MARKED[script]
    return sum(1 for _ in rare.finditer(text)) >= share * sum(m.end() - m.start() for m in letters.finditer(text))


def _names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer names for the pairs (left, right); equal pairs get equal names."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1].astype(np.int64)


def repeated_window_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found twice or more.

    Windows are named exactly, by naming pairs, pairs of pairs and the fifth
    word in turn; memory is a few integers per word.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=n)
    if len(index) == n:
        return 0
    pairs = _names(ids[:-1], ids[1:])
    if int(pairs.max()) + 1 == len(pairs):
        return 0
    fours = _names(pairs[:-2], pairs[2:])
    if int(fours.max()) + 1 == len(fours):
        return 0
    fives = _names(fours[:-1], ids[4:])
    repeated = np.bincount(fives)[fives] > 1
    steps = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(repeated)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(steps[:-1])))


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(WHITE_SPACE)]
    return len(lines) - len(set(lines))


def base_figures(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at 09-0D and 20 only
    word_chars = len(text) - sum(map(text.count, WHITE_SPACE))
    return (len(words), word_chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text),
            repeated_window_words(words))


def fertility(model: PieceModel, text: str, ids: np.ndarray) -> tuple[int, float, float, float]:
    """(tokens, characters per token, byte-fallback share, token entropy in bits)."""
    n = len(ids)
    if n == 0:
        return 0, 0.0, 0.0, 0.0
    ordered = np.sort(ids)
    edges = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
    counts = np.diff(np.concatenate(([0], edges, [n])))
    p = counts / n
    return (n, len(text) / n, float(np.count_nonzero(model.is_byte[ids])) / n, float(-(p * np.log2(p)).sum()) + 0.0)


def rich_in_marks(model: PieceModel, text: str, ids: np.ndarray, band: Band) -> bool:
    """Whether digits and marks abound in a text whose letters are spelt as words are."""
    if math.isinf(band.min_letters_per_piece):
        return False
    shown = len(text) - sum(map(text.count, WHITE_SPACE))
    ascii_bytes = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
    if ascii_bytes[_MARKS].sum() < MANY_MARKS * shown:
        return False
    letters = model.letters[ids]
    pieces = np.count_nonzero(letters)
    return letters.sum() < FEW_LETTERS * shown or letters.sum() >= band.min_letters_per_piece * pieces


def verdict(params: QualityParams, script: str, tokens: int, chars_per_token: float, byte_share: float,
            entropy: float, text: str = "", ids: np.ndarray | None = None, model: PieceModel | None = None) -> str | None:
    """The band that a document breaks, or None. ``text`` tells whether the band for marked letters holds, ``ids``
    whether it is rich in digits and marks: then neither limit that counts characters per token holds."""
    if tokens < params.min_tokens:
        return None
    figures = (tokens, chars_per_token, byte_share, entropy)
    band = params.bands.get(script, params.bands["other"])
    reason = _broken(band, *figures)
    if reason == TOO_FEW and model is not None and rich_in_marks(model, text, ids, band):
        return _broken(replace(band, min_chars_per_token=0.0, max_bits_per_char=math.inf), *figures)
    marked = params.bands.get(f"{script} marked")
    if reason and marked and is_marked(script, text):
        return _broken(marked, *figures)
    return reason


TOO_FEW = "too few characters per token"


def _broken(band: Band, tokens: int, chars_per_token: float, byte_share: float, entropy: float) -> str | None:
    if chars_per_token < band.min_chars_per_token:
        return TOO_FEW
    if chars_per_token > band.max_chars_per_token:
        return "too many characters per token"
    if byte_share > band.max_byte_share:
        return "byte fallback"
    if entropy < band.min_entropy:
        return "token entropy"
    possible = math.log2(tokens)
    if entropy > band.max_bits_per_char * chars_per_token or entropy > possible - EVEN_COST * max(0.0, possible - EVEN_FROM):
        return "too much token entropy"
    return None


FIGURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, script string, n_tokens long, chars_per_token double, byte_share double, "
           "token_entropy double, reason string, kept boolean")


def quality_figures(docs: DataFrame, model_path: str, params: QualityParams | None = None, id_col: str = "doc_id",
                    text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: the id, ``carry`` columns and the figures with the verdict.

    Null and empty texts have no words: the base rules fail them. A null id
    stays null; repeated rows are judged one by one and alike; very long texts
    are measured whole, with a few integers per word and token; other columns
    of ``docs`` are ignored, whatever their names. An empty table gives an
    empty result. ``carry`` may not name a figure.
    """
    params = params or QualityParams()
    keep = (id_col, *[c for c in carry if c != id_col])
    figure_names = [f.split()[0] for f in FIGURES.split(", ")]
    clash = set(keep) & set(figure_names)
    if clash:
        raise ValueError(f"columns named like figures: {sorted(clash)}")
    columns = list(dict.fromkeys((*keep, text_col)))
    source = docs.select(*columns)
    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}

    def judge(batch: pa.RecordBatch):
        model = piece_model(model_path)
        texts = [t or "" for t in batch.column(text_col).to_pylist()]
        rows = []
        for text, ids in zip(texts, model.encode(texts)):
            base = base_figures(text)
            failed = base[0] < params.min_words or 100 * base[4] > params.max_repeat_percent * base[0]
            script = script_of(text)
            figures = fertility(model, text, ids)
            reason = "base rules" if failed else verdict(params, script, *figures, text, ids, model)
            rows.append((*base, failed, script, *figures, reason, reason is None))
        out = {c: batch.column(c) for c in keep}
        out.update(zip(figure_names, zip(*rows) if rows else [[] for _ in figure_names]))
        yield out

    return map_batches(source, judge, ", ".join(f"`{c}` {types[c]}" for c in keep) + ", " + FIGURES)
