"""Per-worker sentencepiece models and what the operators need to know of their pieces."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import sentencepiece

MARK = "▁"
# Characters handed to the library at once; bounds the Python integers alive at a time.
SLICE_CHARS = 2_000_000
_MODELS: dict[str, PieceModel] = {}


class PieceModel:
    """A sentencepiece model with its byte pieces and piece lengths as arrays."""

    def __init__(self, path: str):
        self.path = path
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.sp.get_piece_size()
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(size)], dtype=bool)
        self.letters = np.array([0 if self.is_byte[i] else sum(map(str.isalpha, self.sp.id_to_piece(i))) for i in range(size)], dtype=np.int64)
        special = np.array([self.sp.is_control(i) or self.sp.is_unknown(i) for i in range(size)], dtype=bool)
        # Normalised bytes that each piece covers; -1 where the text decides (an unknown character).
        self.piece_bytes = np.array([len(self.sp.id_to_piece(i).encode()) for i in range(size)], dtype=np.int64)
        self.piece_bytes[self.is_byte] = 1
        self.piece_bytes[special] = -1

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as the library's ``encode`` gives them."""
        start = 0
        while start < len(texts):
            stop, chars = start, 0
            while stop < len(texts) and (stop == start or chars + len(texts[stop]) <= SLICE_CHARS):
                chars += len(texts[stop])
                stop += 1
            for ids in self.sp.encode(list(texts[start:stop]), num_threads=1):
                yield np.array(ids, dtype=np.uint32)
            start = stop


def piece_model(path: str) -> PieceModel:
    """The model of this Python worker, loaded once."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]
