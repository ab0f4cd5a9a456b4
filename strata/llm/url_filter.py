"""URL rules by a bit-parallel wildcard automaton.

All rules are glob patterns over the canonical URL (host, then path). Their
positions are packed one after the other into 64-bit words, and one Shift-And
step per URL byte advances every position of every pattern at once:

    D = ((D << 1) & B[byte]) | (D & L[byte])

``B`` has the positions that a byte enters, ``L`` the positions that loop on
it (wildcards). Words pass their top bit on to the next. Numpy runs the step
for all URLs of a batch together, so the cost per byte is a few word
operations per 64 pattern positions, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import map_batches

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class HostRule:
    """A verdict for a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class GlobRule:
    """A verdict for canonical URLs that match a glob.

    ``*`` stands for any bytes but ``/``, ``**`` for any bytes, ``?`` for one
    byte but ``/``; the glob must match the whole of host and path.
    """

    verdict: str
    glob: str


class Automaton:
    """Globs compiled into multiword Shift-And masks."""

    def __init__(self, globs: Sequence[str]):
        patterns = [self._symbols(g) for g in globs]
        size = sum(len(p) + 1 for p in patterns)
        self.words = max(1, -(-size // 64))
        self.enter = np.zeros((256, self.words), dtype=np.uint64)
        self.loop = np.zeros((256, self.words), dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        self.final: list[tuple[int, int]] = []
        no_slash = [b for b in range(256) if b != 0x2F]
        at = 0
        for symbols in patterns:
            self._set(self.start, at)
            for symbol in symbols:
                kind, value = symbol
                if kind == "loop":
                    for b in range(256) if value == "**" else no_slash:
                        self._set(self.loop[b], at)
                else:
                    at += 1
                    for b in no_slash if kind == "one" else [value]:
                        self._set(self.enter[b], at)
            self.final.append((at // 64, at % 64))
            at += 1

    @staticmethod
    def _set(mask: np.ndarray, at: int) -> None:
        mask[at // 64] |= np.uint64(1 << at % 64)

    @staticmethod
    def _symbols(glob: str) -> list[tuple[str, object]]:
        out: list[tuple[str, object]] = []
        data, i = glob.encode(), 0
        while i < len(data):
            if data[i] == 0x2A:
                stars = 2 if data[i + 1:i + 2] == b"*" else 1
                out.append(("loop", "*" * stars))
                i += stars
            else:
                out.append(("one", None) if data[i] == 0x3F else ("byte", data[i]))
                i += 1
        return out

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """matches[i, g]: whether text i as a whole matches glob g."""
        n = len(texts)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=n)
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        begins = np.concatenate(([0], np.cumsum(lengths)))[:-1][order]
        state = np.tile(self.start, (n, 1))
        lengths = lengths[order]
        running = n
        for at in range(int(lengths[0]) if n else 0):
            # Longest first: the texts that still have a byte here are a prefix.
            running = int(np.searchsorted(-lengths[:running], -at, side="left"))
            byte = data[begins[:running] + at]
            now = state[:running]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:running] = (moved & self.enter[byte]) | (now & self.loop[byte])
        out = np.zeros((n, len(self.final)), dtype=bool)
        for g, (word, bit) in enumerate(self.final):
            out[order, g] = (state[:, word] >> np.uint64(bit)) & np.uint64(1) == 1
        return out


def canonical(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL; both empty for null or without ``://``.

    The host runs from the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    with A-Z lower-cased; the path from there up to ``?``, ``#`` or the end.
    """
    if not url:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    for stop in "?#":
        rest = rest.partition(stop)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


class UrlJudge:
    """Host rules, longest first, then globs in order, then a default."""

    def __init__(self, rules: Sequence[HostRule], globs: Sequence[GlobRule] = (), default: str = ALLOW):
        # Of equally long rules that fit, one that blocks wins.
        self.rules = sorted(rules, key=lambda r: (-len(r.text), r.verdict != BLOCK, r.text))
        self.globs, self.default = list(globs), default
        patterns = []
        for rule in self.rules:
            for literal in (rule.host, rule.path):
                if "*" in literal or "?" in literal:
                    raise ValueError(f"a host rule is literal: {rule.text}")
            patterns += [rule.text + "**", "*." + rule.text + "**"]
        self.automaton = Automaton(patterns + [g.glob for g in self.globs])
        self.verdicts = np.array([r.verdict for r in self.rules] + [g.verdict for g in self.globs] + [default], dtype=object)

    def judge(self, urls: Sequence[str | None]) -> tuple[list[str], list[str], list[str | None], list[str]]:
        """(hosts, paths, rules, verdicts) of a batch."""
        parts = [canonical(u) for u in urls]
        hits = self.automaton.match([(h + p).encode("utf-8", "surrogatepass") for h, p in parts])
        pairs = 2 * len(self.rules)
        fits = np.concatenate((hits[:, 0:pairs:2] | hits[:, 1:pairs:2], hits[:, pairs:],
                               np.ones((len(parts), 1), dtype=bool)), axis=1)
        first = fits.argmax(axis=1)
        texts = [r.text for r in self.rules]
        return ([h for h, _ in parts], [p for _, p in parts],
                [texts[i] if i < len(texts) else None for i in first], self.verdicts[first].tolist())


def filter_urls(pages: DataFrame, rules: Sequence[HostRule], globs: Sequence[GlobRule] = (), default: str = ALLOW,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``.

    Null, empty and scheme-less URLs have an empty host and path; no host rule
    fits them and the globs and the default decide. Very long URLs are judged
    whole. Repeated rows each get a row; an empty table gives an empty result;
    other columns are ignored. The step is narrow: nothing is shuffled.
    """
    source = pages.select(id_col, url_col)
    kind = source.schema[id_col].dataType.simpleString()
    judges: list[UrlJudge] = []
    UrlJudge(rules, globs, default)  # a bad rule fails here, not in a task

    def run(batch: pa.RecordBatch):
        if not judges:
            judges.append(UrlJudge(rules, globs, default))
        made = judges[0].judge(batch.column(url_col).to_pylist())
        yield {id_col: batch.column(id_col), **dict(zip(("host", "path", "rule", "verdict"), made))}

    return map_batches(source, run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")
