"""Texts as flat arrays of code points, and the tokens in them."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from notequarry.llm.common import mix

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point of the basic plane, from Unicode's own properties."""
    found = np.full(65_536, OTHER, np.uint8)
    for i in range(65_536):
        c = chr(i)
        found[i] = SPACE if c.isspace() else LETTER if c.isalpha() else DIGIT if c.isdigit() else OTHER
    return found


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    """Lower-case code point of each code point of the basic plane, where that is one."""
    lowered = [chr(i).lower() for i in range(65_536)]
    return np.array([ord(x) if len(x) == 1 else i for i, x in enumerate(lowered)], np.uint32)


class Chars:
    """Code points of several texts, one after another, each followed by a line break."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts) + "\n"
        self.code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.kind = _classes()[np.minimum(self.code, 65_535)]
        self.kind = np.where(self.code > 65_535, LETTER, self.kind)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_start = np.cumsum(sizes) - sizes

    def lowered(self) -> np.ndarray:
        """The code points in lower case, place by place."""
        return np.where(self.code < 65_536, _lower()[np.minimum(self.code, 65_535)], self.code)

    def runs(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of the longest runs of one value other than SPACE."""
        edge = np.concatenate([[0], np.flatnonzero(kinds[1:] != kinds[:-1]) + 1, [len(kinds)]])
        start, size = edge[:-1], np.diff(edge)
        kept = kinds[start] != SPACE
        return start[kept], size[kept]

    def hashes(self, start: np.ndarray, size: np.ndarray, code: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each run of code points, of the texts' own or of ``code``."""
        code = self.code if code is None else code
        if not len(start):
            return np.zeros(0, np.uint64)
        total = np.cumsum(size)
        inside = np.arange(total[-1]) - np.repeat(total - size, size)
        powers = np.cumprod(np.full(int(size.max()), _BASE, np.uint64))
        values = mix(code[np.repeat(start, size) + inside].astype(np.uint64) + np.uint64(7)) * powers[inside]
        return mix(np.add.reduceat(values, total - size))


def window_hashes(code: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every stretch of n code points."""
    size = max(0, len(code) - n + 1)
    found = np.full(size, n, np.uint64)
    for j in range(n):
        found = found * _BASE + code[j : size + j].astype(np.uint64) + np.uint64(1)
    return mix(found)


def slices(texts: list[str], limit: int = 1_000_000):
    """Runs of texts of a bounded number of characters, one text at least."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values`` that begin at ``starts`` and end at the next; empty ones are 0."""
    padded = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
    found = np.add.reduceat(padded, np.minimum(starts, len(values)), axis=0)
    size = np.diff(np.append(starts, len(values)))
    found[size == 0] = 0
    return found
