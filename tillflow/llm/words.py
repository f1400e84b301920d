"""Words of whole Arrow string batches, hashed without a Python loop over documents or words.

A word is a longest run of bytes other than space and tab to carriage return; these are ASCII, so
the rule on UTF-8 bytes is the rule on code points. Hashes are 64-bit polynomials modulo 2**64, so a
word, a prefix of one, or a run of words costs a few array operations each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Every byte value stands for a 64-bit number of its own, so that short words differ in all bits.
_BYTE = np.random.default_rng(20_011).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(kind: str, n: int) -> np.ndarray:
    """1, x, x**2, … for the base (up) or its inverse (down), at least n of them."""
    have = _POWERS[kind]
    if len(have) < n:
        grown = np.full(max(n, 2 * len(have)), _BASE if kind == "up" else _INVERSE, np.uint64)
        grown[0] = 1
        have = _POWERS[kind] = np.cumprod(grown, dtype=np.uint64)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """start, stop: byte ranges of all words in `data`; doc: the document of each word; first:
    where each document's words begin (one longer than the number of documents)."""

    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    sums: np.ndarray

    def hashes(self, length: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first `length` bytes (the whole word if shorter)."""
        stop = self.stop if length is None else np.minimum(self.stop, self.start + length)
        down = _powers("down", len(self.data) + 1)
        raw = (self.sums[stop] - self.sums[self.start]) * down[self.start]
        return mix(raw + (stop - self.start).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts on end, and their offsets; NULL is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(texts: pa.Array, lower: bool = True) -> Words:
    """All words of a batch of texts; `lower` folds A to Z first."""
    data, offsets = buffers(texts)
    if lower:
        data = _LOWER[data]
    n = len(data)
    solid = np.zeros(n + 2, np.int8)
    solid[1:-1] = ~_SPACE[data]
    edge = np.diff(solid)
    # A text's first byte begins a word even where the text before it ends without a space.
    inner = offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < n)])
    glued = inner[(solid[inner] == 1) & (solid[inner + 1] == 1)]
    start = np.flatnonzero(edge == 1)
    stop = np.flatnonzero(edge == -1)
    if len(glued):
        start, stop = np.sort(np.append(start, glued)), np.sort(np.append(stop, glued))
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers("up", n + 1)[:n], out=sums[1:], dtype=np.uint64)
    return Words(data, start, stop, doc, first, sums)


def slices(texts: pa.Array, most: int = 1 << 19, rows: int | None = None) -> list[tuple[int, int]]:
    """Runs of rows of about `most` bytes at most, and of `rows` rows if given, so that working arrays
    stay bounded; a longer text is a run of its own."""
    _, offsets = buffers(texts)
    cuts, begin = [], 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
        end = min(max(end, begin + 1), len(texts), begin + (rows or len(texts)))
        cuts.append((begin, end))
        begin = end
    return cuts
