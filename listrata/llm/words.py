"""Words of a batch of texts as arrays of 64-bit hashes.

Words are runs of bytes of UTF-8, so a class of code points below 128 plus "everything above" is a
table of 256 entries. A word's hash is a polynomial over its bytes modulo 2^64, mixed; two different
words share one with a probability of about 2^-64.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.ones(1, dtype=np.uint64)


def byte_table(separators: set[int]) -> np.ndarray:
    """For each byte its lower-case value plus 1, or 0 for a separator."""
    lower = np.arange(256)
    lower[ord("A"):ord("Z") + 1] += 32
    out = (lower + 1).astype(np.uint16)
    out[sorted(separators)] = 0
    return out


#: Words between white space: U+0020 and U+0009 to U+000D.
SPACED = byte_table({0x20, *range(0x09, 0x0E)})
#: Words of digits, letters and everything beyond ASCII.
ALNUM = byte_table({*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)})


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of a published hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, _BASE, np.uint64)]), dtype=np.uint64)
    return _POWERS


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


class Words:
    """The words of some texts: one after another, their bytes as terms of the polynomial."""

    def __init__(self, texts: list[str | None], classes: np.ndarray):
        data = [encoded(t) for t in texts]
        self.count = len(texts)
        self.buffer = np.frombuffer(b"\n".join(data) + b"\n", np.uint8) if data else np.zeros(0, np.uint8)
        lowered = classes[self.buffer]
        inside = lowered != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        #: Where in the buffer each word starts, and where each text's words begin among all words.
        self.starts = np.flatnonzero(first)
        ends = np.cumsum([len(d) + 1 for d in data], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.searchsorted(self.starts, ends)]).astype(np.int64)
        values = lowered[inside].astype(np.uint64)
        self.begin = np.flatnonzero(first[inside])
        self.lengths = np.diff(np.append(self.begin, len(values)))
        self.place = np.arange(len(values)) - np.repeat(self.begin, self.lengths)
        self.terms = values * _powers(int(self.lengths.max(initial=0)))[self.place]

    def hashes(self) -> np.ndarray:
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        return mix(np.add.reduceat(self.terms, self.begin) + self.lengths.astype(np.uint64))

    def prefixes(self, size: int) -> np.ndarray:
        """Hash of the first ``size`` bytes of each word; 0 for words that are not longer."""
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        sums = np.add.reduceat(np.where(self.place < size, self.terms, np.uint64(0)), self.begin)
        return np.where(self.lengths > size, mix(sums + np.uint64((1 << 32) + size)), np.uint64(0))


def word_hashes(texts: list[str | None], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one entry more than texts)."""
    found = Words(texts, classes)
    return found.hashes(), found.offsets


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; runs across texts are the caller's to leave out."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    out = hashes[:len(hashes) - width + 1].copy()
    for j in range(1, width):
        out *= _STEP
        out += hashes[j:len(hashes) - width + 1 + j]
    return mix(out + np.uint64(width))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words.

    A text of fewer words is one run as a whole; one without words has an empty set.
    """
    hashes, offsets = word_hashes(texts, SPACED)
    runs = windows(hashes, width)
    sets = []
    for begin, end in zip(offsets[:-1], offsets[1:]):
        count = int(end - begin)
        if count >= width:
            sets.append(np.unique(runs[begin:end - width + 1]))
        else:
            sets.append(windows(hashes[begin:end], count) if count else np.zeros(0, np.uint64))
    return sets
