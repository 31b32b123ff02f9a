"""Words of many texts at once, as positions in one byte buffer, and rolling 64-bit hashes of them."""

from __future__ import annotations

import numpy as np

#: Odd multipliers of the polynomial hashes over bytes and over words.
OF_BYTES, OF_WORDS = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: The same modulo 2**64.
MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole number."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, kept as far as they were needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            self.up, self.down = (_powers(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_bytes, _words = Powers(OF_BYTES), Powers(OF_WORDS)


def _spans(values: np.ndarray, powers: Powers, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed polynomial hashes of values[start:end], all spans at once."""
    up, down = powers.to(len(values) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)))
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of ``texts``: maximal runs of bytes other than 0x20 and 0x09-0x0D.

    ``starts`` and ``ends`` are positions in ``buffer`` (the texts, each followed by a line feed, ASCII letters
    lower-cased if ``lower``); words ``first[i]:first[i + 1]`` are those of text i, which begins at
    ``offsets[i]``.
    """

    def __init__(self, texts: list[bytes], lower: bool = True):
        raw = b"\n".join([*texts, b""])
        self.raw = raw
        self.buffer = np.frombuffer(raw.lower() if lower else raw, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        blank = (self.buffer == 32) | ((self.buffer >= 9) & (self.buffer <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
        self.starts, self.ends = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        return _spans(self.buffer.astype(np.uint64) + np.uint64(1), _bytes, self.starts, self.ends)


def runs(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every run of words ``hashes[start:end]``."""
    return _spans(hashes, _words, starts, ends)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, across texts' borders too."""
    starts = np.arange(max(0, len(hashes) - width + 1))
    return runs(hashes, starts, starts + width)
