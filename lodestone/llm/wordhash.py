"""Vectorised word splitting and hashing over many texts at once.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` in the UTF-8
text.  All arrays are numpy; nothing here loops over single words.  Hashes
are polynomials modulo 2**64 over per-byte random values (the multiplier is
odd, so it has an inverse and any span's hash is a difference of prefix
sums), followed by a 64-bit finaliser.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 2**63, size=(2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MOD = 1 << 64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n (kept, grown on demand)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        tables = []
        for b in (base, pow(base, -1, _MOD)):
            p = np.ones(size, dtype=np.uint64)
            step = 1
            while step < size:
                p[step : 2 * step] = p[:step] * np.uint64(pow(b, step, _MOD))
                step *= 2
            tables.append(p)
        have = _POWERS[base] = (tables[0], tables[1])
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; new array."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words of a block of texts: byte offsets, owners, hashes."""

    def __init__(self, texts: list[bytes]):
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.data = b" ".join(texts) + b" "
        raw = np.frombuffer(self.data, dtype=np.uint8)
        space = SPACE[raw]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
        # the block ends in a space, so edges alternate start, end
        self.start, self.end = edge[0::2], edge[1::2]
        self.raw = raw
        self.text_start = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
        #: index of the first word of each text, and one past the last of all
        self.first = np.append(np.searchsorted(self.start, self.text_start), len(self.start))
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashes(self, which: int = 0) -> np.ndarray:
        power, inverse = _powers(_BASE[which], len(self.raw) + 1)
        total = np.zeros(len(self.raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[which][self.raw] * power[: len(self.raw)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * inverse[self.start])


def grams(word: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hash of each run of n consecutive values; len(word) - n + 1 long."""
    if len(word) < n:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _powers(_BASE[which], len(word) + 1)
    total = np.zeros(len(word) + 1, dtype=np.uint64)
    np.cumsum(word * power[: len(word)], out=total[1:])
    return mix((total[n:] - total[:-n]) * inverse[: len(word) - n + 1])


def spans_hash(word: np.ndarray, a: np.ndarray, b: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of word[a:b] for arrays of bounds; equal to grams() on equal runs."""
    power, inverse = _powers(_BASE[which], len(word) + 1)
    total = np.zeros(len(word) + 1, dtype=np.uint64)
    np.cumsum(word * power[: len(word)], out=total[1:])
    return mix((total[b] - total[a]) * inverse[a])


def blocks(texts: Iterable, limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Cut a column of texts (None: empty) into runs of about `limit` bytes.

    Yields (index of the first text, texts as UTF-8).  A longer text is a
    block of its own: texts are never cut.
    """
    at, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if held and size + len(b) > limit:
            yield at, held
            at, held, size = i, [], 0
        held.append(b)
        size += len(b) + 1
    if held:
        yield at, held


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    n, have = len(x) - w + 1, 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[w - have : w - have + n]) if n > 0 else x[:0]
