"""Vectorised word splitting and hashing of Arrow text batches.

Words are maximal runs of bytes outside a separator set, read from the
UTF-8 buffer of a whole Arrow batch at once (a multi-byte character never
contains an ASCII byte, so splitting on ASCII separators is exact).  Every
word gets a 64-bit hash; documents are index ranges into the word arrays.
Null texts count as empty.  Texts of any length are handled whole; a batch
is cut into slices of at most ``SLICE_BYTES`` (one text is never cut).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    """Powers 0..n-1 of the multiplier (kept for words up to 4096 bytes)."""
    global _POWERS
    if n <= len(_POWERS):
        return _POWERS
    p = np.full(n, _MULT, np.uint64)
    p[0] = 1
    p = np.cumprod(p, dtype=np.uint64)
    if n <= 4096:
        _POWERS = p
    return p


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every bit of a sum counts."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def separator_table(extra: bytes = b"") -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(WHITE + extra)] = True
    return t


SPACES = separator_table()
#: White space and every ASCII character that is neither letter nor digit.
NON_ALNUM = separator_table(bytes(c for c in range(128) if not chr(c).isalnum()))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """Words of some texts: hash, byte span in ``buf`` and first word of each text."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool):
        lo, hi = int(offsets[0]), int(offsets[-1])
        self.buf = raw = buf[lo:hi]
        self.doc_bytes = offs = offsets - lo
        inside = ~table[raw]
        n = len(raw)
        starts = inside.copy()
        ends = np.zeros(n + 1, bool)
        ends[1:] = inside
        if n:
            starts[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside
            cut = offs[1:-1]
            cut = cut[(cut > 0) & (cut < n)]
            cut = cut[inside[cut] & inside[cut - 1]]
            starts[cut] = True
            ends[cut] = True
        ends[0] = False
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends)
        self.first = np.searchsorted(self.start, offs)
        if len(self.start):
            lens = self.end - self.start
            data = raw[inside]
            if lower:
                data = _LOWER[data]
            at = np.concatenate(([0], np.cumsum(lens)[:-1]))
            pos = np.arange(len(data)) - np.repeat(at, lens)
            self.hash = mix(np.add.reduceat(_BYTE[data] * _powers(int(lens.max()))[pos], at))
        else:
            self.hash = np.empty(0, np.uint64)

    def __len__(self) -> int:
        return len(self.start)

    def docs(self) -> int:
        return len(self.first) - 1

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs()), np.diff(self.first))

    def text(self, a: int, b: int) -> bytes:
        """Words a..b-1 of one document, joined by single spaces."""
        data = self.buf
        return b" ".join(data[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b]))


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, buffer, offsets) of runs of rows of bounded size."""
    col = col.cast(pa.large_string()).fill_null("")
    if not len(col):
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    a = 0
    while a < len(col):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, len(col))
        yield a, b, buf, offsets[a:b + 1]
        a = b


def batch_words(col: pa.Array, table: np.ndarray = SPACES, lower: bool = False,
                limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    for a, b, buf, offs in slices(col, limit):
        yield a, b, Words(buf, offs, table, lower)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position (across documents; callers mask)."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out = out * _MULT + h[j:len(h) - n + 1 + j]
    return mix(out + _U(n))
