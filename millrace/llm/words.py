"""Words of many texts at once: segmentation and hashing on UTF-8 bytes.

A lexer says which bytes belong to words.  All bytes of 0x80 and above do, so
splitting on bytes equals splitting on code points.  A word's hash is a
polynomial of random byte values modulo 2**64, taken from prefix sums, with a
final mix; it costs a few numpy passes over the bytes, whatever the vocabulary.
Texts are cut into segments of bounded size at bytes that are in no word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

_SEGMENT = 1 << 17
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64's end)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, _SEGMENT * 2), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known[:n]


class Lexer:
    """Which bytes form words, and whether A-Z fold to a-z."""

    def __init__(self, breaks: bytes, fold: bool):
        self.inside = np.ones(256, bool)
        self.inside[list(breaks)] = False
        values = np.random.Generator(np.random.PCG64(20240501)).integers(1, 2**63, 256, np.uint64)
        if fold:
            values[65:91] = values[97:123]
        self.values = values

    def hash(self, word: str) -> int:
        """The hash of one word, as the segments have it."""
        return int(self.words([word]).hash[0])

    def words(self, texts: list[str | None]) -> Words:
        """All words of some texts."""
        return lex(self, pa.array([t or "" for t in texts], pa.large_string()))


#: [0-9A-Za-z and all beyond ASCII], folded.
ALNUM = Lexer(bytes(i for i in range(128) if not chr(i).isalnum()), True)
#: All but white space, as written.
SPACED = Lexer(b" \t\n\x0b\x0c\r", False)


@dataclass
class Words:
    """row: index of the text; start, end: byte offsets in that text.

    prefix: by length in bytes, hashes of the words' beginnings; 0 where the
    word is no longer than that.
    """

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    rows: int
    prefix: dict[int, np.ndarray] = field(default_factory=dict)

    def bounds(self) -> np.ndarray:
        """rows + 1 offsets: the words of text i are bounds[i]:bounds[i + 1]."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def _segments(lexer: Lexer, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row + 1, first byte, last byte + 1), whole words each."""
    row, rows = 0, len(at) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(at, at[row] + _SEGMENT, "right")) - 1)
        last = min(last, rows)
        lo, end = int(at[row]), int(at[last])
        while end - lo > _SEGMENT:  # a single long text
            cut = lo + _SEGMENT
            while cut < end and lexer.inside[data[cut]]:
                cut += 1
            yield row, last, lo, cut
            lo = cut
        yield row, last, lo, end
        row = last


def lex(lexer: Lexer, column: pa.Array, prefixes: tuple[int, ...] = ()) -> Words:
    """The words of a string column, with the hashes of some prefixes."""
    data, at = raw(column)
    parts: list[tuple[np.ndarray, ...]] = []
    for row, last, lo, hi in _segments(lexer, data, at):
        piece = data[lo:hi]
        n = len(piece)
        if not n:
            continue
        inside = lexer.inside[piece]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        edge = at[row + 1 : last] - lo
        edge = edge[(edge > 0) & (edge < n)]
        start[edge] = inside[edge]
        stop = np.empty(n, bool)
        stop[:-1] = inside[:-1] & (~inside[1:] | start[1:])
        stop[-1] = inside[-1]
        s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(lexer.values[piece] * _power(_BASE, n), out=sums[1:])
        scale = _power(_INVERSE, n)[s]
        h = mix((sums[e] - sums[s]) * scale + (e - s).astype(np.uint64))
        heads = [np.where(e - s > k, mix((sums[np.minimum(s + k, n)] - sums[s]) * scale + np.uint64(k + (1 << 40))), np.uint64(0)) for k in prefixes]
        owner = np.searchsorted(at[row : last + 1], s + lo, "right") - 1 + row
        parts.append((owner, s + lo - at[owner], e + lo - at[owner], h, *heads))
    if not parts:
        zero = np.zeros(0, np.int64)
        return Words(zero, zero, zero, np.zeros(0, np.uint64), len(at) - 1, {k: np.zeros(0, np.uint64) for k in prefixes})
    row, first, last, h, *heads = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Words(row, first, last, h, len(at) - 1, dict(zip(prefixes, heads, strict=True)))


def windows(row: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word index of each k-word window that lies in one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = hashes[:n].copy()
    for j in range(1, k):
        acc = acc * np.uint64(0xD1342543DE82EF95) + hashes[j : n + j]
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return mix(acc[at]), at


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each k-word shingle; a shorter text with words is one."""
    h, at = windows(words.row, words.hash, k)
    bounds = words.bounds()
    counts = np.diff(bounds)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if not len(short):
        return words.row[at], h
    acc = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        has = counts[short] > j
        acc[has] = acc[has] * np.uint64(0xD1342543DE82EF95) + words.hash[bounds[short[has]] + j]
    row = np.concatenate([words.row[at], short])
    h = np.concatenate([h, mix(acc + counts[short].astype(np.uint64))])
    order = np.argsort(row, kind="stable")
    return row[order], h[order]


def parts(column: pa.Array, size: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about ``size`` bytes each."""
    _, at = raw(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        last = min(rows, max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1))
        yield row, last
        row = last
