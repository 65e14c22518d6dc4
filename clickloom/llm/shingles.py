"""Word hashes and word shingles of Arrow text columns, in numpy, a bounded piece at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes handled at once; a longer text is cut at white space.
PIECE = 1 << 19
#: Space, tab, line feed, vertical tab, form feed, carriage return.
IS_GAP = np.zeros(256, bool)
IS_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finish)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U) * BASE)
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[IS_GAP] = 0
    return values


VALUES = {lower: _byte_values(lower) for lower in (False, True)}
#: Salts that tell short texts from shingles.
LENGTHS = mix(np.arange(1000, 1064, dtype=U) * BASE)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        _powers[:] = [
            np.cumprod(np.r_[U(1), np.full(size - 1, b, U)], dtype=U) for b in (BASE, INVERSE)
        ]
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; NULL counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def spans(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of at most ``limit`` bytes; a longer text has a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _hashes(data: np.ndarray, starts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first bytes and ends of the words in ``data``; texts begin at ``starts``."""
    gap = IS_GAP[data]
    begins = np.ones(len(data) + 1, bool)
    begins[1:-1] = gap[:-1]
    begins[starts[starts < len(data)]] = True
    word = ~gap
    first = np.flatnonzero(word & begins[:-1])
    ends_here = np.r_[gap[1:], True]
    inner = starts[(starts > 0) & (starts < len(data))]
    ends_here[inner - 1] = True
    last = np.flatnonzero(word & ends_here) + 1
    up, down = powers(len(data) + 1)
    total = np.r_[U(0), np.cumsum(VALUES[lower][data] * up[:-1], dtype=U)]
    return mix((total[last] - total[first]) * down[first] + (last - first).astype(U)), first, last


def word_table(
    data: np.ndarray, offsets: np.ndarray, lower: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of consecutive texts: hash, first byte, end, and the text number of each."""
    base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    if size <= PIECE or len(offsets) > 2:
        found, first, last = _hashes(data[base : base + size], offsets[:-1] - base, lower)
        return found, first + base, last + base, np.searchsorted(offsets[1:] - base, first, "right")
    # One long text: pieces end at white space.
    parts, at = [], base
    while at < base + size:
        end = min(at + PIECE, base + size)
        while end < base + size:
            near = np.flatnonzero(IS_GAP[data[at:end]])
            if len(near):
                end = at + int(near[-1]) + 1
                break
            end = min(end + PIECE, base + size)
        found, first, last = _hashes(data[at:end], np.zeros(1, np.int64), lower)
        parts.append((found, first + at, last + at))
        at = end
    found, first, last = (np.concatenate(c) for c in zip(*parts, strict=True))
    return found, first, last, np.zeros(len(found), np.int64)


def shingle_sets(column: pa.Array, words: int, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, sorted distinct 64-bit hashes of its shingles) of every text.

    A text of fewer than ``words`` words, but at least one, has the whole sequence as its
    only shingle; one without words has none.
    """
    data, offsets = text_bytes(column)
    factors = mix(np.arange(1, words + 1, dtype=U) * U(0xD1342543DE82EF95)) | U(1)
    none = np.zeros(0, U)
    for first, last in spans(offsets):
        hashes, _, _, text = word_table(data, offsets[first : last + 1], lower)
        edges = np.searchsorted(text, np.arange(last - first + 1))
        n = len(hashes) - words + 1
        if n > 0:
            run = np.zeros(n, U)
            for j in range(words):
                run += hashes[j : j + n] * factors[j]
            run = mix(run)
        for i in range(last - first):
            a, b = int(edges[i]), int(edges[i + 1])
            if b - a >= words:
                yield first + i, np.unique(run[a : b - words + 1])
            elif b > a:
                whole = (hashes[a:b] * factors[: b - a]).sum(dtype=U, keepdims=True)
                yield first + i, mix(whole ^ LENGTHS[b - a])
            else:
                yield first + i, none
