"""Word and shingle hashes of UTF-8 texts, vectorised over the buffers of an Arrow column.

Words are the maximal runs of bytes other than space and U+0009..U+000D, after ASCII
lower-casing.  A word is represented by a 64-bit polynomial hash; two different words
share one with a chance of about 2**-60.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_U = np.uint64
_BYTE = np.random.RandomState(20).randint(0, 1 << 63, 256).astype(np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
#: Odd factor of each place in a shingle (at most 16 words).
_PLACE = np.random.RandomState(21).randint(0, 1 << 63, 16).astype(np.uint64) * _U(2) + _U(1)
#: Bytes hashed at a time; temporary arrays take about 40 times as much.
PIECE = 1 << 15


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(offsets: np.ndarray, data: np.ndarray, space: np.ndarray = _SPACE,
                stems: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """(first word of each text and one more entry for the end, hash of every word).

    ``space`` marks the bytes that separate words.  For each length in ``stems`` one more
    array holds the hash of that many leading bytes of every word.
    """
    n = len(data)
    space = space[data]
    begin = ~space
    begin[1:] &= space[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begin[edges] = ~space[edges]
    starts = np.flatnonzero(begin)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return first, *[np.zeros(0, np.uint64)] * (1 + len(stems))
    # a word ends at the next space, at the next word (of the next text) or at the end
    ends = np.append(starts[1:], n)
    breaks = np.flatnonzero(space)
    at = np.searchsorted(breaks, starts)
    inner = at < len(breaks)
    ends[inner] = np.minimum(ends[inner], breaks[at[inner]])
    lengths = ends - starts
    return first, _hashes(data, starts, lengths), *[_hashes(data, starts, np.minimum(lengths, k)) for k in stems]


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    powers = _powers(int(lengths.max()))
    total = np.cumsum(lengths)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(total, (total[i - 1] if i else 0) + PIECE, side="right"))
        j = max(j, i + 1)
        ln = lengths[i:j]
        at = np.cumsum(ln) - ln
        inside = np.arange(int(ln.sum())) - np.repeat(at, ln)
        where = inside + np.repeat(starts[i:j], ln)
        out[i:j] = np.add.reduceat(_BYTE[_LOWER[data[where]]] * powers[inside], at)
        i = j
    return mix(out + lengths.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def shingle_hashes(first: np.ndarray, words: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(first shingle of each text and the end, hash of every shingle with repeats).

    A text with fewer words than ``width`` has one shingle, its whole sequence; a text
    without words has none.
    """
    counts = np.diff(first)
    n_sh = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(n_sh)])
    out = np.empty(int(at[-1]), np.uint64)
    # every window of the whole word sequence, then only those that lie inside one text
    n = len(words) - width + 1
    if n > 0:
        window = words[:n] * _PLACE[0]
        for k in range(1, width):
            window += words[k:n + k] * _PLACE[k]
        long = np.flatnonzero(counts >= width)
        pick = np.repeat(first[long] - at[long], n_sh[long])
        slot = np.repeat(at[long] - np.cumsum(np.append(0, n_sh[long][:-1])), n_sh[long]) + np.arange(len(pick))
        out[slot] = window[slot + pick]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        w = words[first[i]:first[i + 1]]
        out[at[i]] = (w * _PLACE[:len(w)]).sum(dtype=np.uint64) + _U(int(counts[i]))
    return at, mix(out)
