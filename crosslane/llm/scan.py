"""Vectorised scanning of Arrow string columns: words, word hashes, shingles.

Everything here runs inside Spark tasks on a bounded slice of a batch, as NumPy
arrays over the UTF-8 bytes of many texts at once; nothing loops over characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; one longer text is a slice of its own.
SLICE_BYTES = 512 << 10

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


#: One random number for each byte value at each of 64 places of a word.
_PLACES = mix64((np.arange(64 * 256, dtype=np.uint64) + np.uint64(1)) * _GOLD)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, bytes, offsets) over runs of rows; a null text has no bytes.

    ``offsets`` has one entry more than the run has rows and starts at 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words (runs of bytes other than 0x20 and 0x09-0x0D)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)  # a text begins here
    cut[offsets[:-1]] = True
    cut[len(data)] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | cut[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges that follow one another without overlap: equal bytes, equal hash."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    total = np.cumsum(sizes)
    place = np.arange(total[-1]) - np.repeat(total - sizes, sizes)
    values = _PLACES[((place & 63) << 8) | data[place + np.repeat(starts, sizes)]]
    if sizes.max() > 64:
        far = place > 63
        values[far] = mix64(values[far] + (place[far] >> 6).astype(np.uint64) * _GOLD)
    return mix64(np.add.reduceat(values, total - sizes) + sizes.astype(np.uint64) * _GOLD)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (hashes sorted within each row, row bounds).

    Words are lower-cased in A-Z. A text of 1 to ``width - 1`` words is one shingle
    as a whole; a text without words has none.
    """
    n = len(offsets) - 1
    starts, ends, rows = word_bounds(data, offsets)
    words = word_hashes(lower_ascii(data), starts, ends)
    counts = np.bincount(rows, minlength=n)
    odd = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    full = max(0, len(words) - width + 1)
    sums = np.zeros(full, np.uint64)
    for k in range(width):
        sums += words[k : k + full] * odd[k]
    same = rows[:full] == rows[width - 1 :][:full] if full else np.zeros(0, bool)
    hashes, owners = mix64(sums[same] + np.uint64(width)), rows[:full][same]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        begin = np.cumsum(counts) - counts
        for k in range(width - 1):
            use = short[counts[short] > k]
            if k == 0:
                part = np.zeros(n, np.uint64)
            part[use] += words[begin[use] + k] * odd[k]
        hashes = np.concatenate([hashes, mix64(part[short] + counts[short].astype(np.uint64))])
        owners = np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    if len(hashes):
        keep = np.ones(len(hashes), bool)
        keep[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners = hashes[keep], owners[keep]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=n))]).astype(np.int64)
