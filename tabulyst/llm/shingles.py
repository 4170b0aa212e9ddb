"""Word shingles, MinHash samples and odd sketches of whole text batches, vectorised.

Words are runs of bytes other than space and \\x09-\\x0D, with A-Z lower-cased. A word's
hash sums a random value for each byte, times a random value for its place; a shingle
folds the hashes of its words. Both have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tabulyst.llm.common import mixed, numbers

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = numbers(256, 1)
_FOLD = np.uint64(0x9FB21C651E98DF25)
#: Bytes worked on at once: the arrays made from them take some 60 times as much.
BLOCK = 1 << 17


def _place(upto: int) -> np.ndarray:
    return numbers(upto, 2) | np.uint64(1)


def _hashes(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of ``data`` and where each word begins; ``first`` marks rows' starts."""
    data = _LOWER[data]
    inside = ~_SPACE[data]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.uint64), at
    fresh = np.empty(len(at), bool)
    fresh[0] = True
    fresh[1:] = at[1:] != at[:-1] + 1
    fresh |= first[at]
    begins = np.flatnonzero(fresh)
    place = at - np.repeat(at[begins], np.diff(np.append(begins, len(at))))
    value = _BYTE[data[at]] * _place(int(place.max()) + 1)[place]
    return mixed(np.add.reduceat(value, begins)), at[begins]


def _cuts(data: np.ndarray, a: int, b: int) -> Iterator[tuple[int, int]]:
    """A long row's ranges of about BLOCK bytes that end after white space."""
    while a < b:
        end = min(a + BLOCK, b)
        while end < b:
            spaces = np.flatnonzero(_SPACE[data[max(a, end - BLOCK) : end]])
            if len(spaces):
                end = max(a, end - BLOCK) + int(spaces[-1]) + 1
                break
            end = min(end + BLOCK, b)
        yield a, end
        a = end


def words(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of rows: (from, to, hashes of their words, row of each word from 0)."""
    rows, a = len(offsets) - 1, 0
    while a < rows:
        b = int(np.searchsorted(offsets, offsets[a] + BLOCK, "right")) - 1
        b = min(max(b, a + 1), rows)
        lo, hi = int(offsets[a]), int(offsets[b])
        if b == a + 1 and hi - lo > BLOCK:
            some = [_hashes(data[x:y], np.zeros(y - x, bool))[0] for x, y in _cuts(data, lo, hi)]
            hashes = np.concatenate(some)
            yield a, b, hashes, np.zeros(len(hashes), np.int64)
        else:
            first = np.zeros(hi - lo + 1, bool)
            first[offsets[a:b] - lo] = True
            hashes, begins = _hashes(data[lo:hi], first[:-1])
            yield a, b, hashes, np.searchsorted(offsets[a : b + 1] - lo, begins, "right") - 1
        a = b


def shingle_sets(hashes: np.ndarray, row: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, sorted by row and value, and each row's count.

    A row with fewer words than ``size`` has its whole sequence as one; without words, none.
    """
    n = len(hashes)
    counts = np.bincount(row, minlength=rows) if n else np.zeros(rows, np.int64)
    # place of each word in its row, counted from the end: a shingle needs size - 1 after it
    ends = np.cumsum(counts)
    after = ends[row] - 1 - np.arange(n) if n else np.zeros(0, np.int64)
    whole = (counts[row] < size) if n else np.zeros(0, bool)
    at = np.flatnonzero((after >= size - 1) | (whole & (after == counts[row] - 1))) if n else np.zeros(0, np.int64)
    value = mixed(hashes[at] + np.uint64(size))
    for k in range(1, size):
        more = after[at] >= k
        value[more] = mixed(value[more] * _FOLD + hashes[at[more] + k])
    owner = row[at] if n else at
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[keep], owner[keep]
    return value, np.bincount(owner, minlength=rows) if len(owner) else np.zeros(rows, np.int64)


def min_hashes(value: np.ndarray, counts: np.ndarray, samples: int) -> np.ndarray:
    """One row of MinHash samples for each row with shingles (others are left out)."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    factor, shift = numbers(samples, 3) | np.uint64(1), numbers(samples, 4)
    out = np.empty((len(starts), samples), np.uint64)
    for j in range(samples):
        seen = value * factor[j] + shift[j]
        # the high half of a multiply-shift hash is the well mixed one
        out[:, j] = np.minimum.reduceat(seen ^ (seen >> np.uint64(32)), starts)
    return out


def odd_sketches(samples: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps of the samples: each flips one of ``bits`` bits. As 64-bit words."""
    rows, count = samples.shape
    place = mixed(samples + numbers(count, 5)) % np.uint64(bits)
    flat = place.astype(np.int64) + np.arange(rows)[:, None] * bits
    parity = (np.bincount(flat.ravel(), minlength=rows * bits) & 1).astype(np.uint8).reshape(rows, bits)
    return np.packbits(parity, axis=1).view(np.int64)


def odd_sets(value: np.ndarray, counts: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps of whole sets (rows without shingles are left out): each shingle flips
    one of ``bits`` bits. As 64-bit words."""
    counts = counts[counts > 0]
    rows = len(counts)
    place = (mixed(value ^ numbers(1, 8)) % np.uint64(bits)).astype(np.int64)
    flat = place + np.repeat(np.arange(rows), counts) * bits
    parity = (np.bincount(flat, minlength=rows * bits) & 1).astype(np.uint8).reshape(rows, bits)
    return np.packbits(parity, axis=1).view(np.int64)


def bands(samples: np.ndarray, rows_each: int) -> np.ndarray:
    """A 64-bit key for each run of ``rows_each`` samples, told apart by its number."""
    n, count = samples.shape
    parts = samples.reshape(n, count // rows_each, rows_each)
    key = mixed(parts[:, :, 0] + numbers(count // rows_each, 6))
    for k in range(1, rows_each):
        key = mixed(key * _FOLD + parts[:, :, k])
    return key.view(np.int64)


def digests(value: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Two order-free 64-bit sums over each row's shingles (rows without any are left out)."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(starts), 2), np.uint64)
    for j, seed in enumerate(numbers(2, 7)):
        out[:, j] = np.add.reduceat(mixed(value ^ seed), starts) if len(starts) else 0
    return out.view(np.int64)
