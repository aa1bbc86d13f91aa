"""Words of a batch of texts as positions and 64-bit hashes, straight from Arrow's bytes.

No Python object is made for a word. A word's hash is a polynomial of its bytes over a
table of random numbers, modulo 2**64; running sums give all words of a stretch at once.
The multiplier is 5 modulo 8, so for different words the sums agree with a chance of
about 2**-56 over the choice of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

_STRETCH = 1 << 20
_P = 0x9E3779B97F4A7C15
assert _P % 8 == 5
_P_INVERSE = pow(_P, -1, 1 << 64)

# ASCII white space; upper-case letters and their lower case.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def _random_table(salt: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(bytes([b]), salt) for b in range(256)], np.uint64)


@lru_cache(maxsize=8)
def _table(fold: bool, salt: int) -> np.ndarray:
    return _random_table(salt)[FOLD] if fold else _random_table(salt)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (_P, _P_INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and where each value begins."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = offsets[0] if len(offsets) else 0
    last = offsets[-1] if len(offsets) else 0
    return whole[first:last], (offsets - first) if len(offsets) else np.zeros(1, np.int64)


def slices(texts: pa.Array, most: int = 256 << 10) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of some bytes in all, a longer text alone, and the place of the first."""
    offsets = buffers(texts)[1]
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, texts.slice(at, upto - at)
        at = upto


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word: a run of bytes that ``between`` does not mark."""
    inside = ~between[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    start[begins] = inside[begins]
    starts = np.flatnonzero(start)
    end = np.zeros(len(data) + 1, bool)
    end[1:] = inside
    end[1:-1] &= ~inside[1:]
    ends_too = offsets[1:][offsets[1:] > 0]
    end[ends_too] = inside[ends_too - 1]
    return starts, np.flatnonzero(end)


def hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True, salt: int = 0
) -> np.ndarray:
    """The 64-bit hash of each stretch [start, end); ``fold`` lower-cases A-Z."""
    table = _table(fold, salt)
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, low + _STRETCH, "right")))
        n = int(ends[upto - 1]) - low
        power, inverse = _powers(max(_STRETCH, 1 << (n - 1).bit_length()))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data[low : low + n]] * power[:n], out=sums[1:])
        begin = starts[at:upto] - low
        out[at:upto] = (sums[ends[at:upto] - low] - sums[begin]) * inverse[begin]
        at = upto
    # Mixed, so that any bits of the result can serve as an index.
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def distinct_pairs(of: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, and how often each occurs."""
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(first)
    return of[at], h[at], np.diff(np.append(at, len(h)))


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices of ``values`` behind each other."""
    total = int(size.sum())
    if not total:
        return np.empty(0, values.dtype)
    shift = start - np.concatenate([[0], np.cumsum(size)[:-1]])
    return values[np.repeat(shift, size) + np.arange(total)]


class Slots:
    """Results for words seen before, one for each slot of a table of fixed size.

    A word's hash names its slot; a new word takes the slot over. ``look`` returns the
    slot of each word after ``fill`` has been asked for the words that were not there.
    Two words of one batch that share a slot are told apart by ``rows``: results of this
    batch's new words come from it, not from the table.
    """

    def __init__(self, bits: int, width: int, kind: type):
        self.shift = np.uint64(64 - bits)
        self.key = np.zeros(1 << bits, np.uint64)
        self.value = np.zeros((1 << bits, width), kind)

    def look(self, h: np.ndarray, fill) -> np.ndarray:
        """One row of values for each hash; ``fill(positions)`` gives the rows of new words."""
        slot = (h >> self.shift).astype(np.int64)
        out = self.value.take(slot, 0)
        new = np.flatnonzero((self.key.take(slot) != h) | (h == 0))
        if len(new):
            distinct, first, back = np.unique(h[new], return_index=True, return_inverse=True)
            rows = fill(new[first])
            out[new] = rows.take(back, 0)
            self.key[slot[new[first]]] = distinct
            self.value[slot[new[first]]] = rows
            # Where two new words share a slot, the key that is left decides whose row stays.
            left = self.key[slot[new[first]]] == distinct
            self.value[slot[new[first]][left]] = rows[left]
        return out
