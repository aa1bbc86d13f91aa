"""Word shingles of texts as sorted sets of 64-bit hashes, and bounds on how two sets differ."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from tripartite.llm.bytewords import buffers, hashes, words

WIDTH = 4
_K = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _M
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each text its distinct runs of :data:`WIDTH` words, ascending.

    Words stand between ASCII white space, A-Z lower-cased. A text of fewer words has one
    run, all of them; a text without words has none.
    """
    data, offsets = buffers(texts)
    starts, ends = words(data, offsets)
    h = hashes(data, starts, ends)
    at = np.searchsorted(starts, offsets, "left")
    run = np.empty(0, np.uint64)
    if len(h) >= WIDTH:
        n = len(h) - WIDTH + 1
        run = h[:n].copy()
        for k in range(1, WIDTH):
            run = run * _K + h[k : n + k]
        run = _mixed(run)
    out = []
    for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if high - low >= WIDTH:
            own = np.sort(run[low : high - WIDTH + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif high > low:
            whole = np.uint64(xxhash.xxh3_64_intdigest(h[low:high].tobytes(), high - low))
            out.append(np.array([whole], np.uint64))
        else:
            out.append(run[:0])
    return out


def fingerprint(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def parity(shingles: np.ndarray, least_bits: int = 256, most_bits: int = 1 << 16) -> bytes:
    """A bitmap of about four bits a shingle; each shingle flips one bit.

    Where two bitmaps of one length differ, the sets differ: the number of bits is at most
    the size of the symmetric difference. A longer bitmap folds to a shorter one by xor.
    """
    bits = min(most_bits, max(least_bits, 1 << int(4 * max(1, len(shingles)) - 1).bit_length()))
    slot = (shingles % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(slot, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketch(bitmap: bytes, words: int = 4) -> np.ndarray:
    """A bitmap of :func:`parity` folded to ``words`` 64-bit numbers; its bound holds for it too."""
    x = np.frombuffer(bitmap, np.int64)
    while len(x) > words:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound on the size of the symmetric difference."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())
