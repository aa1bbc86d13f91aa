"""Texts bit by bit: hashed-context predictors, gated logistic mixing, refinement.

A text is a stream of bytes: its words (A-Z lower-cased) with a space behind each, and one
more space as its end. Every byte is predicted bit by bit, most significant first, from the
bytes before it, over the borders of words back to the begin of the text. Each predictor
knows some of these bytes, or also how far into its word a byte stands, and the bits of the
current byte so far; a hash of them names a slot with counts of zeros and ones. The
predictors' log odds are added up with weights that a gate chooses. There are two gates, so
two mixers: how long the longest context seen before is, and which byte stands before. A
table indexed by the byte before and the mixed odds refines the result of each. The four
resulting chances are mixed within each text with weights that follow how well each did so
far in that text; every block of bytes moves them.

The counts are sums over bytes of texts, so they may be gathered apart and added up
(:class:`BitCounts`). Weights and refinement are learnt online from bytes in small groups,
each byte predicted without its own occurrence, equal bytes at once; several mixers may learn
from a part each, and what they learnt is put together (:meth:`BitMixer.take`). The chances of a byte then depend on nothing
but the six bytes before it and its place in the word, which are one 64-bit number with the
byte itself, so they are remembered by that number in a table of fixed size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tripartite.llm.bytewords import FOLD, Slots, buffers, gather, words

# Bytes of context, whether the place in the word is known too, and log2 of the slots.
PREDICTORS = ((1, True, 17), (2, True, 20), (3, False, 20), (4, True, 22), (5, False, 22), (6, True, 22))
_SLOTS = np.cumsum([0, *[1 << bits for *_, bits in PREDICTORS]])  # where each predictor's begin
SLOTS = int(_SLOTS[-1])
REACH = 6
FAR = 15  # places in a word beyond this one are alike
GROUP = 2048  # bytes between two updates of the weights
RATE = 0.05
BUCKETS = 24  # of the refinement, for log odds from -8 to 8
PRIOR = 12.0  # weight of the mixed odds in the refinement's counts
BLOCK = 256  # bytes of a text between two updates of its own weights
SHARE = 0.02  # of a text's weights is dealt anew after each block
EXPERTS = 4  # two mixers, each with and without refinement
STRETCH = 1 << 17  # bytes looked at at once
NEW = 1 << 13  # bytes scored at once, so that the numbers stay in a core's cache
END = 0x20
BEFORE = 0x0A  # stands before each text; white space, so in no word

_K = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xD6E8FEB86659FD93)


def stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes behind each other, ``REACH`` bytes before each; where each begins
    (behind those) and how many bytes it has."""
    data, offsets = buffers(texts)
    starts, ends = words(data, offsets)
    last = np.searchsorted(starts, offsets[1:], "left")
    n = len(last)
    # The end of a text is an empty word.
    starts, ends = np.insert(starts, last, 0), np.insert(ends, last, 0)
    tokens = np.diff(np.concatenate([[0], last])) + 1
    first = np.zeros(len(starts), np.int64)
    first[np.cumsum(tokens)[:-1]] = REACH
    if n:
        first[0] = REACH
    size = ends - starts
    begin = np.cumsum(first + size + 1) - size - 1
    total = int((first + size + 1).sum())
    out = np.full(total, END, np.uint8)
    inside = np.ones(int(size.sum()), np.int64)
    inside[:] = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(inside))
    out[inside] = FOLD[gather(data, starts, size)]
    head = np.cumsum(tokens) - tokens
    text_begin = begin[head] if n else np.zeros(0, np.int64)
    for k in range(1, REACH + 1):
        out[text_begin - k] = BEFORE
    return out, text_begin, np.diff(np.append(text_begin, total + REACH)) - REACH


def keys(data: np.ndarray, low: int, high: int) -> np.ndarray:
    """One number for each byte in [low, high): itself, the six before, its place in the word."""
    back = max(0, low - FAR - 1)
    part = data[back:high]
    at = np.arange(len(part))
    between = np.maximum.accumulate(np.where((part == END) | (part == BEFORE), at, -FAR - 1))
    place = np.empty(len(part), np.int64)
    place[0] = FAR
    place[1:] = at[1:] - between[:-1] - 1
    out = np.minimum(place, FAR).astype(np.uint64) << np.uint64(56)
    wide = part.astype(np.uint64)
    for k in range(REACH + 1):
        out[k:] |= wide[: len(wide) - k] << np.uint64(8 * k)
    return out[low - back :]


def _contexts(key: np.ndarray) -> np.ndarray:
    """Hashes of what each predictor knows of the bytes before, one row a predictor."""
    out = np.empty((len(PREDICTORS), len(key)), np.uint64)
    before = key >> np.uint64(8)
    place = (key >> np.uint64(56)) << np.uint64(48)
    for row, (size, placed, _) in enumerate(PREDICTORS):
        h = before & np.uint64((1 << 8 * size) - 1)
        h = ((h | place) if placed else h) * _K
        h ^= h >> np.uint64(31)
        out[row] = (h + np.uint64(row + 1)) * _M
    return out


def _slots(contexts: np.ndarray, data: np.ndarray, half: int) -> np.ndarray:
    """For the high (0) or low (1) four bits of a byte, what their nodes' numbers turn into
    slots by exclusive or; the slots of four bits so lie in one line of memory."""
    h = contexts ^ ((data >> 4).astype(np.uint64) + np.uint64(1)) * _M if half else contexts
    h = h * _K
    for k, (*_, bits) in enumerate(PREDICTORS):
        h[k] >>= np.uint64(64 - bits)
        h[k] += np.uint64(_SLOTS[k])
    return h.astype(np.int64)


def _nodes(contexts: np.ndarray, data: np.ndarray):
    """For each bit of the bytes its number, its truth and its slots, one row a predictor."""
    for bit in range(8):
        if bit % 4 == 0:
            line = _slots(contexts, data, bit // 4)
            node = np.ones(len(data), np.int64)
        truth = (data >> (7 - bit)) & 1
        yield bit, truth, line ^ node
        node = node * 2 + truth


def _squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def text_bytes(data: np.ndarray, begin: np.ndarray, size: np.ndarray):
    """Keys of the texts' own bytes, a stretch at a time, and the text of each."""
    for low in range(0, len(data), STRETCH):
        high = min(len(data), low + STRETCH)
        first = max(0, int(np.searchsorted(begin, low, "right")) - 1)
        at = np.arange(low, high)
        text = first + np.searchsorted(begin[first : first + high - low + 2], at, "right") - 1
        place = at - begin[text]
        own = (place >= 0) & (place < size[text])
        yield keys(data, low, high)[own], text[own], place[own]


class BitCounts:
    """Zeros and ones that follow in each slot, summed over bytes."""

    def __init__(self) -> None:
        self.bits = np.zeros(2 * SLOTS)  # of each slot: zeros, ones

    def add(self, key: np.ndarray, times: np.ndarray) -> None:
        for low in range(0, len(key), STRETCH):
            part, n = key[low : low + STRETCH], times[low : low + STRETCH].astype(float)
            contexts = _contexts(part)
            data = (part & np.uint64(255)).astype(np.int64)
            for _, truth, slots in _nodes(contexts, data):
                for at in slots * 2 + truth:
                    np.add.at(self.bits, at, n)


class BitMixer:
    def __init__(self, bits: np.ndarray | None = None) -> None:
        n = len(PREDICTORS)
        self.bits = np.zeros(2 * SLOTS, np.float32) if bits is None else bits  # of each slot: zeros, ones
        self.odds: np.ndarray | None = None  # fixed once learning has ended
        self.weights = [np.full(((n + 1) * 8, n), 0.35), np.full((256 * 8, n), 0.35)]
        centre = _squash((np.arange(BUCKETS) + 0.5) / BUCKETS * 16 - 8)
        self.fine_ones = [np.tile(PRIOR * centre, (256, 1)) for _ in self.weights]
        self.fine_all = [np.full((256, BUCKETS), PRIOR) for _ in self.weights]
        self.met = [np.zeros(len(w)) for w in self.weights]  # bits that each gate has learnt from
        self._start = [x.copy() for x in (*self.fine_ones, *self.fine_all)]

    def learnt(self) -> list[np.ndarray]:
        """What :meth:`learn` has found, in a form that is added up over mixers."""
        weighed = [w * met[:, None] for w, met in zip(self.weights, self.met, strict=True)]
        fine = [x - start for x, start in zip((*self.fine_ones, *self.fine_all), self._start, strict=True)]
        return [*weighed, *self.met, *fine]

    def take(self, learnt: list[np.ndarray]) -> None:
        """Sums of :meth:`learnt` over mixers that began as this one: refinements are added
        up, each gate's weights are the mean by the bits that it has learnt from."""
        n = len(self.weights)
        for own, weighed, met in zip(self.weights, learnt[:n], learnt[n : 2 * n], strict=True):
            own[met > 0] = weighed[met > 0] / met[met > 0, None]
        for own, start, more in zip((*self.fine_ones, *self.fine_all), self._start, learnt[2 * n :], strict=True):
            own[:] = start + more
        self.met = list(learnt[n : 2 * n])

    def _inputs(self, slots: np.ndarray, truth: np.ndarray) -> np.ndarray:
        """Log odds of a one; while learning, without the one occurrence of ``truth``."""
        if self.odds is not None:
            return self.odds.take(slots).astype(np.float32)
        zeros = np.maximum(self.bits[2 * slots] - (1 - truth), 0)
        ones = np.maximum(self.bits[2 * slots + 1] - truth, 0)
        return np.log((ones + 0.4) / (zeros + 0.4))

    def _gates(self, x: np.ndarray, previous: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
        level = np.zeros(x.shape[1], np.int64)
        for k in range(len(PREDICTORS)):
            np.putmask(level, x[k] != 0, k + 1)
        return level * 8 + bit, previous * 8 + bit

    def _mix(self, x: np.ndarray, weights: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("nk,kn->n", weights.take(gate, 0), x), -8 + 1e-5, 8 - 1e-5)

    def _bits(self, key: np.ndarray):
        """For each bit: its truth, the predictors' odds, and of each mixer the gate, the
        mixed odds and the cell of the refinement."""
        contexts = _contexts(key)
        data = (key & np.uint64(255)).astype(np.int64)
        previous = ((key >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
        for bit, truth, slots in _nodes(contexts, data):
            x = self._inputs(slots, truth)
            found = []
            for weights, gate in zip(self.weights, self._gates(x, previous, bit), strict=True):
                mixed = self._mix(x, weights, gate)
                found.append((gate, mixed, previous * BUCKETS + ((mixed + 8) * (BUCKETS / 16)).astype(np.int64)))
            yield truth, x, found

    def learn(self, key: np.ndarray, times: np.ndarray | None = None) -> None:
        """One online pass over bytes that the counts hold, by their keys; each stands for
        ``times`` equal ones."""
        for at in range(0, len(key), GROUP):
            part = key[at : at + GROUP]
            n = np.ones(len(part)) if times is None else times[at : at + GROUP].astype(float)
            for truth, x, found in self._bits(part):
                for m, (gate, mixed, cell) in enumerate(found):
                    weights = self.weights[m]
                    error = (truth - _squash(mixed)) * n
                    met = np.bincount(gate, n, len(weights))
                    self.met[m] += met
                    count = np.maximum(met, 1)
                    for k in range(len(PREDICTORS)):
                        weights[:, k] += RATE * np.bincount(gate, error * x[k], len(weights)) / count
                    ones, every = self.fine_ones[m], self.fine_all[m]
                    ones += np.bincount(cell, truth * n, ones.size).reshape(ones.shape)
                    every += np.bincount(cell, n, every.size).reshape(every.shape)

    def end_learning(self) -> None:
        self.odds = np.log((self.bits[1::2] + 0.4) / (self.bits[::2] + 0.4)).astype(np.float16)
        self.bits = self.bits[:0]
        self._start = []
        self.weights = [w.astype(np.float32) for w in self.weights]
        both = zip(self.fine_ones, self.fine_all, strict=True)
        self.fine = [(ones / every).ravel().astype(np.float32) for ones, every in both]

    def log_chances(self, key: np.ndarray) -> np.ndarray:
        """Natural log of the chance of each byte, one column an expert."""
        out = np.ones((EXPERTS, len(key)))
        for low in range(0, len(key), NEW):
            part = out[:, low : low + NEW]
            for truth, _, found in self._bits(key[low : low + NEW]):
                one = truth == 1
                for m, (_, mixed, cell) in enumerate(found):
                    plain = _squash(np.where(one, mixed, -mixed))
                    fine = self.fine[m].take(cell)
                    part[2 * m] *= plain
                    part[2 * m + 1] *= 0.5 * plain + 0.5 * np.where(one, fine, 1 - fine)
        return np.log(out).T


class TextScorer:
    """Scores whole texts with a learnt mixer; remembers chances of bytes."""

    def __init__(self, mixer: BitMixer, slot_bits: int = 22):
        self.mixer, self.known = mixer, Slots(slot_bits, EXPERTS, np.float32)

    def _chances(self, key: np.ndarray) -> np.ndarray:
        # One to one, so that equal hashes are equal keys.
        h = key * _K
        h ^= h >> np.uint64(32)
        h *= _M
        return self.known.look(h, lambda new: self.mixer.log_chances(key[new]).astype(np.float32))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the chance of each text, and its bytes with spaces and end."""
        data, begin, size = stream(texts)
        blocks = -(-size // BLOCK)
        first = np.cumsum(blocks) - blocks
        sums = np.zeros((int(blocks.sum()), EXPERTS))
        for key, text, place in text_bytes(data, begin, size):
            if len(key):
                block = first[text] + place // BLOCK
                cut = np.flatnonzero(np.diff(block, prepend=-1))
                sums[block[cut]] += np.add.reduceat(self._chances(key), cut, axis=0, dtype=np.float64)
        return self._within(sums, first, blocks) / np.log(10), size

    @staticmethod
    def _within(sums: np.ndarray, first: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The chances of each text's blocks in turn, under weights that each block moves."""
        total = np.zeros(len(first))
        weight = np.full((len(first), EXPERTS), 1 / EXPERTS)
        longest_first = np.argsort(-blocks, kind="stable")
        left = len(first)
        for turn in range(int(blocks.max(initial=0))):
            while blocks[longest_first[left - 1]] <= turn:
                left -= 1
            of = longest_first[:left]
            each = np.log(weight[of]) + sums[first[of] + turn]
            top = each.max(axis=1, keepdims=True)
            each = np.exp(each - top)
            whole = each.sum(axis=1, keepdims=True)
            total[of] += (np.log(whole) + top)[:, 0]
            weight[of] = (1 - SHARE) * each / whole + SHARE / EXPERTS
        return total


_scorers: dict[str, TextScorer] = {}


def remembered(name: str, mixer: BitMixer) -> TextScorer:
    """This process's scorer of the model called ``name``: a worker that runs several tasks
    keeps what it knows of bytes. Only the last model's is kept."""
    if name not in _scorers:
        forget()
        _scorers[name] = TextScorer(mixer)
    return _scorers[name]


def forget() -> None:
    """Give back the memory of :func:`remembered`."""
    _scorers.clear()
