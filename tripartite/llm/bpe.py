"""Ids of the public byte-level vocabulary, in bulk.

The vocabulary's pattern never joins what stands before and after a space between two
other characters, so a text's ids are those of its space-separated chunks, one after the
other. Chunks repeat, and their ids are remembered in each Python worker, in a table of
fixed size. Where a space meets other white space the chunks do depend on each other; such a
text is encoded as a whole. Added tokens have no space, so each lies within one chunk.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken

from tripartite.llm.bytewords import WHITE, Slots, buffers, gather, hashes, words

VOCABULARY = "byte_bpe_50k.tiktoken"  # the ids of byte_bpe_50k.json; see the test of equality
ADDED = {"<|endoftext|>": 50256}  # tokens that byte_bpe_50k.json adds: one id wherever they stand
SLOT_BITS = 20  # a million remembered chunks, 28 MB in a worker
MOST_IDS = 8
MOST_HEAD = 256

SPACE = np.zeros(256, bool)
SPACE[0x20] = True


class ByteBPE(tiktoken.Encoding):
    """The ids that the tokenizers file gives without a template: texts are split at the
    added tokens, as ``add_special_tokens=False`` does not switch those off."""

    def encode_ordinary(self, text: str) -> list[int]:
        return self.encode(text, allowed_special="all")


@lru_cache(maxsize=4)
def byte_bpe(path: str | None = None) -> ByteBPE:
    """Encoder for a rank file and the added tokens."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return ByteBPE(
        path or VOCABULARY, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED
    )


class Encoder:
    """Encodes batches of texts; one for each worker, see :func:`encoder`."""

    def __init__(self, path: str | None = None):
        self.encoding = byte_bpe(path)
        n = self.encoding.n_vocab
        self.width = np.array([len(self.encoding.decode_single_token_bytes(i)) for i in range(n)])
        # Per slot: the number of ids and the ids. Longer chunks are encoded each time.
        self.known = Slots(SLOT_BITS, 1 + MOST_IDS, np.uint16)

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text.decode()), np.uint16)

    def _rows(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ids of chunks, each with the space before it; one call encodes them all."""
        size = ends - starts + 1
        ids = self.whole(gather(data, starts - 1, size).tobytes())
        # The tokens' bytes add up to the chunks' bytes, which gives back the chunks' ids.
        end = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(size), "left") + 1
        begin = np.concatenate([[0], end[:-1]])
        rows = np.zeros((len(starts), 1 + MOST_IDS), np.uint16)
        rows[:, 0] = np.minimum(end - begin, MOST_IDS + 1)
        for k in range(MOST_IDS):
            has = begin + k < end
            rows[has, 1 + k] = ids[begin[has] + k]
        return rows

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (unsigned 16 bits) and where each text's begin; one more for the end."""
        data, offsets = buffers(column)
        n = len(column)
        apart = ~_touching(data, offsets)
        begins, stops = words(data, offsets, SPACE)
        first = np.searchsorted(begins, offsets[:-1], "left")
        headed = np.zeros(len(begins), bool)  # chunks that no space stands before
        at_start = first[(first < len(begins)) & (offsets[:-1] < offsets[1:])]
        headed[at_start] = np.isin(begins[at_start], offsets[:-1])
        of = np.searchsorted(offsets, begins, "right") - 1
        chunk = ~headed & apart[of]
        begins, stops, of = begins[chunk], stops[chunk], of[chunk]
        h = hashes(data, begins, stops, fold=False)
        rows = self.known.look(h, lambda new: self._rows(data, begins[new], stops[new]))
        count = rows[:, 0].astype(np.int64)
        long = np.flatnonzero(count > MOST_IDS)
        used = np.arange(MOST_IDS) < count[:, None]
        used[long] = False
        flat = rows[:, 1:][used]
        texts: list[np.ndarray] = []
        if len(long):  # chunks of many ids are put in their places
            count[long] = 0
            at = np.cumsum(count)[long]
            own = [self.whole(b" " + data[begins[k] : stops[k]].tobytes()) for k in long.tolist()]
            cut = np.split(flat, at)
            flat = np.concatenate([x for pair in zip(cut, [*own, flat[:0]], strict=True) for x in pair])
            count[long] = [len(x) for x in own]
        ends = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(of, np.arange(n + 1), "left")]
        for d in range(n):
            low, high = offsets[d], offsets[d + 1]
            if not apart[d]:
                texts += [self.whole(data[low:high].tobytes()), flat[:0]]
                continue
            head = data[low:high][: MOST_HEAD]
            stop = np.flatnonzero(head == 0x20)[:1]
            if len(stop) == 0:
                stop = np.flatnonzero(data[low:high] == 0x20)[:1]
            body = data[low : low + stop[0]] if len(stop) else data[low:high]
            texts += [self.whole(body.tobytes()), flat[ends[d] : ends[d + 1]]]
        lengths = np.fromiter((len(a) + len(b) for a, b in zip(texts[::2], texts[1::2], strict=True)), np.int64, n)
        ids = np.concatenate(texts) if texts else np.empty(0, np.uint16)
        return ids, np.concatenate([[0], np.cumsum(lengths)])


def _touching(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts in which a space stands beside other white space or ends the text."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(n, bool)
    space, white = SPACE[data], WHITE[data] | ((data >= 0x1C) & (data <= 0x1F))
    bad = space & np.concatenate([white[1:], [False]])
    bad[1:] |= space[1:] & white[:-1]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    bad[last] |= space[last]
    # White space of other scripts: any text that has it is encoded as a whole.
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if len(lead):
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        a, b, c = data[lead], padded[lead + 1], padded[lead + 2]
        other = (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80)
        other |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        other |= (a == 0xE2) & (b == 0x81) & (c == 0x9F) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        bad[lead[other]] = True
    total = np.concatenate([[0], np.cumsum(bad)])
    return total[offsets[1:]] > total[offsets[:-1]]


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    return Encoder(path)
