import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import awkward, empty

from tripartite.llm import packing
from tripartite.llm.bpe import byte_bpe


def sums(counts, room):
    """All sums up to room, by brute force."""
    reached = {0}
    for length, n in counts.items():
        for _ in range(n):
            reached |= {s + length for s in reached if s + length <= room}
    return reached


@pytest.mark.parametrize("seed", range(20))
def test_closest_multiset(seed):
    rng = np.random.default_rng(seed)
    counts = Counter(rng.integers(1, 60, 12).tolist())
    room = int(rng.integers(1, 150))
    chosen = packing.closest_multiset(dict(counts), room)
    assert all(n <= counts[c] for c, n in chosen.items())
    assert sum(c * n for c, n in chosen.items()) == max(sums(counts, room))


@pytest.mark.parametrize("window,n,seed", [(16, 0, 0), (16, 1, 1), (16, 500, 2), (64, 300, 3), (2048, 4000, 4)])
def test_plan_places_every_id_once(window, n, seed):
    rng = np.random.default_rng(seed)
    counts = dict(Counter(rng.integers(1, window + 1, n).tolist()))
    rows = packing.plan(counts, window)
    taken, used = defaultdict(list), defaultdict(list)
    for length, low, high, skip, size, sequence, offset in rows.tolist():
        for k in range(low, high):
            taken[length, k].append((skip, size))
            used[sequence + k - low].append((offset, size))
    assert set(taken) == {(c, k) for c, m in counts.items() for k in range(m)}
    for (length, _), parts in taken.items():
        at = 0
        for skip, size in sorted(parts):
            assert skip == at
            at += size
        assert at == length
    short = 0
    for parts in used.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= window
        short += at < window
    assert short <= 1 and sorted(used) == list(range(len(used)))


def test_round_trip_of_awkward_documents(spark):
    df = awkward(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = packing.pack(df, window=64).collect()
    ids = {r.doc_id: [*byte_bpe().encode_ordinary(r.text or ""), packing.END_ID] for r in df.collect()}
    back = defaultdict(list)
    for r in got:
        own = ids[r.key][r.start : r.start + r.length]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.key])
        back[r.key].append((r.start, r.length))
    for key, own in ids.items():
        assert sum(n for _, n in back[key]) == len(own) and sorted(back[key])[0][0] == 0
    whole = awkward(spark)
    assert sum(r.length for r in packing.pack(whole, window=64).collect()) == sum(
        len(byte_bpe().encode_ordinary(r.text or "")) + 1 for r in whole.collect()
    )


def test_empty_table(spark):
    assert packing.pack(empty(spark)).collect() == []
