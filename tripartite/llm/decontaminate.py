"""Benchmark decontamination by Wu-Manber search for many strings, over words.

The strings are windows of 13 consecutive item words (a shorter item is one window); the
alphabet is the words themselves, so an occurrence never begins or ends inside a word.
For windows of m words a table gives, for every block of two words, how far a search may
move on before any window can end there; most of a text is skipped. Where the shift is
zero, the bucket of the block's hash lists the windows that end with it, and those are
compared with the text word by word.

The strings are a stated query set. They are read in blocks of bounded size, so what is
broadcast does not grow with the benchmark; each block searches all documents, and what
it finds is added to what the blocks before it found.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tripartite.llm.common import append, map_batches, packed, read, text_of, unpacked
from tripartite.sources.scratch import write_through

WINDOW = 13
BLOCK_WORDS = 500_000  # item words in one broadcast: its tables stay below about 100 MB
_LANE = 64  # windows that one search lane starts with

# Bytes outside words, and the case of ASCII letters. Bytes of other
# characters belong to words.
_BETWEEN = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_NORMAL = bytes.maketrans(
    bytes([*range(65, 91), *_BETWEEN]), bytes([*range(97, 123), *[0x20] * len(_BETWEEN)])
)

SPANS = "array<struct<start:int,end:int>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class _Length:
    """Shift table, buckets and windows of one length."""

    def __init__(self, windows: dict[tuple[int, ...], set[int]], m: int):
        self.m, self.block = m, min(2, m)
        self.patterns = np.array(list(windows), np.int32).reshape(len(windows), m)
        owners = [sorted(items) for items in windows.values()]
        self.owner_start = np.cumsum([0, *map(len, owners)])
        self.owner = np.fromiter(chain.from_iterable(owners), np.int64)
        bits = max(10, int(len(windows) * m * 4).bit_length())
        self.down = np.uint32(32 - min(bits, 26))
        self.shift = np.full(1 << (32 - int(self.down)), m - self.block + 1, np.int32)
        for end in range(self.block, m + 1):
            at = self.hash(self.patterns[:, end - self.block : end])
            np.minimum.at(self.shift, at, m - end)
        last = self.hash(self.patterns[:, m - self.block :])
        self.listed = np.argsort(last, kind="stable")
        ordered = last[self.listed]
        self.keys, self.first = np.unique(ordered, return_index=True)
        self.size = np.diff([*self.first, len(ordered)])

    def hash(self, block: np.ndarray) -> np.ndarray:
        a = block[..., 0].astype(np.uint32) * np.uint32(0x9E3779B1)
        if self.block == 2:
            a ^= (block[..., 1].astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA77)
        return (a * np.uint32(0xC2B2AE3D)) >> self.down

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every (start, pattern) at which a window occurs in ``text``."""
        starts = len(text) - self.m + 1
        if starts <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.arange(0, starts, _LANE)
        end = np.minimum(at + _LANE, starts)
        candidates, hashes = [], []
        while at.size:  # all lanes move on together, each by its own shift
            tail = at + self.m
            h = self.hash(np.stack([text[tail - k] for k in range(self.block, 0, -1)], -1))
            shift = self.shift[h]
            stop = shift == 0
            candidates.append(at[stop])
            hashes.append(h[stop])
            at = at + np.maximum(shift, 1)
            going = at < end
            at, end = at[going], end[going]
        return self.confirm(text, np.concatenate(candidates), np.concatenate(hashes))

    def confirm(self, text: np.ndarray, at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Direct comparison with each window of the bucket, word by word from the front."""
        bucket = np.searchsorted(self.keys, h)
        n = self.size[bucket]
        which = np.repeat(self.first[bucket] - np.cumsum(n) + n, n) + np.arange(n.sum())
        at, pattern = np.repeat(at, n), self.listed[which]
        for k in range(self.m):
            same = text[at + k] == self.patterns[pattern, k]
            at, pattern = at[same], pattern[same]
        return at, pattern


class WuManber:
    """Windows of some items; ids of words that occur in none are 0 and match nothing."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        windows: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for number, (_, text) in enumerate(items):
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text))
            m = min(window, len(ids))
            for i in range(len(ids) - m + 1 if m else 0):
                windows.setdefault(m, {}).setdefault(ids[i : i + m], set()).add(number)
        self.lengths = [_Length(found, m) for m, found in sorted(windows.items())]

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, dict[int, tuple[list[tuple[int, int]], set[str]]]]:
        """Word counts, and for each text with a hit its spans of hit words and its items."""
        words = [words_of(t) for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        # A 0 behind each text keeps windows from reaching into the next one.
        begin = np.concatenate([[0], np.cumsum(counts + 1)])
        text = np.zeros(begin[-1], np.int32)
        mask = np.ones(begin[-1], bool)
        mask[begin[1:] - 1] = False
        ids = map(self.vocabulary.get, chain.from_iterable(words), repeat(0))
        text[mask] = np.fromiter(ids, np.int32, counts.sum())
        found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        for length in self.lengths:
            at, pattern = length.find(text)
            doc = np.searchsorted(begin, at, "right") - 1
            for d, start, p in zip(doc.tolist(), (at - begin[doc]).tolist(), pattern.tolist(), strict=True):
                spans, items = found.setdefault(d, ([], set()))
                spans.append((start, start + length.m))
                own = length.owner[length.owner_start[p] : length.owner_start[p + 1]]
                items.update(self.items[k] for k in own.tolist())
        return counts, found


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def item_blocks(items: DataFrame, item: str, text: str, most: int = BLOCK_WORDS) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about ``most`` words; one partition at a time is fetched."""
    block: list[tuple[str, bytes]] = []
    words = 0
    rows = items.select(F.col(item).cast("string"), F.encode(text_of(text), "UTF-8"))
    for name, body in rows.toLocalIterator():
        size = len(words_of(bytes(body)))
        if size and block and words + size > most:
            yield block
            block, words = [], 0
        if size:
            block.append((name or "", bytes(body)))
            words += size
    yield block


def _search(found: DataFrame, matcher: WuManber) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast(matcher)

    def each():
        matcher = shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            counts, hits = matcher.scan(column["bytes"].to_pylist())
            spans, items = column["spans"].to_pylist(), column["items"].to_pylist()
            for d, (new_spans, new_items) in hits.items():
                spans[d] = _merged([(s["start"], s["end"]) for s in spans[d]] + new_spans)
                items[d] = sorted({*items[d], *new_items})
            return append(
                batch,
                ["row", "bytes"],
                n_words=pa.array(counts, pa.int64()),
                spans=pa.array(spans, column["spans"].type),
                items=pa.array(items, column["items"].type),
            )

        return work

    return map_batches(found, each, found.schema)


def mark(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Each row as a struct ``row`` with ``n_words``, ``spans`` of hit words and ``items``.

    A text of null has no words and no hits; an item of null or without words is no
    window. A null item id is listed as empty text. Items may repeat. An empty table of
    documents gives an empty one, an empty benchmark no hits; columns of any name may be
    there.
    """
    found = packed(
        docs,
        F.encode(text_of(text), "UTF-8").alias("bytes"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for number, block in enumerate(item_blocks(items, item, item_text)):
        # Between two blocks the state is written, so that one search at a time is in memory.
        found = _search(found if number == 0 else write_through(found, "searched"), WuManber(block))
    return found.drop("bytes")


def n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


def contaminated() -> Column:
    """A twentieth of the words or more lie in windows of the benchmark."""
    return (n_hit() > 0) & (n_hit() * 20 >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    return unpacked(mark(docs, items).where(~contaminated()), docs)


def op7_decontamination(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select("doc_id", "text")
    return mark(docs, read(spark, root, "benchmark")).select(
        "row.doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE = f"""
with docs as (select row_number() over () as r, doc_id, {_SQL_WORDS} as w from documents),
items as (select item_id, {_SQL_WORDS} as w from benchmark),
wanted as (
  select distinct item_id, least({WINDOW}, len(w)) as m,
         array_to_string(w[i : i + least({WINDOW}, len(w)) - 1], ' ') as words
  from (select *, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) as i from items where len(w) > 0)
),
there as (
  select r, i, m, array_to_string(w[i : i + m - 1], ' ') as words
  from (select r, w, m, unnest(range(1, len(w) - m + 2)) as i
        from docs, (select distinct m from wanted) where len(w) >= m)
),
hits as (select r, i, m, item_id from there join wanted using (m, words)),
hit_words as (
  select r, count(distinct p) as n_hit
  from (select r, unnest(range(i, i + m)) as p from (select distinct r, i, m from hits)) group by r
),
hit_items as (
  select r, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct r, cast(item_id as varchar) as id from hits) group by r
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join hit_words using (r) left join hit_items using (r)
"""
