"""Packing of tokenised documents into sequences by minimum bin slack.

A document is its ids and an end id. Whole windows are cut off its front; what remains is
shorter than a window and is packed with other remainders: the longest one left opens a
sequence, a subset-sum over bitsets finds the multiset of remaining lengths that comes
closest to the room behind it, and backtracking gives the count of each length in it. A
room that cannot be filled exactly takes the front of one more remainder, cut to size.

Only the number of remainders of each length matters to that, so the plan is made from a
histogram of at most ``window`` numbers, and one choice is applied to as many sequences as
the counts allow: its cost and size depend on the lengths, not on the documents. The
pieces are then numbered within their length, by each task and by sums over tasks, and
look up their sequence by number. Nothing else meets: documents are tokenised where they
are read, and no task or group holds more than its share.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripartite.llm.bitmaps import bitmap, has, slot
from tripartite.llm.bpe import encoder
from tripartite.llm.bytewords import gather
from tripartite.llm.common import batches, read, text_of
from tripartite.sources.scratch import write_through

WINDOW = 2048
END_ID = 1


# ---- the plan ------------------------------------------------------------------------


@dataclass
class Lot:
    """Remainders of one original length, numbered ``low`` to ``high``, from ``skip`` on."""

    length: int
    low: int
    high: int
    skip: int


class _Stock:
    """Lots by the length that is left of their pieces."""

    def __init__(self, counts: dict[int, int]):
        self.lots = defaultdict(deque)
        self.count: dict[int, int] = {}
        for length, n in counts.items():
            if n:
                self.put(length, Lot(length, 0, n, 0))

    def put(self, length: int, lot: Lot) -> None:
        self.lots[length].append(lot)
        self.count[length] = self.count.get(length, 0) + lot.high - lot.low

    def take(self, length: int, n: int) -> list[Lot]:
        taken = []
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
        while n:
            lot = self.lots[length][0]
            size = min(n, lot.high - lot.low)
            taken.append(Lot(lot.length, lot.low, lot.low + size, lot.skip))
            lot.low += size
            n -= size
            if lot.low == lot.high:
                self.lots[length].popleft()
        return taken


def closest_multiset(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length come closest to ``room`` without passing it.

    Bit s of a set says that the sum s can be reached; a length enters in groups of 1, 2,
    4, ... pieces, and the sets before each group are kept to find the way back.
    """
    reached, wanted = 1, 1 << room
    below = (1 << (room + 1)) - 1
    groups: list[tuple[int, int, int]] = []
    for length in sorted((c for c in counts if c <= room), reverse=True):
        left, group = min(counts[length], room // length), 1
        while left and not reached & wanted:
            size = min(group, left)
            groups.append((length, size, reached))
            reached |= (reached << (length * size)) & below
            left -= size
            group *= 2
        if reached & wanted:
            break
    total = reached.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, size, before in reversed(groups):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + size
            total -= length * size
    return chosen


def plan(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Rows (length, low, high, skip, size, sequence, offset).

    Of the pieces of ``length`` numbered from ``low`` up to ``high``, the ids from ``skip``
    on, ``size`` of them, go to ``offset`` of sequence ``sequence + number - low``.
    """
    stock = _Stock({c: n for c, n in counts.items() if c < window})
    rows: list[tuple[int, ...]] = []
    sequence = counts.get(window, 0)
    if sequence:
        rows.append((window, 0, sequence, 0, window, 0, 0))

    def place(lots: list[Lot], size: int, offset: int) -> None:
        at = sequence
        for lot in lots:
            rows.append((lot.length, lot.low, lot.high, lot.skip, size, at, offset))
            at += lot.high - lot.low

    while stock.count:
        longest = max(stock.count)
        left = {**stock.count, longest: stock.count[longest] - 1}
        chosen = closest_multiset({c: n for c, n in left.items() if n}, window - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        slack = window - sum(c * n for c, n in chosen.items())
        times = min(stock.count[c] // n for c, n in chosen.items())
        donor = None
        if slack:
            spare = {c: n - chosen.get(c, 0) for c, n in stock.count.items()}
            donor = max((c for c, n in spare.items() if n > 0), default=None)
        if donor is not None:
            used = chosen.get(donor, 0)
            times = max(1, min(times, stock.count[donor] // (used + 1)))
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            for _ in range(n):
                place(stock.take(length, times), length, offset)
                offset += length
        if donor is not None:
            lots = stock.take(donor, times)
            place(lots, slack, offset)
            for lot in lots:
                stock.put(donor - slack, Lot(lot.length, lot.low, lot.high, lot.skip + slack))
        sequence += times
    return np.array(rows, np.int64).reshape(len(rows), 7)


class Lookup:
    """The plan's rows for a piece of some length and number."""

    def __init__(self, rows: np.ndarray):
        edges: dict[int, set[int]] = defaultdict(set)
        for length, low, high in rows[:, :3].tolist():
            edges[length].update((low, high))
        self.length, self.low, self.first, owned = [], [], [0], []
        by_length: dict[int, list[int]] = defaultdict(list)
        for k, length in enumerate(rows[:, 0].tolist()):
            by_length[length].append(k)
        for length in sorted(edges):
            cuts = np.array(sorted(edges[length]))
            own = np.array(by_length[length])
            start = np.searchsorted(cuts, rows[own, 1])
            size = np.searchsorted(cuts, rows[own, 2]) - start
            # One entry for each row and stretch between two cuts that it spans.
            stretch = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            which = np.repeat(own, size)
            order = np.lexsort((rows[which, 3], stretch))
            owned.append(which[order])
            n = np.bincount(stretch, minlength=len(cuts))
            self.length += [length] * len(cuts)
            self.low += cuts.tolist()
            self.first += (self.first[-1] + np.cumsum(n)).tolist()
        self.length, self.low, self.first = (np.array(x, np.int64) for x in (self.length, self.low, self.first))
        self.rows = rows[np.concatenate(owned)] if owned else rows
        self.begin = {c: int(np.searchsorted(self.length, c)) for c in edges}
        self.end = {c: int(np.searchsorted(self.length, c, "right")) for c in edges}

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every piece its plan rows: which piece, and (skip, size, sequence, offset)."""
        stretch = np.empty(len(length), np.int64)
        for c in np.unique(length).tolist():
            of = length == c
            low, high = self.begin[c], self.end[c]
            stretch[of] = low + np.searchsorted(self.low[low:high], number[of], "right") - 1
        n = self.first[stretch + 1] - self.first[stretch]
        rows = gather(np.arange(len(self.rows)), self.first[stretch], n)
        piece = np.repeat(np.arange(len(length)), n)
        found = self.rows[rows]
        return piece, np.stack(
            [found[:, 3], found[:, 4], found[:, 5] + number[piece] - found[:, 1], found[:, 6]], axis=1
        )


# ---- the work on documents --------------------------------------------------------------

_PIECES = "start long, length long, doc_tokens long, ids binary, ids_crc32 long, part long, number long"


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut(docs: DataFrame, key: str, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Pieces of every document: whole windows, then what remains. ``ids`` are unsigned,
    16 bits, little-endian. A piece is numbered within its length and task."""
    source = docs.select(F.col(f"`{key}`").alias("key"), text_of(text).alias("text"))
    batches(docs.sparkSession)

    def run(parts):
        encode = encoder()
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in parts:
            ids, bounds = encode(batch.column(1))
            tokens = np.diff(bounds) + 1
            n = -(-tokens // window)
            doc = np.repeat(np.arange(len(tokens)), n)
            start = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * window
            length = np.minimum(window, tokens[doc] - start)
            own = []
            for d, s, size in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True):
                piece = ids[bounds[d] + s : min(bounds[d] + s + size, bounds[d + 1])]
                own.append(piece if len(piece) == size else np.append(piece, np.uint16(END_ID)))
            number = np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            run_length, run_start, run_size = np.unique(length[order], return_index=True, return_counts=True)
            number[order] = np.arange(len(order)) + np.repeat(seen[run_length] - run_start, run_size)
            seen[run_length] += run_size
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc)),
                    *map(pa.array, (start, length, tokens[doc])),
                    pa.array([p.astype("<u2").tobytes() for p in own], pa.binary()),
                    pa.array([_crc(p) for p in own], pa.int64()),
                    pa.array(np.full(len(doc), part)),
                    pa.array(number),
                ],
                names=["key", "start", "length", "doc_tokens", "ids", "ids_crc32", "part", "number"],
            )

    schema = f"key {dict(source.dtypes)['key']}, {_PIECES}"
    return source.mapInArrow(run, schema)


def pack(docs: DataFrame, key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Pieces: key, start, length, doc_tokens, sequence_id, offset, ids_crc32.

    Null text counts as empty: one end id. Rows may repeat, each is packed by itself; a
    null key stays null. An empty table gives an empty one; other columns are not read.
    """
    pieces = write_through(cut(docs, key, window=window), "pieces")
    return _packed(pieces, window)


def _packed(pieces: DataFrame, window: int) -> DataFrame:
    spark = pieces.sparkSession
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), "n")
    starts = write_through(starts, "piece_numbers")
    counts = {r[0]: r[1] for r in starts.groupBy("length").agg(F.sum("n")).collect()}  # one row a length
    lookup = spark.sparkContext.broadcast(Lookup(plan(counts, window)))

    narrow = pieces.drop("ids").join(starts.drop("n"), ["length", "part"])
    narrow = narrow.select(
        "key", "start", "length", "doc_tokens", "ids_crc32", "part", "number", (F.col("base") + F.col("number")).alias("overall")
    )

    def assign(parts):
        find = lookup.value
        for batch in parts:
            column = dict(zip(batch.schema.names, batch.columns, strict=True))
            piece, slots = find(column["length"].to_numpy(), column["overall"].to_numpy())
            kept = [c.take(pa.array(piece)) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*kept, *[pa.array(slots[:, k]) for k in range(4)]],
                names=[*batch.schema.names[:-1], "skip", "size", "sequence_id", "offset"],
            )

    given = "skip long, size long, sequence_id long, offset long"
    schema = f"{', '.join(f'{c} {t}' for c, t in narrow.dtypes[:-1])}, {given}"
    placed = write_through(narrow.mapInArrow(assign, schema), "placed")

    final = [
        "key",
        (F.col("start") + F.col("skip")).alias("start"),
        F.col("size").alias("length"),
        "doc_tokens",
        "sequence_id",
        "offset",
    ]
    whole = placed.where("size = length").select(*final, "ids_crc32")
    # Only pieces that were cut need their ids again; a bitmap keeps the others where they are.
    part = placed.where("size < length").drop("ids_crc32")
    ids = _of_cut(pieces.select("length", "part", "number", "ids"), part)
    part = ids.join(part, ["length", "part", "number"]).withColumn(
        "ids", F.expr("substring(ids, int(2 * skip + 1), int(2 * size))")
    )
    part = part.select(*final, _crc_of_ids().alias("ids_crc32"))
    return whole.unionByName(part)


def _of_cut(ids: DataFrame, cut_up: DataFrame) -> DataFrame:
    keys = ["length", "part", "number"]
    shared = ids.sparkSession.sparkContext.broadcast(bitmap(cut_up, *keys))

    def run(parts):
        for batch in parts:
            yield batch.select(batch.schema.names[:-1]).filter(
                pa.array(has(shared.value, batch.column(batch.num_columns - 1).to_numpy()))
            )

    return ids.withColumn("slot", slot(*keys)).mapInArrow(run, ids.schema)


def _crc_of_ids():
    """crc32 of 16-bit ids widened to 32 bits: two zero bytes behind every two bytes."""
    return F.crc32(F.unhex(F.regexp_replace(F.hex("ids"), "(.{4})", "$10000")))


def op8_packing(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select("doc_id", "text")
    return pack(docs, "doc_id").withColumnRenamed("key", "doc_id")
