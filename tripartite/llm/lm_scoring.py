"""Log probabilities of whole texts by context mixing, and a unigram base beside them.

A text is its words (A-Z lower-cased) and one end, as a stream of bytes that the bit mixer
scores whole, over the borders of words (see ``bit_mixer``). What it learns:

* Counts of zeros and ones behind hashed contexts, of every byte of every training text.
  Tasks gather how often each byte stands behind its context, Spark deals these numbers out
  by the nearest bytes, and counts of equal slots are summed. The driver gets one table of
  fixed size.
* Gate weights and refinement, online in tasks, from the same numbers: every byte of every
  training text, predicted without its own occurrence, equal ones at once. What the tasks
  have learnt is put together by how much each learnt from.

Within a text the mixers' weights follow how well each has done in it so far.

The base needs the counts of all words in all training texts, which are gathered by Spark.
Texts get the numbers of the most frequent words from a table of fixed size, broadcast, and
those of all others by a join on the word's 64-bit hash; so frequent words are no hot keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripartite.llm.bit_mixer import SLOTS, BitCounts, BitMixer, forget, remembered, stream, text_bytes
from tripartite.llm.bytewords import buffers, distinct_pairs, hashes, slices, words
from tripartite.llm.common import batches, fold, most_frequent, read, text_of
from tripartite.sources.scratch import write_through

FREQUENT = 1 << 17  # words whose numbers are broadcast
LEARNT = 1 << 21  # distinct numbers of bytes that a task learns gates and refinement from, on average
PIECE = 1 << 16  # distinct numbers of bytes that are kept in one row
HELD = 1 << 22  # distinct numbers of bytes that a task gathers before it sends them
BUCKETS = 2048  # by the nearest bytes
SEGMENT = 1 << 15  # counts that travel in one row


def _hashed(texts: pa.Array) -> tuple[np.ndarray, ...]:
    data, offsets = buffers(texts)
    starts, ends = words(data, offsets)
    return data, offsets, starts, ends, hashes(data, starts, ends)


def _word_counts(docs: DataFrame) -> DataFrame:
    """(h, c): every distinct word of the texts and how often it occurs."""

    def run(parts):
        for batch in parts:
            distinct, times = np.unique(_hashed(batch.column(0))[-1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(times)], names=["h", "c"])

    return docs.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, n = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n[order], first)


class _Held:
    """Numbers of bytes and how often they occur, equal ones merged when they get many."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, key: np.ndarray, n: np.ndarray) -> bool:
        """Whether what is held should be taken now."""
        self.parts.append((key, n))
        self.size += len(key)
        if self.size > HELD:
            self.parts = [_merged(self.parts)]
            self.size = len(self.parts[0][0])
            return self.size > HELD // 4 * 3
        return False

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out, self.parts, self.size = _merged(self.parts), [], 0
        return out


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    at = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(at), pa.py_buffer(values)])


def _byte_counts(docs: DataFrame) -> DataFrame:
    """(size, key, n): the numbers of all bytes of all texts and how often each occurs, many
    in a row, written. Equal ones are merged, up to what a task can hold."""

    def sent(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        near = ((key >> np.uint64(8)) & np.uint64(0xFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
        bucket = (near >> np.uint64(40)).astype(np.int64) % BUCKETS
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        columns = [pa.array(np.arange(BUCKETS, dtype=np.int32)), _packed(key[order], cuts), _packed(n[order], cuts)]
        whole = pa.RecordBatch.from_arrays(columns, names=["bucket", "key", "n"])
        for low in range(0, BUCKETS, 256):
            yield whole.slice(low, 256)

    def gathered(parts):
        forget()
        held = _Held()
        for batch in parts:
            for _, texts in slices(batch.column(0), 4 << 20):
                for key, *_ in text_bytes(*stream(texts)):
                    if len(key) and held.add(*np.unique(key, return_counts=True)):
                        yield from sent(*held.take())
        if held.size:
            yield from sent(*held.take())

    def pieces(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        # Each from all over the numbers, so that a row is a fair share of what there is.
        step = -(-len(key) // PIECE)
        for k in range(step):
            part = [[len(key[k::step])], [key[k::step].tobytes()], [n[k::step].astype(np.int64).tobytes()]]
            kinds = [pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(part, kinds, strict=True)], names=["size", "key", "n"]
            )

    def merged(parts):
        held = _Held()
        for batch in parts:
            key, n = _unpacked(*batch.columns)
            if len(key) and held.add(key, n):
                yield from pieces(*held.take())
        if held.size:
            yield from pieces(*held.take())

    # Equal bytes before go to one task, so that few tasks hold counts of one slot.
    dealt = docs.mapInArrow(gathered, "bucket int, key binary, n binary").repartition("bucket")
    return write_through(dealt.select("key", "n").mapInArrow(merged, "size long, key binary, n binary"), "byte_counts")


def _unpacked(key: pa.Array, n: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(buffers(key)[0].tobytes(), np.uint64), np.frombuffer(buffers(n)[0].tobytes(), np.int64)


def _bit_counts(docs: DataFrame) -> np.ndarray:
    """Counts of zeros and ones in each slot over all bytes of all texts."""
    return _slot_counts(_byte_counts(docs))


def _slot_counts(counted: DataFrame) -> np.ndarray:
    """Counts of zeros and ones in each slot of :func:`_byte_counts`, summed by Spark.

    The driver gets one table of fixed size, whatever the corpus.
    """

    def summed(parts):
        own = BitCounts()
        for batch in parts:
            own.add(*_unpacked(*batch.columns))
        for segment in range(0, len(own.bits), SEGMENT):
            part = own.bits[segment : segment + SEGMENT]
            at = np.flatnonzero(part)
            if len(at):
                columns = [[segment // SEGMENT], [at.astype(np.uint16).tobytes()], [part[at].astype(np.int64).tobytes()]]
                kinds = [pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["segment", "at", "n"]
                )

    def added(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(SEGMENT)
        for part in parts:
            for at, n in zip(part.column("at").to_pylist(), part.column("n").to_pylist(), strict=True):
                out[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int64)
        whole = out.astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([whole], pa.binary())], names=["segment", "n"])

    parts = counted.select("key", "n").mapInArrow(summed, "segment int, at binary, n binary")

    out = np.zeros(2 * SLOTS, np.float32)
    for batch in parts.groupBy("segment").applyInArrow(added, "segment int, n binary").toArrow().to_batches():
        for segment, n in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = np.frombuffer(n.as_buffer(), np.float32)
            part = out[segment * SEGMENT : (segment + 1) * SEGMENT]
            part[:] = found[: len(part)]
    return out


def _mixer(texts: DataFrame) -> BitMixer:
    """The mixer of the training texts: counts, gate weights and refinement of all of them.

    Each task learns from :data:`LEARNT` numbers of bytes or so, in an order of their hashes;
    Spark adds up what the tasks have found, arrays of fixed size.
    """
    counted = _byte_counts(texts)
    bits = _slot_counts(counted)
    mixer = BitMixer(bits)
    distinct = counted.agg(F.sum("size")).first()[0] or 0
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def run(parts):
        mixer = BitMixer(shared.value)
        for batch in parts:
            key, n = _unpacked(*batch.columns)
            order = np.argsort(key * np.uint64(0x9E3779B97F4A7C15))
            mixer.learn(key[order], n[order])
        found = [x.tobytes() for x in mixer.learnt()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int32()), pa.array(found, pa.binary())], names=["part", "found"])

    def added(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = sum(np.frombuffer(x, np.float64) for part in parts for x in part.column("found").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([whole.tobytes()], pa.binary())], names=["part", "found"])

    shares = counted.select("key", "n").coalesce(max(1, distinct // LEARNT)).mapInArrow(run, "part int, found binary")
    found = dict(shares.groupBy("part").applyInArrow(added, "part int, found binary").collect())  # a row an array
    if found:
        mixer.take([np.frombuffer(found[k]).reshape(x.shape) for k, x in enumerate(mixer.learnt())])
    shared.destroy()
    mixer.end_learning()
    return mixer


def _text_sums(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], mixer: BitMixer) -> DataFrame:
    """Score of each text, sums over its frequent words, and its other words."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, mixer))
    name = uuid4().hex

    def run(parts):
        (key, value), mixer = shared.value
        scorer = remembered(name, mixer)
        for whole in parts:
            for at, texts in slices(whole.column(1), 4 << 20):
                batch = whole.slice(at, len(texts))
                chance, size = scorer(texts)
                _, offsets, starts, _, h = _hashed(texts)
                of = np.searchsorted(offsets, starts, "right") - 1
                n = len(texts)
                there = np.zeros(len(h), bool)
                if len(key):
                    place = np.minimum(np.searchsorted(key, h), len(key) - 1)
                    there = key[place] == h
                    found = value[place[there]]
                    base = np.bincount(of[there], found, n)
                else:
                    base = np.zeros(n)
                rest_of, rest_h, times = distinct_pairs(of[~there], h[~there])
                ends = pa.array(np.searchsorted(rest_of, np.arange(n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.bincount(of, minlength=n), pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(chance, pa.float64()),
                        pa.array(np.bincount(of[there], minlength=n), pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.ListArray.from_arrays(ends, pa.array(rest_h.view(np.int64))),
                        pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                    ],
                    names=["key", "n_words", "n_bytes", "score", "known", "base", "h", "times"],
                )

    kind = dict(docs.dtypes)["key"]
    schema = f"key {kind}, n_words long, n_bytes long, score double, known long, base double, h array<long>, times array<int>"
    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, trained: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) for each row.

    ``trained`` is a condition on the columns of ``docs``; rows that meet it are learnt
    from, all rows are scored. Null text counts as empty: one token, the end. Rows may
    repeat. An empty table gives an empty one; without any training text all counts are 0.
    ``n_bytes`` counts the words' bytes, a space behind each and the end.
    """
    spark = batches(docs.sparkSession)
    source = docs.select(
        F.col(f"`{key}`").alias("key"),
        text_of(text).alias("text"),
        F.coalesce(F.expr(trained), F.lit(False)).alias("trained"),
    )
    learnt = source.where("trained").select("text")
    counted = write_through(_word_counts(learnt), "word_counts")
    words_all, distinct = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    texts = learnt.count()
    train_tokens = words_all + texts
    kinds = distinct + (1 if texts else 0)
    bottom = train_tokens + 0.5 * (kinds + 1)

    def base_of(c: Column):
        return F.log10((c + F.lit(0.5)) / F.lit(bottom))

    mixer = _mixer(learnt)
    table = most_frequent(counted, "c", FREQUENT).toArrow()
    hashed = table.column(0).to_numpy().view(np.uint64)
    order = np.argsort(hashed)
    frequent = hashed[order], np.log10((table.column(1).to_numpy()[order] + 0.5) / bottom)
    summed = _text_sums(source.select("key", "text"), frequent, mixer)
    summed = write_through(summed.withColumn("row", F.monotonically_increasing_id()), "text_sums")

    rest = summed.select("row", F.explode(F.arrays_zip("h", "times")).alias("w")).select("row", "w.h", "w.times")
    c = F.coalesce("c", F.lit(0))
    met = rest.join(counted, "h", "left").select(
        "row",
        (base_of(c) * F.col("times")).alias("base"),
        F.when(c > 0, F.col("times")).otherwise(0).alias("known"),
    )
    met = met.groupBy("row").agg(F.sum("base").alias("more_base"), F.sum("known").alias("more_known"))
    joined = summed.drop("h", "times").join(met, "row", "left")
    base_end = math.log10((texts + 0.5) / bottom)
    return joined.select(
        "key",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + (1 if texts else 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) + base_end).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
    )


def op6_lm_scoring(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select("doc_id", "text")
    held_out = fold(5) == 1
    scored = score(docs.withColumn("trained", ~held_out), "trained")
    return scored.withColumnRenamed("key", "doc_id").withColumn("held_out", held_out)
