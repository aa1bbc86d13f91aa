"""Toxicity by votes of the nearest labelled examples.

A text is a TF-IDF vector over the words and letter sequences that its labelled sample
ties to toxic texts. Its nearest examples by cosine are found exactly in an inverted index
whose postings are kept in blocks of examples, with the largest weight of each term in each
block: blocks are read in the order of the bound this gives, until no unread block can
hold a nearer example. The examples vote, weighted by distance, and an isotonic fit on the
sample turns votes into probabilities. The examples that voted are the evidence.

The model is fitted on a bounded sample of labelled rows, so index, vocabulary and
calibration are bounded by it and are broadcast. Scoring is a narrow map over all texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DataType, DoubleType, LongType, StructField, StructType

from tripartite.llm.bytewords import FOLD, Slots, buffers, distinct_pairs, gather, hashes, slices, words
from tripartite.llm.common import append, batches, fold, map_batches, packed, read, row_text, text_of, unpacked
from tripartite.llm.language_id import BETWEEN
from tripartite.sources.scratch import write_through

TOXIC_SAMPLE, OTHER_SAMPLE = 3000, 6000  # rows the model is fitted on, on average
TOXIC_EXAMPLES, OTHER_EXAMPLES = 1500, 1500  # of those, rows in the index
LEAST_TEXTS, LEAST_CHI2, LEAST_LIFT = 3, 30.0, 25.0  # what a term needs in the sample
BANDS = 6  # of two minima of shingle hashes: texts that share a band count as one text
GRAMS = (4, 5, 6)  # bytes of the letter sequences, a space counting at a word's begin
NEIGHBOURS = 15
BLOCK = 64
NEAR = 0.05  # added to a distance before it is inverted
THRESHOLD = 0.3


# ---- terms -------------------------------------------------------------------------------


def terms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which word, hash) of the terms of each word: itself, and its letter sequences."""
    size = ends - starts + 1
    body = np.empty(int(size.sum()), np.uint8)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else np.empty(0, np.int64)
    inside = np.ones(len(body), bool)
    inside[begin] = False
    body[begin] = 0x20
    body[inside] = FOLD[gather(data, starts, size - 1)]
    which, found = [np.arange(len(size))], [hashes(body, begin, begin + size, fold=False, salt=1)]
    for n in GRAMS:
        count = np.maximum(size - n + 1, 0)
        at = gather(np.arange(len(body)), begin, count)
        which.append(np.repeat(np.arange(len(size)), count))
        found.append(hashes(body, at, at + n, fold=False))
    return np.concatenate(which), np.concatenate(found)


def _text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = buffers(texts)
    starts, ends = words(data, offsets, BETWEEN)
    return data, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _text_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term) pairs of a batch, a slice of it in work at a time."""
    found_of, found = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for at, part in slices(texts):
        data, starts, ends, of = _text_words(part)
        order = np.lexsort((hashed := hashes(data, starts, ends), of))
        new = np.ones(len(order), bool)
        new[1:] = (of[order][1:] != of[order][:-1]) | (hashed[order][1:] != hashed[order][:-1])
        once = order[new]
        which, h = terms(data, starts[once], ends[once])
        of, h, _ = distinct_pairs(of[once][which], h)
        found_of.append(of + at)
        found.append(h)
    return np.concatenate(found_of), np.concatenate(found)


@dataclass
class Vocabulary:
    """Terms by hash, ascending, and their idf."""

    key: np.ndarray
    idf: np.ndarray

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each term, or -1."""
        if not len(self.key):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.key, h), len(self.key) - 1)
        return np.where(self.key[at] == h, at, -1)


class Vectors:
    """Unit TF-IDF vectors of batches of texts. Words without a term are remembered."""

    def __init__(self, vocabulary: Vocabulary, slot_bits: int = 19):
        self.vocabulary = vocabulary
        self.known = Slots(slot_bits, 1, np.int8)

    def _has_term(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        which, h = terms(data, starts, ends)
        found = self.vocabulary.find(h) >= 0
        return (np.bincount(which[found], minlength=len(starts)) > 0).astype(np.int8)[:, None]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, weight), ordered by text and term."""
        parts = [(at, self._slice(part)) for at, part in slices(texts)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        text = np.concatenate([found[0] + at for at, found in parts])
        return text, *(np.concatenate([found[k] for _, found in parts]) for k in (1, 2))

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, starts, ends, of = _text_words(texts)
        h = hashes(data, starts, ends)
        rows = self.known.look(h, lambda new: self._has_term(data, starts[new], ends[new]))
        held = np.flatnonzero(rows[:, 0])
        which, found = terms(data, starts[held], ends[held])
        number = self.vocabulary.find(found)
        of, number = of[held][which[number >= 0]], number[number >= 0]
        size = max(1, len(self.vocabulary.key))
        pair, tf = np.unique(of * size + number, return_counts=True)
        text, term = np.divmod(pair, size)
        weight = (1 + np.log(tf)) * self.vocabulary.idf[term] if len(pair) else np.empty(0)
        norm = np.sqrt(np.bincount(text, weight**2, len(texts)))
        return text, term, weight / norm[text]


# ---- index -------------------------------------------------------------------------------


class BlockMaxIndex:
    """Postings by term and block of :data:`BLOCK` examples, and each block's largest weight."""

    def __init__(self, example: np.ndarray, term: np.ndarray, weight: np.ndarray, examples: int, n_terms: int):
        order = np.lexsort((example, term))
        self.example, self.weight = example[order], weight[order]
        self.blocks = -(-examples // BLOCK)
        cell = term[order] * self.blocks + self.example // BLOCK
        self.start = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1))
        self.largest = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.largest, cell, self.weight)
        self.largest = self.largest.reshape(n_terms, self.blocks)
        self.examples = examples

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine above 0, and the cosines. Ties go to the first example.

        Exact: a block is left out only if its bound is below the k-th cosine found.
        """
        bound = weight @ self.largest[term]
        ids, cosines = np.empty(0, np.int64), np.empty(0)
        for block in np.argsort(-bound, kind="stable").tolist():
            least = cosines[k - 1] if len(cosines) >= k else 0.0
            if bound[block] <= 0 or bound[block] < least - 1e-9:
                break
            cell = term * self.blocks + block
            size = self.start[cell + 1] - self.start[cell]
            at = gather(np.arange(len(self.example)), self.start[cell], size)
            score = np.bincount(
                self.example[at] - block * BLOCK, np.repeat(weight, size) * self.weight[at], BLOCK
            )
            here = np.flatnonzero(score > 0)
            ids = np.concatenate([ids, here + block * BLOCK])
            cosines = np.concatenate([cosines, score[here]])
            order = np.lexsort((ids, -cosines))[:k]
            ids, cosines = ids[order], cosines[order]
        return ids, np.minimum(cosines, 1.0)


def isotonic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Increasing steps (vote, probability) of least squared error: neighbours that fall are pooled."""
    steps: list[list[float]] = []  # vote, mean, weight
    order = np.argsort(votes, kind="stable")
    for v, y, w in zip(votes[order].tolist(), labels[order].tolist(), weights[order].tolist(), strict=True):
        if steps and steps[-1][3] == v:
            low, mean, total, _ = steps.pop()
            steps.append([low, (mean * total + y * w) / (total + w), total + w, v])
        else:
            steps.append([v, y, w, v])
        while len(steps) > 1 and steps[-2][1] >= steps[-1][1]:
            _, m2, w2, high = steps.pop()
            low, m1, w1, _ = steps.pop()
            steps.append([low, (m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, high])
    return np.array([s[0] for s in steps]), np.array([s[1] for s in steps])


@dataclass
class Model:
    vocabulary: Vocabulary
    index: BlockMaxIndex
    example_ids: list[int | None]
    toxic: np.ndarray
    at: np.ndarray
    probability: np.ndarray
    without: float
    key_type: DataType = LongType()

    def vote(self, ids: np.ndarray, cosines: np.ndarray) -> float:
        near = 1.0 / (1.0 - cosines + NEAR)
        return float((near * self.toxic[ids]).sum() / near.sum())

    def calibrated(self, vote: float | None) -> float:
        """Votes without any near example get the rate of such texts in the sample."""
        if vote is None or not len(self.at):
            return self.without
        return float(np.interp(vote, self.at, self.probability))


# ---- fitting and scoring -----------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """About :data:`TOXIC_SAMPLE` toxic and :data:`OTHER_SAMPLE` other rows of ``docs``
    (``key``, ``text``) with a label, by a hash of the id; ``share`` is the chance a row had.

    A null label counts as none; of several for a row the largest counts.
    """
    known = labels.select(F.col("doc_id").alias("key"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("toxic is not null and key is not null").groupBy("key").agg(F.max("toxic").alias("toxic"))
    known = write_through(known.withColumn("toxic", (F.col("toxic") > 0).cast("int")), "toxic_labels")
    there = known.join(docs.select("key").where("key is not null").distinct(), "key", "left_semi")
    seen = {r[0]: r[1] for r in there.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, TOXIC_SAMPLE / max(1, seen.get(1, 0)))).otherwise(
        min(1.0, OTHER_SAMPLE / max(1, seen.get(0, 0)))
    )
    draw = F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    drawn = there.withColumn("share", share).withColumn("draw", draw).where("draw < share")
    drawn = write_through(drawn, "toxic_draw")
    # A bounded number of ids; the texts stay where they are.
    return docs.join(F.broadcast(drawn), "key")


def _bands(texts: pa.Array) -> np.ndarray:
    """A row for each text: :data:`BANDS` hashes that texts with many common 4-word runs share."""
    data, starts, ends, of = _text_words(texts)
    h = hashes(data, starts, ends)
    run = h.copy()
    for k in range(1, 4):
        run[:-k] = run[:-k] * np.uint64(0x9E3779B97F4A7C15) + h[k:]
    inside = np.ones(len(h), bool)
    for k in range(1, 4):
        inside[:-k] &= of[:-k] == of[k:]
        inside[-k:] = False
    size = np.bincount(of, minlength=len(texts))
    inside |= (size < 4)[of]
    out = np.zeros((len(texts), BANDS), np.uint64)
    at = np.searchsorted(of[inside], np.arange(len(texts)))
    there = np.flatnonzero(size > 0)
    for band in range(BANDS):
        for half in (0, 1):
            salt = np.uint64((2 * (2 * band + half) + 1) * 0xC2B2AE3D27D4EB4F % (1 << 64))
            mixed = (run[inside] ^ salt) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(29)
            least = np.minimum.reduceat(mixed, at[there]) if len(there) else mixed[:0]
            out[there, band] = out[there, band] * np.uint64(0x165667B19E3779F9) + least
    return out


def without_copies(sample: DataFrame) -> DataFrame:
    """One row of each group of copies and near copies in the (bounded) sample.

    Otherwise every word of a text that was copied often would look tied to its label.
    """
    batches(sample.sparkSession)

    def signed(parts):
        for batch in parts:
            found = _bands(batch.column(0)).view(np.int64)
            ends = pa.array(np.arange(len(found) + 1) * BANDS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.ListArray.from_arrays(ends, pa.array(found.ravel()))],
                names=["key", "draw", "bands"],
            )

    kind = dict(sample.dtypes)["key"]
    rows = sample.select("text", "key", "draw").mapInArrow(signed, f"key {kind}, draw double, bands array<bigint>")
    leader: dict[tuple[int, int], int] = {}
    group: list[int] = []

    def find(k: int) -> int:
        while group[k] != k:
            group[k] = group[group[k]]
            k = group[k]
        return k

    found = sorted(rows.collect(), key=lambda r: (r.draw, str(r.key)))
    for k, row in enumerate(found):
        group.append(k)
        for band in enumerate(row.bands):
            other = leader.setdefault(band, k)
            low, high = sorted((find(k), find(other)))
            group[high] = low
    kept = [(r.key,) for k, r in enumerate(found) if find(k) == k]
    spark = sample.sparkSession
    return sample.join(F.broadcast(spark.createDataFrame(kept, f"key {kind}").distinct()), "key")


def _select(sample: DataFrame, n_toxic: int, n_other: int) -> Vocabulary:
    batches(sample.sparkSession)

    def count(parts):
        for batch in parts:
            of, h = _text_terms(batch.column(0))
            toxic = batch.column(1).to_numpy()[of]
            distinct, back = np.unique(h, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(distinct.view(np.int64)),
                    pa.array(np.bincount(back, toxic, len(distinct)).astype(np.int64)),
                    pa.array(np.bincount(back, minlength=len(distinct)).astype(np.int64)),
                ],
                names=["h", "toxic", "texts"],
            )

    found = sample.select("text", "toxic").mapInArrow(count, "h long, toxic long, texts long")
    found = found.groupBy("h").agg(F.sum("toxic").alias("a"), F.sum("texts").alias("n"))
    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    total = float(n_toxic + n_other)
    lean = a * total - n * n_toxic
    chi2 = lean * lean * total / (n * (total - n) * n_toxic * n_other)
    # Every term that passes: the sample is bounded, and with it the vocabulary.
    kept = (
        found.where((n >= LEAST_TEXTS) & (n < total) & (lean > 0))
        .withColumn("chi2", chi2)
        .where((F.col("chi2") >= LEAST_CHI2) & (a * n_other >= LEAST_LIFT * n_toxic * (n - a)))
        .select("h", "n")
        .collect()
    )
    key = np.array([r[0] for r in kept], np.int64).view(np.uint64)
    order = np.argsort(key)
    idf = np.log((1 + total) / (1 + np.array([r[1] for r in kept], float))) + 1
    return Vocabulary(key[order], idf[order])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Fit on a sample of the labelled rows of ``docs``; see :func:`labelled_sample`."""
    source = docs.select(F.col(f"`{key}`").alias("key"), text_of(text).alias("text"))
    sample = write_through(labelled_sample(source, labels), "toxic_sample")
    sample = write_through(without_copies(sample), "toxic_texts")
    counts = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_other = counts.get(1, 0), counts.get(0, 0)
    nothing, key_type = np.empty(0), sample.schema["key"].dataType
    if not n_toxic or not n_other:
        vocabulary = Vocabulary(np.empty(0, np.uint64), nothing)
        index = BlockMaxIndex(nothing.astype(int), nothing.astype(int), nothing, 0, 0)
        return Model(vocabulary, index, [], nothing, nothing, nothing, float(n_toxic > 0), key_type)
    vocabulary = _select(sample, n_toxic, n_other)
    shared = sample.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(parts):
        of_batch = Vectors(shared.value)
        for batch in parts:
            text, term, weight = of_batch(batch.column(0))
            at = np.searchsorted(text, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(term)),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(weight)),
                ],
                names=[*batch.schema.names[1:], "term", "weight"],
            )

    kind = dict(sample.dtypes)["key"]
    schema = f"key {kind}, toxic int, share double, draw double, term array<bigint>, weight array<double>"
    rows = sample.select("text", "key", "toxic", "share", "draw").mapInArrow(vectors, schema).collect()
    rows.sort(key=lambda r: (r.draw, r.toxic, str(r.key)))
    members: list[int] = []
    for toxic, most in ((1, TOXIC_EXAMPLES), (0, OTHER_EXAMPLES)):
        members += [k for k, r in enumerate(rows) if r.toxic == toxic and r.term][:most]
    members.sort()
    example = np.repeat(np.arange(len(members)), [len(rows[k].term) for k in members])
    term = np.array([t for k in members for t in rows[k].term], np.int64)
    weight = np.array([w for k in members for w in rows[k].weight], float)
    index = BlockMaxIndex(example, term, weight, len(members), len(vocabulary.key))
    model = Model(
        vocabulary, index, [rows[k].key for k in members],
        np.array([rows[k].toxic for k in members], float), nothing, nothing, 0.0, key_type,
    )
    _calibrate(model, rows, {k: place for place, k in enumerate(members)})
    shared.destroy()
    return model


def _calibrate(model: Model, rows: list, place: dict[int, int]) -> None:
    """Votes of the sample's own rows, none for itself, against their labels."""
    votes, labels, weights = [], [], []
    alone = np.zeros(2)
    for k, row in enumerate(rows):
        ids, cosines = model.index.nearest(np.array(row.term, np.int64), np.array(row.weight), NEIGHBOURS + 1)
        others = ids != place.get(k, -1)
        ids, cosines = ids[others][:NEIGHBOURS], cosines[others][:NEIGHBOURS]
        if len(ids):
            votes.append(model.vote(ids, cosines))
            labels.append(float(row.toxic))
            weights.append(1.0 / row.share)
        else:
            alone += np.array([row.toxic, 1.0]) / row.share
    model.at, model.probability = isotonic(np.array(votes), np.array(labels), np.array(weights))
    model.without = float(alone[0] / alone[1]) if alone[1] else 0.0


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Each row as a struct ``row`` with ``score``, ``predicted`` and ``evidence``: the ids
    of the examples that voted, nearest first, with their cosines.

    Texts are read whole; null and empty ones have no near example and get the rate of
    such texts. Equal texts get equal scores. Columns of any name may be there.
    """
    whole, place = packed(docs), docs.columns.index(text)
    key_type = to_arrow_type(model.key_type)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [
        StructField("score", DoubleType()),
        StructField("examples", ArrayType(model.key_type)),
        StructField("cosines", ArrayType(DoubleType())),
    ]

    def each():
        model = shared.value
        of_batch = Vectors(model.vocabulary)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            term_of, term, weight = of_batch(row_text(batch, place))
            at = np.searchsorted(term_of, np.arange(batch.num_rows + 1)).tolist()
            scores, found, near = [], [], []
            for low, high in zip(at, at[1:], strict=False):
                if low == high:
                    ids, cosines = [], []
                    scores.append(model.without)
                else:
                    ids, cosines = model.index.nearest(term[low:high], weight[low:high], NEIGHBOURS)
                    scores.append(model.calibrated(model.vote(ids, cosines) if len(ids) else None))
                found.append([model.example_ids[k] for k in ids])
                near.append(list(cosines))
            return append(
                batch,
                ["row"],
                score=pa.array(scores, pa.float64()),
                examples=pa.array(found, pa.list_(key_type)),
                cosines=pa.array(near, pa.list_(pa.float64())),
            )

        return work

    scored = map_batches(whole, each, StructType([whole.schema["row"], *added]))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    return unpacked(score(docs, model).where("predicted = 0"), docs)


def op3_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select("doc_id", "text")
    model = fit(docs.where(fold(4) != 2), read(spark, root, "labels"))
    return score(docs, model).select(
        "row.doc_id", (fold(4, "row.doc_id") == 2).alias("held_out"), "score", "predicted", "examples", "cosines"
    )
