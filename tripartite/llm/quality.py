"""Quality scores learnt from heuristics alone.

Several heuristics vote on every text: good, bad or no opinion. They overlap and err, and
no row is labelled; expectation-maximisation over the counts of vote patterns estimates
how often each heuristic is right, and with that the chance that a text is good, given its
votes. Those posteriors label a sample on which a linear scorer over hashed words and word
shapes is trained, which then scores every text, also where all heuristics are silent.

Patterns are at most ``3 ** labellers`` rows, whatever the corpus; the scorer has a fixed
number of weights. Votes and scores are narrow maps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tripartite.llm.bytewords import WHITE, buffers, distinct_pairs, hashes, words
from tripartite.llm.common import append, batches, map_batches, packed, read, text_of
from tripartite.sources.scratch import write_through

HASH_BITS = 18
REPEATED = 1  # the feature of a word that repeats the one before
SAMPLE = 8000  # texts that the scorer is trained on, on average
EPOCHS = 8
STEP = 0.5
ROUNDS = 50  # of expectation-maximisation
ADVANTAGE = 100.0  # a bad vote is at least so many times likelier for a bad text
PRIOR_MASS = 0.05  # weight of the prior on votes, as a share of the corpus

LABELLERS = ["length", "word_length", "capitals", "symbols", "separators", "exclamations", "variety", "runs"]

# Byte classes.
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*+/<=>@\\^_`{}~")] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(b"|;\t")] = True
_EXCLAIM = np.zeros(256, bool)
_EXCLAIM[list(b"!?")] = True
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58], _SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:] = 48, 65, 97, 97


def _sums(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marked)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _vote(bad: np.ndarray, able: np.ndarray) -> np.ndarray:
    """Bad (-1), good (1), or no opinion where a text is too short for the labeller."""
    return np.where(able, np.where(bad, -1, 1), 0)


def votes(texts: pa.Array) -> np.ndarray:
    """A row for each text with the vote of each labeller: 1 good, -1 bad, 0 no opinion."""
    data, offsets = buffers(texts)
    starts, ends = words(data, offsets)
    h = hashes(data, starts, ends)
    of = np.searchsorted(offsets, starts, "right") - 1
    n_texts = len(offsets) - 1
    n = np.bincount(of, minlength=n_texts).astype(float)
    some = np.maximum(n, 1)
    letters = np.maximum(_sums(_LETTER[data], offsets), 1)
    inside = np.maximum(_sums(~WHITE[data], offsets), 1)
    mean_length = np.bincount(of, ends - starts, n_texts) / some
    capitals = _sums(_UPPER[data], offsets) / letters
    symbols = _sums(_SYMBOL[data], offsets) / inside
    separators = _sums(_SEPARATOR[data], offsets) / some
    exclaims = _sums(_EXCLAIM[data], offsets) / some
    pairs = distinct_pairs(of, h)[0]
    # Texts use fewer new words the longer they are; the root allows for that.
    variety = np.bincount(pairs, minlength=n_texts) / np.sqrt(some)
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (of[1:] == of[:-1])]) if len(h) else np.empty(0, bool)
    runs = np.bincount(of, same, n_texts) / some
    enough = n >= 10
    return np.stack(
        [
            _vote(n < 8, n >= 0),
            _vote((mean_length < 2) | (mean_length > 14), n > 0),
            _vote(capitals > 0.3, letters > 20),
            _vote(symbols > 0.05, n > 0),
            _vote(separators > 0.2, enough),
            _vote(exclaims > 0.25, enough),
            _vote(variety < 2, n >= 30),
            _vote(runs > 0.15, enough),
        ],
        axis=1,
    ).astype(np.int32)


def label_model(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Chance that each pattern is good, each labeller's accuracy, and the share of good texts.

    Every labeller has a chance of each vote given the class, no opinion included. The
    start takes texts with a bad vote for bad ones, which fixes what good means, and a
    small prior and :data:`ADVANTAGE` say that a good text rarely gets a bad vote; no
    outside label is used.
    """
    if not len(patterns):
        return np.empty(0), np.full(len(LABELLERS), np.nan), 0.5
    weight = counts / counts.sum()
    good = np.where((patterns == -1).any(axis=1), 0.1, 0.95)
    prior = PRIOR_MASS * np.array([[0.3, 0.1, 0.6], [0.004, 0.1, 0.896]])
    classes = np.zeros((2, patterns.shape[1], 3))
    share = 0.5
    for _ in range(ROUNDS):
        for y, belief in enumerate((1 - good, good)):
            mass = weight * belief
            for v in (-1, 0, 1):
                classes[y, :, v + 1] = ((patterns == v) * mass[:, None]).sum(axis=0) + prior[y, v + 1]
            classes[y] /= classes[y].sum(axis=1, keepdims=True)
        # A labeller that overlaps with no other could as well be wrong; assume it is not.
        excess = np.maximum(classes[1, :, 0] - classes[0, :, 0] / ADVANTAGE, 0)
        classes[1, :, 0] -= excess
        classes[1, :, 2] += excess
        share = float(np.clip((weight * good).sum(), 0.01, 0.99))
        log = np.log([1 - share, share])[:, None] + np.stack(
            [np.log(np.take_along_axis(classes[y].T, patterns + 1, axis=0)).sum(axis=1) for y in (0, 1)]
        )
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    # Of the votes that are cast, the part that agrees with the class.
    right = share * classes[1, :, 2] + (1 - share) * classes[0, :, 0]
    wrong = share * classes[1, :, 0] + (1 - share) * classes[0, :, 2]
    return good, right / (right + wrong), share


# ---- the linear scorer --------------------------------------------------------------------


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value): hashed words as written, the shapes of their ends, and words
    that repeat the one before, each with its share of the text's words."""
    data, offsets = buffers(texts)
    starts, ends = words(data, offsets)
    of = np.searchsorted(offsets, starts, "right") - 1
    shift = np.uint64(64 - HASH_BITS)
    h = hashes(data, starts, ends, fold=False)
    word = (h >> shift).astype(np.int64)
    again = np.flatnonzero((h[1:] == h[:-1]) & (of[1:] == of[:-1])) + 1
    shape = (hashes(_SHAPE[data], np.maximum(starts, ends - 3), ends, fold=False, salt=2) >> shift).astype(np.int64)
    size = 1 << HASH_BITS
    pair, count = np.unique(
        np.concatenate([of * size + word, of * size + shape, of[again] * size + REPEATED]), return_counts=True
    )
    text, feature = np.divmod(pair, size)
    n = np.bincount(of, minlength=len(offsets) - 1)
    return text, feature, count / n[text]


def _train(batch_list: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Logistic weights by adaptive gradient steps; the bias is the last one."""
    w = np.zeros((1 << HASH_BITS) + 1)
    seen = np.full(len(w), 1e-2)
    for _ in range(EPOCHS):
        for text, feature, value, target in batch_list:
            n = len(target)
            # Small groups of texts, a step for each.
            for low in range(0, n, 64):
                at = slice(*np.searchsorted(text, [low, min(low + 64, n)]))
                t, f, v = text[at] - low, feature[at], value[at]
                y = target[low : low + 64]
                p = 1 / (1 + np.exp(-(np.bincount(t, w[f] * v, len(y)) + w[-1])))
                error = p - y
                touched, back = np.unique(f, return_inverse=True)
                step = np.append(np.bincount(back, error[t] * v, len(touched)), error.sum())
                touched = np.append(touched, len(w) - 1)
                seen[touched] += step**2
                w[touched] -= STEP * step / np.sqrt(seen[touched])
    return w


@dataclass
class Model:
    patterns: dict[str, float]
    accuracy: dict[str, float]
    good: float
    weights: np.ndarray


def voted(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each row as a struct ``row`` with its ``text`` and ``votes``."""
    whole = packed(docs, text_of(text).alias("text"))
    schema = StructType([*whole.schema.fields, StructField("votes", ArrayType(IntegerType()))])

    def each():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = votes(batch.column(1))
            ends = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
            return append(batch, ["row", "text"], votes=pa.ListArray.from_arrays(ends, pa.array(found.ravel())))

        return work

    return map_batches(whole, each, schema)


def _pattern(column: str = "votes"):
    return F.array_join(F.col(column).cast("array<string>"), ",")


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Label model from the votes on all of ``docs``, scorer from a sample by text hash."""
    ballots = voted(docs, text).select(_pattern().alias("pattern"))
    counts = ballots.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    patterns = np.array([[int(v) for v in r.pattern.split(",")] for r in counts], int).reshape(-1, len(LABELLERS))
    sizes = np.array([r.n for r in counts], float)
    good, accuracy, share = label_model(patterns, sizes)
    by_pattern = {r.pattern: float(g) for r, g in zip(counts, good, strict=True)}
    rate = min(1.0, SAMPLE / max(1.0, sizes.sum()))
    spark = docs.sparkSession
    drawn = docs.where(F.pmod(F.xxhash64(text_of(text)), F.lit(1 << 30)) < rate * (1 << 30))
    # A text counts once, however often it was copied, so the sample keeps to its size.
    once = drawn.select(text_of(text).alias(text)).distinct()
    drawn = write_through(voted(once, text).select("text", _pattern().alias("pattern")), "quality_sample")
    shared = spark.sparkContext.broadcast(by_pattern)
    batches(spark)

    def train(parts):
        seen = []
        for batch in parts:
            target = np.array([shared.value[p] for p in batch.column(1).to_pylist()])
            seen.append((*features(batch.column(0)), target))
        yield pa.RecordBatch.from_arrays([pa.array([_train(seen).tobytes()], pa.binary())], names=["weights"])

    # One task, as steps follow each other; the sample is bounded.
    ordered = drawn.orderBy(F.xxhash64("text", F.lit(5))).coalesce(1)
    found = ordered.mapInArrow(train, "weights binary").first()
    weights = np.frombuffer(bytes(found[0]), float) if found else np.zeros((1 << HASH_BITS) + 1)
    return Model(by_pattern, dict(zip(LABELLERS, accuracy.tolist(), strict=True)), share, weights)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Each row as a struct ``row`` with ``votes``, ``weak_label`` (the posterior of its
    votes), ``score`` (0 to 1) and ``predicted`` (1 if it is 0.5 or more).

    A null or empty text has no words and gets the bias alone and the votes of an empty
    text. Texts are read whole, equal texts score equally, columns of any name may be there.
    """
    cast = voted(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast((model.patterns, model.weights, model.good))
    schema = StructType(
        [
            cast.schema["row"],
            cast.schema["votes"],
            StructField("weak_label", DoubleType()),
            StructField("score", DoubleType()),
        ]
    )

    def each():
        patterns, weights, good = shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            of, feature, value = features(batch.column(1))
            odds = np.bincount(of, weights[feature] * value, batch.num_rows) + weights[-1]
            names = (",".join(map(str, v)) for v in batch.column(2).to_pylist())
            return append(
                batch,
                ["row", "votes"],
                weak_label=pa.array([patterns.get(p, good) for p in names], pa.float64()),
                score=pa.array(1 / (1 + np.exp(-odds))),
            )

        return work

    return map_batches(cast, each, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs))
    return scored.select("row.doc_id", "votes", "weak_label", "score", "predicted")
