"""Language identification by unigram pieces, summed over all segmentations.

A word is the text between non-letters, with a space before it. Its probability in a
language is the sum, over every way to cut it into pieces of a fixed public vocabulary, of
the product of the pieces' probabilities in that language; a forward pass over the word's
bytes adds them up. The probability of a text is that of its words, and the language with
the largest posterior is predicted.

The pieces' probabilities are fitted by expectation-maximisation on a bounded sample of
labelled documents. Expected counts are summed in the tasks and then by Spark, so the
driver gets at most one number for each piece and language. Scoring is a narrow map; word
probabilities are remembered in a table of fixed size.
"""

from __future__ import annotations

import base64
from collections import deque
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tripartite.llm.bytewords import FOLD, Slots, buffers, hashes, words
from tripartite.llm.common import append, batches, fold, map_batches, packed, read, text_of
from tripartite.sources.scratch import write_through

VOCABULARY = "byte_bpe_50k.tiktoken"
LONGEST = 128  # bytes of the longest piece of the vocabulary
NEAR = 12  # bytes of the pieces that nearly every place has
STRETCH = 256  # places whose pieces are looked up at once
SAMPLE = 1000  # labelled documents of each language that the model is fitted on, on average
ITERATIONS = 2
SMOOTHING = 0.05  # of the mass goes to the pieces' average over the languages
FLOOR = 1e-8
UNKNOWN = "und"

# Bytes outside words: ASCII without its letters.
BETWEEN = np.zeros(256, bool)
BETWEEN[:128] = True
BETWEEN[65:91] = BETWEEN[97:123] = False


@lru_cache(maxsize=2)
def pieces(path: str | None = None) -> list[bytes]:
    """Pieces of letters, with or without a space before them, lower-cased; every byte too."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        found = {base64.b64decode(line.split()[0]).lower() for line in file if line.strip()}
    found |= {bytes([b]) for b in range(256)}
    def letters(piece: bytes) -> bool:
        body = piece[1:] if piece[:1] == b" " and len(piece) > 1 else piece
        return len(piece) <= LONGEST and not any(BETWEEN[b] for b in body)
    return sorted(p for p in found if len(p) == 1 or letters(p))


class Pieces:
    """The vocabulary by hash. Number 0 stands for no piece."""

    def __init__(self, found: list[bytes]):
        data = np.frombuffer(b"".join(found), np.uint8)
        ends = np.cumsum([len(p) for p in found])
        h = hashes(data, np.concatenate([[0], ends[:-1]]), ends, fold=False)
        order = np.argsort(h)
        self.key = h[order]
        self.number = order + 1
        self.size = len(found) + 1
        self.lengths = sorted({len(p) for p in found})

    def find(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.key, h), len(self.key) - 1)
        return np.where(self.key[at] == h, self.number[at], 0)


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None) -> Pieces:
    return Pieces(pieces(path))


def _matrix(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words as rows, a space before each, padded with spaces; their lengths."""
    size = ends - starts
    at = starts[:, None] + np.arange(size.max())
    inside = np.arange(size.max()) < size[:, None]
    out = np.full((len(starts), size.max() + 1), 0x20, np.uint8)
    out[:, 1:][inside] = FOLD[data[at[inside]]]
    return out, size + 1


def _numbers(rows: np.ndarray, low: int, high: int, of: Pieces) -> dict[int, np.ndarray]:
    """By length, numbers of the pieces that end in (low, high], one row a place, 0 for none."""
    first = max(0, low - LONGEST)
    part = rows[:, first:high]
    flat = np.ascontiguousarray(part).ravel()
    out = {}
    for back in of.lengths:
        begin = np.arange(max(0, low + 1 - back), high - back + 1) - first
        if len(begin):
            starts = (np.arange(len(part))[:, None] * part.shape[1] + begin).ravel()
            found = of.find(hashes(flat, starts, starts + back, fold=False))
            out[back] = np.ascontiguousarray(found.astype(np.int32).reshape(len(part), -1).T)
    return out


def _places(rows: np.ndarray, of: Pieces, last_first: bool = False):
    """Each place of the rows and the pieces that end there, as pairs of length and numbers."""
    turn = reversed if last_first else iter
    for low in turn(range(0, rows.shape[1], STRETCH)):
        high = min(rows.shape[1], low + STRETCH)
        found = _numbers(rows, low, high, of)
        for end in turn(range(low + 1, high + 1)):
            yield end, [(back, n[end - max(low + 1, back)]) for back, n in found.items() if back <= end]


def _log_sums(rows: np.ndarray, p: np.ndarray, of: Pieces):
    """At each place the log of the sum over all segmentations of the bytes before it.

    The sums are rescaled as they go, so words of any length keep their precision. Pieces
    over :data:`NEAR` bytes are added as logs, as their sums may be of other magnitude.
    """
    shape = (len(rows), p.shape[1])
    alpha, scale = [np.ones(shape)], np.zeros(shape)
    logs = deque([np.zeros(shape)], LONGEST)
    for end, found in _places(rows, of):
        total = np.zeros(shape)
        for back, used in found:
            if back <= NEAR:
                total += alpha[-back] * p[used]
        for back, used in found:
            there = np.flatnonzero(used) if back > NEAR else ()
            if len(there):
                whole = logs[-back][there] + np.log(p[used[there]])
                whole = np.logaddexp(np.log(total[there]) + scale[there], whole)
                more = np.maximum(0, whole - scale[there])
                scale[there] += more
                total[there] = np.exp(whole - scale[there])
                for a in alpha:
                    a[there] *= np.exp(-more)
        alpha = [*alpha[1 - NEAR :], total]
        logs.append(np.log(total) + scale)
        if end % 8 == 0:
            top = np.maximum.reduce(alpha)
            alpha = [a / top for a in alpha]
            scale = scale + np.log(top)
        yield end, logs[-1]


def forward(rows: np.ndarray, size: np.ndarray, p: np.ndarray, of: Pieces) -> np.ndarray:
    """log probability of each row's first ``size`` bytes, one column a language."""
    out = np.zeros((len(rows), p.shape[1]))
    for end, log in _log_sums(rows, p, of):
        done = size == end
        out[done] = log[done]
    return out


def expected_counts(
    rows: np.ndarray, counts: np.ndarray, p: np.ndarray, of: Pieces, size: np.ndarray | None = None
) -> np.ndarray:
    """Expected uses of each piece in words, ``counts`` of them by language; a word is the
    first ``size`` bytes of its row, or all of it.

    From the end of each word, ``cut`` is how often a segmentation is expected to cut at a
    place. A piece takes its share of the cuts at its end, and passes it to its begin.
    """
    n, width = rows.shape
    langs = p.shape[1]
    logs = np.zeros((width + 1, n, langs))
    for end, log in _log_sums(rows, p, of):
        logs[end] = log
    cut = np.zeros_like(logs)
    cut[np.full(n, width) if size is None else size, np.arange(n)] = counts
    out = np.zeros(of.size * langs)
    with np.errstate(divide="ignore"):
        log_p = np.log(p)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for end, found in _places(rows, of, last_first=True):
        for back, used in found:
            there = np.flatnonzero(used)
            if len(there):
                number = used[there]
                uses = cut[end][there] * np.exp(logs[end - back][there] - logs[end][there] + log_p[number])
                cut[end - back][there] += uses
                waiting.append(((number[:, None].astype(np.int64) * langs + np.arange(langs)).ravel(), uses.ravel()))
                held += uses.size
        if held and (held > 1 << 18 or end == 1):
            place, uses = (np.concatenate(x) for x in zip(*waiting, strict=True))
            out += np.bincount(place, uses, len(out))
            waiting, held = [], 0
    return out.reshape(of.size, langs)


def _by_length(starts: np.ndarray, ends: np.ndarray, coarse: bool):
    """Positions of words of equal length; long ones by powers of two if ``coarse``."""
    size = ends - starts
    kind = np.where(coarse & (size > 24), 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64), size)
    order = np.argsort(kind, kind="stable")
    cuts = np.flatnonzero(np.diff(kind[order])) + 1
    for group in np.split(order, cuts):
        # At most a few MB at a time.
        step = max(1, (1 << 18) // int(size[group].max(initial=1)))
        for at in range(0, len(group), step):
            yield group[at : at + step]


def _add_counts(sample: DataFrame, languages: list[str], p: np.ndarray) -> np.ndarray:
    """One expectation step: expected uses of each piece and language in the sample."""
    spark = sample.sparkSession
    shared = spark.sparkContext.broadcast(p)
    place = {lang: k for k, lang in enumerate(languages)}
    batches(spark)

    def run(parts):
        of, p = vocabulary(), shared.value
        total = np.zeros_like(p)
        for batch in parts:
            data, offsets = buffers(batch.column(0))
            lang = np.array([place[x] for x in batch.column(1).to_pylist()], np.int64)
            starts, ends = words(data, offsets, BETWEEN)
            h = hashes(data, starts, ends)
            own = lang[np.searchsorted(offsets, starts, "right") - 1]
            distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
            counts = np.zeros((len(distinct), len(place)))
            np.add.at(counts, (back, own), 1.0)
            starts, ends = starts[first], ends[first]
            for group in _by_length(starts, ends, True):
                rows, size = _matrix(data, starts[group], ends[group])
                total += expected_counts(rows, counts[group], p, of, size)
        piece, which = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece), pa.array(which), pa.array(total[piece, which])], names=["piece", "lang", "n"]
        )

    sums = sample.mapInArrow(run, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n"))
    out = np.zeros_like(p)
    for piece, lang, n in sums.collect():  # at most one row for each piece and language
        out[piece, lang] = n
    return out


class Model:
    """Piece probabilities (row 0: no piece) and the languages' shares."""

    def __init__(self, languages: list[str], p: np.ndarray, prior: np.ndarray):
        self.languages, self.p, self.prior = languages, p, prior

    def score(self) -> ScoreBatches:
        return ScoreBatches(self)


class ScoreBatches:
    def __init__(self, model: Model, slot_bits: int = 18):
        self.model, self.of = model, vocabulary()
        self.known = Slots(slot_bits, len(model.languages), np.float64)

    def _rows(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros((len(starts), len(self.model.languages)))
        for group in _by_length(starts, ends, True):
            rows, size = _matrix(data, starts[group], ends[group])
            out[group] = forward(rows, size, self.model.p, self.of)
        return out

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """Log posterior of each text, one column a language."""
        data, offsets = buffers(texts)
        starts, ends = words(data, offsets, BETWEEN)
        each = self.known.look(hashes(data, starts, ends), lambda new: self._rows(data, starts[new], ends[new]))
        sums = np.concatenate([np.zeros((1, each.shape[1])), np.cumsum(each, axis=0)])
        at = np.searchsorted(starts, offsets, "left")
        log = sums[at[1:]] - sums[at[:-1]] + self.model.prior
        log -= log.max(axis=1, keepdims=True)
        return log - np.log(np.exp(log).sum(axis=1, keepdims=True))


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE
) -> Model:
    """Fit on about ``sample`` documents of each language, chosen by a hash of their ids.

    Rows without a language are left out. A language's share of the labelled rows is its
    prior. Without any labelled row the model has no language and predicts ``und``.
    """
    labelled = docs.select(
        F.xxhash64(F.col(f"`{key}`").cast("string"), F.lit(11)).alias("draw"),
        text_of(text).alias("text"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
    ).where("lang is not null")
    seen = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}  # one row a language
    languages = sorted(seen)
    if not languages:
        return Model([], np.zeros((vocabulary().size, 0)), np.zeros(0))
    spark = docs.sparkSession
    rates = spark.createDataFrame(
        [(x, min(1.0, sample / seen[x])) for x in languages], "lang string, rate double"
    )
    drawn = labelled.join(F.broadcast(rates), "lang").where(F.pmod("draw", F.lit(1 << 30)) < F.col("rate") * (1 << 30))
    drawn = write_through(drawn.select("text", "lang"), "language_sample")
    size = vocabulary().size
    p = np.full((size, len(languages)), 1.0 / size)
    p[0] = 0
    for _ in range(ITERATIONS):
        n = _add_counts(drawn, languages, p)
        n /= np.maximum(n.sum(axis=0), 1e-300)
        p = (1 - SMOOTHING) * n + SMOOTHING * n.mean(axis=1, keepdims=True) + FLOOR
        p[0] = 0
        p /= p.sum(axis=0)
    share = np.array([seen[x] for x in languages], float)
    return Model(languages, p, np.log(share / share.sum()))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Each row as a struct ``row`` with ``lang_pred``, ``score`` and all ``log_posteriors``.

    A text that is null or has no letter is ``und`` with score 0. Texts are read whole,
    ties go to the language that sorts first, columns of any name may be there.
    """
    whole = packed(docs, text_of(text).alias("text"))
    if not model.languages:
        return whole.select(
            "row",
            F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.array().cast("array<double>").alias("log_posteriors"),
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType(
        [*whole.schema.fields, StructField("log_posteriors", ArrayType(DoubleType()))]
    )

    def each():
        score = shared.value.score()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            log = score(batch.column(1))
            ends = pa.array(np.arange(len(log) + 1) * log.shape[1], pa.int32())
            return append(
                batch, ["row", "text"], log_posteriors=pa.ListArray.from_arrays(ends, pa.array(log.ravel()))
            )

        return work

    scored = map_batches(whole, each, schema)
    letter = F.col("text").rlike(r"\p{L}")
    names = F.array(*[F.lit(x) for x in model.languages])
    top = F.array_max("log_posteriors")
    best = F.element_at(names, F.array_position("log_posteriors", top).cast("int"))
    return scored.select(
        "row",
        F.when(letter, best).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(letter, F.exp(top)).otherwise(F.lit(0.0)).alias("score"),
        "log_posteriors",
    )


def op5_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(fold(5) != 0))
    return predict(docs.select("doc_id", "text"), model).select(
        "row.doc_id", (fold(5, "row.doc_id") == 0).alias("held_out"), "lang_pred", "score"
    )
