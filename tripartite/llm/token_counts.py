"""Token counts as rollups that signed changes keep up to date.

Totals by source, language and tokenizer version are additive, so a change needs only its
own rows: an insert counts +, a delete counts -, a revised count is both. A batch of
changes is summed and written to a folder of its own. Writing a batch again replaces that
folder, so a repeated or half-finished attempt never counts twice; the totals are the sum
over the folders. ``compact`` folds committed batches into a snapshot that names them.

Every sum combines in the map tasks first: a source with a third of all rows arrives as
one row from each task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripartite.llm.bpe import encoder
from tripartite.llm.bytewords import buffers, words
from tripartite.llm.common import append, map_batches, read, text_of
from tripartite.sources.scratch import scratch_path, write_through

KEYS = ["source", "lang", "tokenizer"]
TOTALS = ["documents", "tokens"]

MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"

Counter = Callable[[pa.Array], np.ndarray]


def _bpe(texts: pa.Array) -> np.ndarray:
    return np.diff(encoder()(texts)[1])


def _space_words(texts: pa.Array) -> np.ndarray:
    data, offsets = buffers(texts)
    starts, _ = words(data, offsets)
    return np.diff(np.searchsorted(starts, offsets, "left"))


TOKENIZERS: dict[str, Counter] = {"byte_bpe_50k": _bpe, "space_words": _space_words}


def counted(docs: DataFrame, tokenizers: dict[str, Counter] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens) and the columns to ``keep``, one row a
    document and tokenizer; a repeated row is a document of its own, whatever its id.

    The whole text is counted; null counts as empty, with 0 tokens.
    """
    versions = tokenizers or TOKENIZERS
    kept = ["doc_id", "source", "lang", *keep]
    picked = docs.select(*kept, text_of().alias("text"))
    schema = picked.select(*kept, F.array().cast("array<bigint>").alias("n")).schema

    def each():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.schema.get_field_index("text"))
            n = np.stack([count(texts) for count in versions.values()], axis=1).astype(np.int64)
            ends = np.arange(len(texts) + 1) * n.shape[1]
            return append(batch, kept, n=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(n.ravel())))

        return work

    names = F.array(*[F.lit(v) for v in versions])
    rows = map_batches(picked, each, schema).select(*kept, F.arrays_zip(names.alias("v"), F.col("n")).alias("z"))
    return rows.select(*kept, F.inline("z").alias("tokenizer", "tokens"))


def changes(counts: DataFrame, sign: int) -> DataFrame:
    """Inserts (+1) or deletes (-1) of counted documents."""
    return counts.select(*KEYS, F.lit(sign).alias("documents"), (F.col("tokens") * sign).alias("tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts that replace others: the old ones leave, the new ones enter."""
    return changes(before, -1).unionByName(changes(after, 1))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in TOTALS])


def commit_batch(store: str, batch: str, rows: DataFrame) -> None:
    """Write the sum of a batch's changes; the same batch again replaces it. Any text names
    a batch, and ``01`` is another one than ``1``."""
    folder = quote(batch, safe="")  # as Spark itself writes and reads such names
    _summed(rows).coalesce(1).write.mode("overwrite").parquet(f"{store}/deltas/batch={folder}")


_SUMS = "source string, lang string, tokenizer string, documents long, tokens long"


def _read_or_none(spark: SparkSession, path: str, more: str) -> DataFrame | None:
    """With a schema, so that names of batches stay the text that they are."""
    try:
        return spark.read.schema(f"{_SUMS}, {more}").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _parts(spark: SparkSession, store: str) -> tuple[DataFrame | None, DataFrame | None]:
    """The newest snapshot, and the batches it does not hold."""
    deltas = _read_or_none(spark, f"{store}/deltas", "batch string")
    snapshots = _read_or_none(spark, f"{store}/snapshots", "folded array<string>, version long")
    if snapshots is None:
        return None, deltas
    newest = snapshots.agg(F.max("version")).first()[0]
    snapshot = snapshots.where(F.col("version") == newest)
    if deltas is not None:
        deltas = deltas.join(snapshot.select(F.explode("folded").alias("batch")).distinct(), "batch", "left_anti")
    return snapshot, deltas


def totals(spark: SparkSession, store: str) -> DataFrame:
    """Documents and tokens by key over all committed batches; keys at zero are left out."""
    found = [p.select(*KEYS, *TOTALS) for p in _parts(spark, store) if p is not None]
    if not found:
        return spark.createDataFrame([], _SUMS)
    rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return _summed(rows).where("documents <> 0 or tokens <> 0")


def compact(spark: SparkSession, store: str) -> None:
    """Fold every batch committed so far into a new snapshot.

    The snapshot names the batches it holds, so readers count each once, whether its
    folder is still there or not. A folded batch must not be written again.
    """
    snapshot, deltas = _parts(spark, store)
    if deltas is None:
        return
    before = [snapshot.select(F.explode("folded").alias("batch")).distinct()] if snapshot is not None else []
    names = deltas.select("batch").distinct()
    for more in before:
        names = names.unionByName(more).distinct()
    folded = sorted(r[0] for r in names.collect())  # one row a batch
    version = 0 if snapshot is None else snapshot.agg(F.max("version")).first()[0] + 1
    rows = totals(spark, store).withColumn("folded", F.array(*[F.lit(b) for b in folded]).cast("array<string>"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{store}/snapshots/version={version}")


def op2_token_counts(spark: SparkSession, root: str) -> DataFrame:
    """Totals after three batches: every document enters; those with mail addresses are
    counted anew with the addresses masked; those labelled as of no quality leave. The
    first batch is committed twice, to no effect.
    """
    store = scratch_path(spark, "token_rollup")
    docs = read(spark, root, "documents").select(
        "doc_id", "text", "source", "lang", F.coalesce(F.col("text").rlike(MAIL), F.lit(False)).alias("mail")
    )
    loaded = write_through(counted(docs, keep=["mail"]), "token_counts")
    for _ in range(2):
        commit_batch(store, "load", changes(loaded, 1))

    # Rows tell by themselves whether they are revised: ids may be shared or missing.
    revised = docs.where("mail").withColumn("text", F.regexp_replace("text", MAIL, "[mail]"))
    current = write_through(counted(revised), "token_recounts")
    commit_batch(store, "mask", revisions(loaded.where("mail"), current))

    poor = read(spark, root, "labels").where("quality = 0").select("doc_id").distinct()
    standing = loaded.where("not mail").drop("mail").unionByName(current)
    commit_batch(store, "retract", changes(standing.join(poor, "doc_id", "left_semi"), -1))
    return totals(spark, store)
