"""A corpus pipeline over documents: toxic texts go, then exact copies, near copies and
benchmark passages, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir), works on every row of ``docs`` and returns the rows
that it keeps with all their columns; the last returns the pieces. ``run`` writes each
stage's rows below the shared folder and reads them again for the next one, so a lost
executor costs the stage's tasks at most, never an earlier stage.

Nulls and empty texts count as empty text: clean, one copy of it stays, no shingles, no
benchmark words, one end id. Repeated rows are copies. Columns of any name are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripartite.llm import decontaminate, exact_dedup, jaccard_join, packing, toxicity
from tripartite.llm.common import fold, read
from tripartite.sources.scratch import drop_folder, scratch_path, workspace, write_through


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below the threshold. The model is fitted on labelled
    rows of ``docs`` that are not held out."""
    model = toxicity.fit(docs.where(fold(4) != 2), read(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the row with the smallest doc_id."""
    return jaccard_join.drop_linked(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which less than a twentieth of the words lies in benchmark windows."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 ids."""
    return packing.pack(docs).withColumnRenamed("key", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Neither a fitted classifier nor a tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. What a stage writes on the way goes when its rows have been
    written, and its rows when the next stage's have."""
    docs, former = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with workspace(spark):
            docs = write_through(stage(spark, docs, sf_dir), name, path)
        if former:
            drop_folder(spark, former)
        former = path
    return docs
