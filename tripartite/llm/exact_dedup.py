"""Exact dedup by content sort, on DataFrame functions only.

Spark samples splitters, range-partitions the rows on the bytes of their texts and sorts
each range externally. Equal texts are then neighbours, and a window over the sorted
range, which compares each text with the one before it in full, finds the row that
stays. The window needs no further exchange: equal texts of one part share a range.

Splitters go to the driver, so they are kept small: the first ``LEAD`` bytes of a text
and a hash of all of it, which tells texts with the same beginning apart.

Hot groups are split. A text with more than one row in ``HOT_SHARE`` is dealt out into
parts by its row ids, so its copies form several runs that other splitters may separate.
At most ``HOT_SHARE`` texts can be that frequent, so the totals of their runs are a
small table of a proven size, and broadcasting it back is safe. Which texts are hot
changes the plan of work, never the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripartite.llm.common import packed, read, text_of, unpacked
from tripartite.sources.scratch import write_through

HOT_SHARE = 512
PARTS = 64
LEAD = 32  # bytes of text in a splitter; comparisons read the whole text


def hot_texts(texts: DataFrame) -> DataFrame:
    """64-bit hashes that more than one row in :data:`HOT_SHARE` has: under HOT_SHARE rows.

    A collision makes a text hot that is not, which costs nothing but its splitting.
    """
    rows = texts.count()
    counts = texts.groupBy(F.xxhash64("text").alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.col("n") > 2) & (F.col("n") * HOT_SHARE > rows)).select("hash")


def mark_copies(
    docs: DataFrame, text: str = "text", key: str = "doc_id", carry: bool = True
) -> DataFrame:
    """Each row's ``key`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``;
    with ``carry`` also the row itself as a struct ``row``.

    Texts are equal when identical, byte for byte; null counts as empty. Of equal texts
    the row with the largest key stays; a null key is smaller than any other. Of rows
    that share text and key, exactly one stays. ``text_sha256`` is the digest of the text.
    An empty table gives an empty one; columns of any name may be there.
    """
    whole = packed(docs, text_of(text).alias("text"), F.col(f"`{key}`").alias("key"))
    hot = F.broadcast(hot_texts(whole.select("text")).withColumn("hot", F.lit(True)))
    dealt = (
        whole.withColumn("hash", F.xxhash64("text"))
        .join(hot, "hash", "left")
        .withColumn("part", F.when(F.col("hot"), F.pmod(F.xxhash64("key"), F.lit(PARTS))).otherwise(F.lit(0)))
    )
    dealt = dealt.withColumn("lead", F.substring(F.encode("text", "UTF-8"), 1, LEAD))
    run = Window.partitionBy("lead", "hash", "part", "text")
    in_order = run.orderBy(F.col("key").desc_nulls_last())
    runs = dealt.repartitionByRange("lead", "hash", "part").select(
        *(["row"] if carry else []),
        "key",
        "hot",
        F.row_number().over(in_order).alias("place"),
        F.first("key").over(in_order).alias("run_id"),
        F.count(F.lit(1)).over(run).alias("run_size"),
        F.sha2("text", 256).alias("text_sha256"),
    )
    # Written, as the runs of hot texts are read once more; the sort is done once.
    runs = write_through(runs, "text_runs")
    totals = (
        runs.where("hot and place = 1")
        .groupBy("text_sha256")
        .agg(F.max("run_id").alias("top"), F.sum("run_size").alias("total"))
    )
    keep_id = F.when(F.col("hot"), F.col("top")).otherwise(F.col("run_id"))
    group_size = F.when(F.col("hot"), F.col("total")).otherwise(F.col("run_size"))
    return runs.join(F.broadcast(totals), "text_sha256", "left").select(
        *(["row"] if carry else []),
        "key",
        keep_id.alias("keep_id"),
        group_size.alias("group_size"),
        ((F.col("place") == 1) & F.col("key").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each text, with all its columns."""
    return unpacked(mark_copies(docs, text, key).where("kept"), docs)


def op1_exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select("doc_id", "text")
    marked = mark_copies(docs, carry=False)
    return marked.select(F.col("key").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
with texts as (select doc_id, coalesce(text, '') as body from documents)
select doc_id,
       max(doc_id) over (partition by body) as keep_id,
       count(*) over (partition by body) as group_size,
       doc_id is not distinct from max(doc_id) over (partition by body)
         and row_number() over (partition by body, doc_id) = 1 as kept,
       sha256(body) as text_sha256
from texts
"""
