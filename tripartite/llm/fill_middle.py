"""Fill-in-the-middle: documents cut in three at line ends and put in another order.

Where the cuts lie follows from the document's id. A text is divided into blocks of a fixed
number of code points, and a Fenwick tree over the blocks holds how many lines end in each
and how many code points it has. Binary lifting goes down the tree to the block in which a
given line ends, and the end is then looked for in that block alone.

A document never meets another, so the work is a narrow map over batches. Putting a text
together again (:func:`restored`) is plain SQL on the output and its form.

Null text counts as empty; an empty text, or one that holds a marker, stays as it is, form
``plain``; a null id counts as empty text; repeated rows are cut alike; an empty table gives
an empty one; columns of any name may be there.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tripartite.llm.common import append, map_batches, packed, read, text_column, text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
RATE = 100  # in a hundred documents
SUFFIX_FIRST = 50  # in a hundred that are cut
BLOCK = 4096  # code points


class LineTree:
    """Lines of a text by a Fenwick tree over its blocks: ``lines[i]`` and ``points[i]`` are
    sums over the blocks that end with block ``i`` (from 1) and begin where the lowest set
    bit of ``i`` says."""

    def __init__(self, text: str, block: int = BLOCK):
        self.text, self.block = text, block
        count = -(-len(text) // block)
        self.lines, self.points = [0] * (count + 1), [0] * (count + 1)
        for i in range(1, count + 1):
            start = (i - 1) * block
            stop = min(start + block, len(text))
            self.lines[i] += text.count("\n", start, stop)
            self.points[i] += stop - start
            above = i + (i & -i)
            if above <= count:
                self.lines[above] += self.lines[i]
                self.points[above] += self.points[i]
        self.highest = 1 << max(count.bit_length() - 1, 0)
        # What follows the last line feed is a line as well.
        self.closed = text.count("\n")
        self.total = self.closed + (bool(text) and not text.endswith("\n"))

    def end(self, line: int) -> int:
        """Code points up to the end of the ``line``-th line, its line feed included."""
        if line <= 0:
            return 0
        if line > self.closed:
            return len(self.text)
        # The last block before which fewer than ``line`` lines have ended.
        block, ended, passed, step = 0, 0, 0, self.highest
        while step:
            ahead = block + step
            if ahead < len(self.lines) and ended + self.lines[ahead] < line:
                block, ended, passed = ahead, ended + self.lines[ahead], passed + self.points[ahead]
            step >>= 1
        at = passed - 1
        for _ in range(line - ended):
            at = self.text.index("\n", at + 1)
        return at + 1


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits that belong to a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def cut(
    text: str, drawn: list[int], rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> tuple[int, str, int | None, int | None, str]:
    """Lines, form, code points of prefix and middle, and the output."""
    tree = LineTree(text)
    lines = tree.total
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or drawn[2] % 100 >= rate:
        return lines, "plain", None, None, text
    first, second = sorted(draw % (lines + 1) for draw in drawn[:2])
    start, stop = tree.end(first), tree.end(second)
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    if drawn[3] % 100 < suffix_first:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return lines, form, len(prefix), len(middle), output


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """Each row as a struct ``row`` with ``n`` (lines), ``form``, ``prefix_chars``,
    ``middle_chars`` (null where the form is plain) and ``output``."""
    whole = packed(docs, F.col(f"`{key}`").cast("string").alias("key"), text_of(f"`{text}`").alias("whole"))
    schema = StructType([
        whole.schema["row"], StructField("n", LongType()), StructField("form", StringType()),
        StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
        StructField("output", StringType()),
    ])

    def each():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [
                cut(whole, draws(key, seed), rate, suffix_first)
                for key, whole in zip(text_column(batch, "key"), text_column(batch, "whole"), strict=True)
            ]
            columns = list(zip(*made, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
            return append(batch, ["row"], **dict(zip(schema.names[1:], arrays, strict=True)))

        return work

    return map_batches(whole, each, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made of. The markers occur once each in it."""

    def part(after: str, before: str | None = None) -> Column:
        rest = F.split_part(output, F.lit(after), F.lit(2))
        return rest if before is None else F.split_part(rest, F.lit(before), F.lit(1))

    return (
        F.when(form == "psm", F.concat(part(PREFIX, SUFFIX), part(MIDDLE), part(SUFFIX, MIDDLE)))
        .when(form == "spm", F.concat(part(PREFIX, MIDDLE), part(MIDDLE), part(SUFFIX, PREFIX)))
        .otherwise(output)
    )


def op12_fill_middle(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select("doc_id", "text")
    made = transform(docs)
    return made.select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE = """
WITH lined AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
         sha256('7:' || doc_id) AS h
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM lined),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:i], '') AS p, array_to_string(units[i + 1:j], '') AS m,
         array_to_string(units[j + 1:], '') AS s
  FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
