"""What the operators of this subpackage share: folds, whole rows, byte words, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Arrow batches are cut by bytes as well as rows: documents may be very long.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
LOWER_CASE = bytes.maketrans(_UPPER, _LOWER)


def batches(spark: SparkSession) -> SparkSession:
    """Apply :data:`BATCH_CONF`; Python workers then hold a bounded batch."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}.parquet")


def fold(folds: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``folds``. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """The whole row as one struct ``row``, so that its names clash with nothing."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *more)


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` again, out of ``row``."""
    return df.select(*[F.col("row")[c].alias(c) for c in like.columns])


def most_frequent(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows of the largest counts, ``most`` at most: those above a power of two.

    The powers' numbers of rows are a table of 64 rows, so nothing is sorted and no task
    sees more than its share; rows of one power enter together or not at all.
    """
    level = F.floor(F.log2(F.col(column) + 1))
    sizes = dict(counts.groupBy(level.alias("level")).count().collect())
    taken, least = 0, max(sizes, default=0) + 1
    for step in sorted(sizes, reverse=True):
        taken += sizes[step]
        if taken > most:
            break
        least = step
    return counts.where(level >= least)


def table_hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bounded number."""

    def __init__(self, most: int = 400_000, of: Callable[[bytes], int] = table_hash):
        super().__init__()
        self.most, self.of = most, of

    def __missing__(self, word: bytes) -> int:
        value = self.of(word)
        if len(self) >= self.most:
            self.clear()
        self[word] = value
        return value


def lower_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased; other characters as they are."""
    return (text or "").encode().translate(LOWER_CASE).split()


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def row_text(batch: pa.RecordBatch, place: int) -> pa.Array:
    """A field of the struct ``row`` as text, null as empty: it need not be sent beside it."""
    field = pc.struct_field(batch.column(batch.schema.get_field_index("row")), [place])
    return pc.fill_null(pc.cast(field, pa.string()), "")


def append(batch: pa.RecordBatch, keep: list[str], **added: pa.Array) -> pa.RecordBatch:
    """The named columns of ``batch`` unchanged, and new ones behind them."""
    kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
    return pa.RecordBatch.from_arrays([*kept, *added.values()], names=[*keep, *added])


def map_batches(
    df: DataFrame, each: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` with a function that ``each()`` prepares once per task."""
    batches(df.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = each()
        for part in parts:
            yield work(part)

    return df.mapInArrow(run, schema)
