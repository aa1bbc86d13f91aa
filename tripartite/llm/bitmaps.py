"""Bitmaps of fixed size that keep rows out of a shuffle. They decide nothing: a value
that is in the set always passes, another one passes now and then, and a join follows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24  # 2**24 bits, 2 MB


def slot(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << BITS))


def bitmap(values: DataFrame, *columns: str) -> np.ndarray:
    """A bit for the hash of each value, collected as at most 2**(BITS - 6) numbers."""
    parts = (
        values.select(slot(*columns).alias("slot"))
        .groupBy(F.expr("slot div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(slot % 64))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[parts["word"].to_numpy()] = parts["bits"].to_numpy()
    return out.view(np.uint64)


def has(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1) == 1
