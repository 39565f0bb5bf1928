"""A bitmap of hashes whose size does not depend on the data.

It lets a scan pass over rows that cannot match before they are shuffled. Too
many hashes only make it less selective; the join after it stays exact. The
driver gets at most ``BITS / 64`` rows, the broadcast is ``BITS / 8`` bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 22


def slot(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 42)


def words(df: DataFrame, column: str) -> DataFrame:
    """(word, bits): bit ``h >>> 42`` is set for each non-null hash; at most ``BITS / 64`` rows."""
    at = df.where(F.col(column).isNotNull()).select(slot(F.col(column)).alias("_at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_at") % 64).cast("int"))
    return at.groupBy(F.shiftright("_at", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def build(df: DataFrame, column: str) -> np.ndarray:
    """The bitmap as an array, for use in tasks."""
    out = np.zeros(BITS // 64, np.int64)
    found = words(df, column).toArrow()
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def contains(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.view(np.uint64) >> np.uint64(42)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def mark(rows: DataFrame, column: str, bitmap: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``: whether the hash may be in the bitmap, given as :func:`words`.

    The broadcast side has at most ``BITS / 64`` rows of 16 bytes.
    """
    at = slot(F.col(column))
    met = rows.withColumn("_word", F.shiftright(at, 6)).join(
        F.broadcast(bitmap.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))), "_word", "left")
    return met.withColumn(name, F.getbit(F.coalesce("_bits", F.lit(0)), (at % 64).cast("int")) == 1).drop("_word", "_bits")
