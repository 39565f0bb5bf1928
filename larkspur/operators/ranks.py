"""Ranks over a whole table without one task that sees all of it."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import cut_lineage


def sorted_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Number rows 0, 1, … in the order of the given columns.

    Rows are dealt into ranges. A row's number is its rank inside the range
    plus the rows of all ranges before, of which there is one count each.
    """
    parts = cut_lineage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = parts.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(
        F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return parts.withColumn("_inside", inside).join(before, "_range").withColumn(
        name, F.col("_before") + F.col("_inside")).drop("_range", "_inside", "_before")


def leading_bits(hashed: Column, bits: Column) -> Column:
    """The first ``bits`` (24 at most) of a hexadecimal text, as a number."""
    return F.call_function("shiftright", F.conv(F.substring(hashed, 1, 6), 16, 10).cast("bigint"), (F.lit(24) - bits).cast("int"))


def root_bits(n: Column) -> Column:
    """Bits that deal ``n`` hashes into about sqrt(n) bins of about sqrt(n) rows."""
    return F.least(F.lit(24), F.ceil(F.log2(F.greatest(n.cast("double"), F.lit(1.0))) / 2)).cast("int")
