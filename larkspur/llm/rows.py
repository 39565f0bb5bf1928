"""Decisions about documents brought back to their whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import bitmap

KEY, MAY = "__key_of_text", "__may_be_marked"


def keyed(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """``documents`` with ``KEY``, the hash of the text."""
    return documents.withColumn(KEY, F.xxhash64(F.col(text_col).cast("string")))


def _same(id_col: str):
    return F.col(f"d.{id_col}").eqNullSafe(F.col("m.id")) & (F.col(f"d.{KEY}") == F.col("m.key"))


def keep(documents: DataFrame, chosen: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``documents`` for each (id, key) in ``chosen``."""
    met = keyed(documents, text_col).alias("d").join(chosen.select("id", "key").alias("m"), _same(id_col)).select("d.*")
    return met.dropDuplicates([id_col, KEY]).drop(KEY)


def drop(documents: DataFrame, marked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` without the rows whose (id, key) is in ``marked``, which should be checkpointed.

    A bitmap keeps rows that cannot be marked out of the shuffle.
    """
    rows = bitmap.mark(keyed(documents, text_col), KEY, bitmap.words(marked, "key"), MAY)
    left = rows.where(F.col(MAY)).alias("d").join(
        marked.select("id", "key").distinct().alias("m"), _same(id_col), "left_anti")
    return rows.where(~F.col(MAY)).unionByName(left.select("d.*")).drop(KEY, MAY)


def meet(documents: DataFrame, marked: DataFrame, column: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with ``column`` of ``marked`` (id, key, column), null where there is none; one row a row."""
    rows = bitmap.mark(keyed(documents, text_col), KEY, bitmap.words(marked, "key"), MAY)
    one = marked.select("id", "key", column).dropDuplicates(["id", "key"]).alias("m")
    left = rows.where(F.col(MAY)).alias("d").join(one, _same(id_col), "left").select("d.*", F.col(f"m.{column}").alias(column))
    kind = dict(marked.dtypes)[column]
    return rows.where(~F.col(MAY)).withColumn(column, F.lit(None).cast(kind)).unionByName(left).drop(KEY, MAY)
