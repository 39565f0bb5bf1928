"""Category codes, indicators, scaling, product terms and moments."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators.ranks import sorted_position
from larkspur.operators.skew import lookup_join, sent_if_few
from larkspur.session import cut_lineage


def _as_category(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def fit_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): codes 0… in sorted order per column; NULL is the category ``nan``."""
    tall = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _as_category(c).alias("value")) for c in columns
    ])).alias("e")).select("e.column", "e.value").distinct()
    numbered = sorted_position(tall, ["column", "value"])
    starts = numbered.groupBy("column").agg(F.min("position").alias("start"))
    return cut_lineage(lookup_join(numbered, starts, ["column"], "inner").select(
        "column", "value", (F.col("position") - F.col("start")).cast("int").alias("code")))


def apply_dictionary(df: DataFrame, dictionary: DataFrame, columns: Sequence[str],
                     suffix: str = "_encoded", unseen: int = -1) -> DataFrame:
    """Add the code of every listed column; unseen values get ``unseen``.

    The dictionary is a stored table, so its columns are map-side joins of one
    stage wherever it is small.
    """
    out, dictionary = df, sent_if_few(dictionary)
    for c in columns:
        codes = dictionary.where(F.col("column") == c).select(
            F.col("value").alias("_value"), F.col("code").alias("_code"))
        keyed = out.withColumn("_value", _as_category(c))
        out = lookup_join(keyed, codes, ["_value"], "left").withColumn(
            f"{c}{suffix}", F.coalesce("_code", F.lit(unseen))).drop("_value", "_code")
    return out


def one_hot(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """An indicator per sorted category; the column itself goes."""
    flags = {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int")
             for v in sorted(categories)}
    return df.withColumns(flags).drop(column)


@dataclass(frozen=True)
class Scaler:
    """Means and population deviations learnt on the training part."""

    means: dict[str, float]
    scales: dict[str, float]

    @staticmethod
    def fit(train: DataFrame, columns: Sequence[str]) -> "Scaler":
        row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in columns],
                        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
        # a constant column keeps scale 1
        return Scaler({c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] or 1.0 for c in columns})

    def apply(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({
            f"{c}{suffix}": (F.col(c) - F.lit(self.means[c])) / F.lit(self.scales[c]) for c in self.means})


def poly2_columns(columns: Sequence[str]) -> dict[str, Column]:
    """Degree-2 terms without bias: each column, then every product."""
    terms = {c: F.col(c) for c in columns}
    for a, b in combinations_with_replacement(columns, 2):
        terms[f"{a}^2" if a == b else f"{a}*{b}"] = F.col(a) * F.col(b)
    return terms


def gram_moments(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Sums of x·x' and x·y in one pass, in long form (one cell per pair).

    The intercept is the constant column ``1``.
    """
    wide = {"1": F.lit(1.0)} | {c: F.col(c).cast("double") for c in features}
    wide[target] = F.col(target).cast("double")
    pairs = [(a, b) for a, b in combinations_with_replacement(wide, 2)]
    row = df.agg(*[F.sum(wide[a] * wide[b]).alias(f"{a}|{b}") for a, b in pairs])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{a}|{b}`").alias("moment"))
        for a, b in pairs])))
