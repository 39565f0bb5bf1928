"""Sorted reports, top-k, rankings and tiers."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.functions.distance import label_of, tier_of
from larkspur.operators.quantiles import quantile_values


def head_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_k_abs(df: DataFrame, value: str, name: str, k: int = 5) -> DataFrame:
    """The k rows with the largest absolute value; ties by name."""
    return df.where(F.col(value).isNotNull()).orderBy(F.abs(F.col(value)).desc(), name).limit(k)


def extremes(df: DataFrame, value: str, key: str, k: int = 3) -> DataFrame:
    """The k smallest and the k largest rows."""
    known = df.where(F.col(value).isNotNull())
    low = known.orderBy(F.asc(value), key).limit(k).withColumn("side", F.lit("low"))
    high = known.orderBy(F.desc(value), key).limit(k).withColumn("side", F.lit("high"))
    return low.unionByName(high)


def distinct_pairs(df: DataFrame, value: str, code: str) -> DataFrame:
    return df.select(value, code).distinct().orderBy(code, value)


def best_of(df: DataFrame, metric: str, name: str, by: Sequence[str] = (),
            highest: bool = True) -> DataFrame:
    """The best row of each group; ties go to the first name.

    An aggregate over one struct per row: nothing is sorted.
    """
    key = F.col(metric) if not highest else -F.col(metric)
    rest = [c for c in df.columns if c not in (*by, metric, name)]
    best = F.min(F.struct(key.alias("_k"), F.col(name), F.col(metric), *rest))
    out = df.where(F.col(metric).isNotNull()).groupBy(*by).agg(best.alias("_b"))
    return out.select(*by, f"_b.{name}", f"_b.{metric}", *[f"_b.{c}" for c in rest])


def leaderboard(df: DataFrame, metric: str, by: Sequence[str]) -> DataFrame:
    """Rank within each task. A task has one row per model."""
    place = F.rank().over(Window.partitionBy(*by).orderBy(F.desc(metric)))
    return df.withColumn("place", place)


def week_over_week(weekly: DataFrame, week: str, price: str, high: float = 3.0,
                   by: Sequence[str] = ()) -> DataFrame:
    """Change against the week before, and a high-price flag.

    One row per week: the length is bounded by the calendar.
    """
    series = Window.partitionBy(*(by or [F.lit(0)])).orderBy(week)
    return weekly.withColumn("price_change", F.col(price) - F.lag(price).over(series)) \
        .withColumn("is_high_price", (F.col(price) > high).cast("int"))


def quantile_tiers(df: DataFrame, value: str, probs: Sequence[float] = (0.25, 0.5, 0.75),
                   names: Sequence[str] = tuple(fv.TIER_NAMES)) -> DataFrame:
    """Class by quantile cuts, with its name."""
    cuts = quantile_values(df, value, probs)
    tier = tier_of(F.col(value), cuts) if None not in cuts else F.lit(None).cast("int")
    return df.withColumn("tier", tier).withColumn("tier_name", label_of(F.col("tier"), list(names)))


def tier_summary(df: DataFrame, value: str, total: int | None = None) -> DataFrame:
    """Rows, share and range per tier."""
    n = df.count() if total is None else total
    return df.groupBy("tier", "tier_name").agg(
        F.count("*").alias("n"), (F.count("*") / F.lit(max(n, 1))).alias("share"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def above_median(df: DataFrame, value: str) -> Column:
    """1 where the value exceeds the whole-table median."""
    median = quantile_values(df, value, [0.5])[0]
    return F.when(F.col(value).isNotNull(), (F.col(value) > F.lit(median)).cast("int"))
