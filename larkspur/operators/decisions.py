"""Scores that turn predictions into choices."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.operators.ordering import quantile_tiers


def ride_cost(base: Column, per_mile: Column, distance: Column, surge: Column) -> Column:
    """base(service) + distance x per-mile rate x surge."""
    return base + distance * per_mile * surge


def cheapest_option(scored: DataFrame, cost: str, option: str, by: Sequence[str]) -> DataFrame:
    """The cheapest option per group and what it saves against the dearest."""
    best = F.min(F.struct(F.col(cost).alias("cost"), F.col(option).alias("option")))
    return scored.groupBy(*by).agg(best.alias("_b"), F.max(cost).alias("dearest_cost")).select(
        *by, F.col("_b.option").alias("cheapest"), F.col("_b.cost").alias("cheapest_cost"),
        "dearest_cost", (F.col("dearest_cost") - F.col("_b.cost")).alias("saving"))


def investment_score(predicted: Column, income: Column, median_income: float, coastal: Column,
                     new_house: Column) -> Column:
    """Predicted value over relative income, with coastal and growth premiums."""
    relative = income / F.lit(median_income)
    return (
        F.try_divide(predicted, F.nullif(relative, F.lit(0.0)))
        * (1 + F.lit(fv.COASTAL_PREMIUM) * coastal) * (1 + F.lit(fv.GROWTH_PREMIUM) * new_house)
    )


def investment_tiers(df: DataFrame, score: str) -> DataFrame:
    """Bottom 30, 30-60, 60-90 and top 10 percent."""
    return quantile_tiers(df, score, fv.INVESTMENT_CUTS, fv.INVESTMENT_TIERS)
