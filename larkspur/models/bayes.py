"""Gaussian naive Bayes as one aggregate and one expression."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMOOTHING = 1e-9


def linear_score(features: Sequence[str], weights: Sequence[float], intercept: float) -> Column:
    """intercept + sum of weight x feature, parsed as one expression."""
    terms = [f"`{f}` * double('{float(w)!r}')" for f, w in zip(features, weights)]
    return F.expr(" + ".join([f"double('{float(intercept)!r}')", *terms]))


def arg_max(scores: dict) -> Column:
    """The class with the highest score; ties go to the first class listed."""
    best = F.array_max(F.array(*[
        F.struct(score.alias("score"), F.lit(-position).alias("order"), F.lit(c).alias("cls"))
        for position, (c, score) in enumerate(scores.items())]))
    return best["cls"]


@dataclass(frozen=True)
class GaussianBayes:
    """Per class: prior, and mean and variance of every feature."""

    features: list[str]
    classes: dict[object, tuple[float, list[float], list[float]]]

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str], label: str) -> "GaussianBayes":
        """One pass; the result has one row per class."""
        features = list(features)
        moments = [F.count("*").alias("n")]
        moments += [F.avg(f).alias(f"m{i}") for i, f in enumerate(features)]
        moments += [F.var_pop(f).alias(f"v{i}") for i, f in enumerate(features)]
        rows = train.groupBy(label).agg(*moments).orderBy(label).collect()
        total = sum(r["n"] for r in rows)
        # widest overall variance, from the class moments
        spread = []
        for i in range(len(features)):
            mean = sum(r["n"] * r[f"m{i}"] for r in rows) / total
            spread.append(sum(r["n"] * (r[f"v{i}"] + (r[f"m{i}"] - mean) ** 2) for r in rows) / total)
        floor = SMOOTHING * max(spread)
        return GaussianBayes(features, {
            r[label]: (r["n"] / total, [r[f"m{i}"] for i in range(len(features))],
                       [r[f"v{i}"] + floor for i in range(len(features))]) for r in rows})

    def priors(self) -> dict[object, float]:
        return {c: prior for c, (prior, _, _) in self.classes.items()}

    def scores(self) -> dict[object, Column]:
        """Log prior plus log likelihood, per class."""
        out = {}
        for c, (prior, means, variances) in self.classes.items():
            constant = math.log(prior) - 0.5 * sum(math.log(2 * math.pi * v) for v in variances)
            terms = [f"(`{f}` - double('{m!r}')) * (`{f}` - double('{m!r}')) / double('{2 * v!r}')"
                     for f, m, v in zip(self.features, means, variances)]
            out[c] = F.lit(constant) - F.expr(" + ".join(terms))
        return out

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, arg_max(self.scores()))
