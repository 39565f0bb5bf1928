"""Linear discriminant analysis: class means and one pooled covariance."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.models.bayes import arg_max, linear_score
from larkspur.models.linear import VECTOR, assemble


def class_moments(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Rows and feature means per class."""
    return df.groupBy(label).agg(
        F.count("*").alias("n"), *[F.avg(f).alias(f"mean_{f}") for f in features]).orderBy(label)


def pooled_covariance(df: DataFrame, features: Sequence[str], label: str,
                      means: dict[object, list[float]]) -> np.ndarray:
    """Within-class covariance over n - k, read back as its p x p cells.

    Class means are taken out of every row first, so the sums stay well
    scaled; then one pass of matrix sums.
    """
    # one array of means per class, in feature order
    pairs = [x for c, m in means.items() for x in (F.lit(c), F.array(*[F.lit(v) for v in m]))]
    own = df.withColumn("_means", F.try_element_at(F.create_map(*pairs), F.col(label)))
    centred = own.select([(F.col(f) - F.get("_means", F.lit(i))).alias(f) for i, f in enumerate(features)])
    row = centred.agg(F.count("*").alias("n"), *[
        F.stddev_pop(f).alias(f"s{i}") for i, f in enumerate(features)]).first()
    corr = Correlation.corr(assemble(centred, features).select(VECTOR), VECTOR).first()[0].toArray()
    scale = np.array([row[f"s{i}"] for i in range(len(features))])
    n, k = row["n"], len(means)
    return np.nan_to_num(corr) * np.outer(scale, scale) * n / max(n - k, 1)


@dataclass(frozen=True)
class Discriminant:
    """Linear scores per class: intercept and one weight per feature."""

    features: list[str]
    weights: dict[object, tuple[float, list[float]]]

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str], label: str) -> "Discriminant":
        features = list(features)
        rows = class_moments(train, features, label).collect()
        means = {r[label]: [r[f"mean_{f}"] for f in features] for r in rows}
        total = sum(r["n"] for r in rows)
        inverse = np.linalg.pinv(pooled_covariance(train, features, label, means))
        weights = {}
        for r in rows:
            mu = np.array(means[r[label]])
            w = inverse @ mu
            weights[r[label]] = (float(-0.5 * mu @ w + math.log(r["n"] / total)), [float(x) for x in w])
        return Discriminant(features, weights)

    def scores(self) -> dict[object, Column]:
        return {c: linear_score(self.features, weights, intercept)
                for c, (intercept, weights) in self.weights.items()}

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, arg_max(self.scores()))

    def coefficients(self) -> dict[str, float]:
        """For two classes, the weights of the second against the first."""
        first, second = list(self.weights.values())[:2]
        return {f: b - a for f, a, b in zip(self.features, first[1], second[1])}
