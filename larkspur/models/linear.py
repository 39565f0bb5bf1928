"""Linear regressors and logistic classifiers, with exact parameter mappings.

MLlib divides the squared loss by n and scales by the label's deviation, so a
penalty written for the plain sum of squares has to be converted.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.encoding import poly2_columns

VECTOR = "features"


def assemble(df: DataFrame, features: Sequence[str], output: str = VECTOR) -> DataFrame:
    """Columns to one vector, in list order; NULL and NaN are errors."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error").transform(df)


@dataclass
class Fit:
    """A fitted model with the feature names behind its vector."""

    model: object
    features: list[str]
    prepare: object = None

    def transform(self, df: DataFrame) -> DataFrame:
        ready = df if self.prepare is None else self.prepare(df)
        return self.model.transform(assemble(ready, self.features)).drop(VECTOR)

    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.features, (float(c) for c in self.model.coefficients)))


def independent_columns(df: DataFrame, features: Sequence[str], tolerance: float = 1e-8) -> list[str]:
    """Features that are neither constant nor a combination of earlier ones.

    One pass for the correlation matrix; the elimination runs on its k x k
    cells.
    """
    matrix = Correlation.corr(assemble(df, features).select(VECTOR), VECTOR).first()[0].toArray()
    kept: list[int] = []
    for j in range(len(features)):
        column = matrix[:, j]
        if np.isnan(column[[i for i in range(len(features)) if i != j]]).all() and len(features) > 1:
            continue
        if kept:
            block = matrix[np.ix_(kept, kept)]
            mixed = matrix[kept, j]
            if 1.0 - mixed @ np.linalg.solve(block, mixed) < tolerance:
                continue
        kept.append(j)
    return [features[j] for j in kept]


def fit_ols(train: DataFrame, features: Sequence[str], label: str) -> Fit:
    """Least squares with p-values; aliased columns are left out first."""
    used = independent_columns(train, features)
    estimator = LinearRegression(featuresCol=VECTOR, labelCol=label, regParam=0.0, solver="normal")
    return Fit(estimator.fit(assemble(train, used)), used)


def p_values(fit: Fit) -> dict[str, float]:
    """Two-sided p-values of the coefficients, without the intercept's."""
    return dict(zip(fit.features, fit.model.summary.pValues))


def fit_ridge(train: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0) -> Fit:
    """Minimises sum of squares + alpha |w|²."""
    row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    estimator = LinearRegression(
        featuresCol=VECTOR, labelCol=label, regParam=alpha * (row["s"] or 1.0) / max(row["n"], 1),
        elasticNetParam=0.0, standardization=False, solver="normal")
    return Fit(estimator.fit(assemble(train, features)), list(features))


@dataclass
class MomentFit:
    """A linear model found from moments alone."""

    features: list[str]
    weights: dict[str, float]
    intercept: float

    @property
    def model(self) -> "MomentFit":
        """Itself, as other fits name their parameters ``fit.model.intercept``."""
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        terms = [F.lit(w) * F.col(f) for f, w in self.weights.items() if w]
        return df.withColumn("prediction", sum(terms, F.lit(self.intercept)))

    def coefficients(self) -> dict[str, float]:
        return dict(self.weights)


def fit_lasso(train: DataFrame, features: Sequence[str], label: str, alpha: float = 0.1,
              max_sweeps: int = 100_000, tolerance: float = 1e-12) -> MomentFit:
    """Minimises half the mean square + alpha |w|.

    Means and the matrix of mean products are all the data it needs: two
    passes, then coordinate descent on p x p cells.
    """
    features = list(features)
    row = train.agg(F.avg(label).alias("y"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)]).first()
    means = [row[f"m{i}"] or 0.0 for i in range(len(features))]
    centred = [F.col(f) - F.lit(m) for f, m in zip(features, means)] + [F.col(label) - F.lit(row["y"] or 0.0)]
    p = len(features)
    ready = train.select(*[c.alias(f"c{i}") for i, c in enumerate(centred)])
    # one short aggregate a row of the matrix; all of them read the stored columns in one job
    rows = None
    for i in range(p):
        sums = ready.agg(*[F.avg(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"a{j}") for j in range(i, p + 1)])
        line = sums.select(F.lit(i).alias("i"), F.array(*[F.col(f"a{j}") for j in range(i, p + 1)]).alias("a"))
        rows = line if rows is None else rows.unionByName(line)
    matrix, cross = np.zeros((p, p)), np.zeros(p)
    for r in rows.collect():
        values = [v or 0.0 for v in r["a"]]
        matrix[r["i"], r["i"]:] = matrix[r["i"]:, r["i"]] = values[:-1]
        cross[r["i"]] = values[-1]
    w = np.zeros(p)
    for _ in range(max_sweeps):
        moved = 0.0
        for i in range(p):
            if matrix[i, i] > 0:
                pull = cross[i] - matrix[i] @ w + matrix[i, i] * w[i]
                new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / matrix[i, i]
                moved, w[i] = max(moved, abs(new - w[i])), new
        if moved < tolerance:
            break
    return MomentFit(features, dict(zip(features, w.tolist())), float((row["y"] or 0.0) - w @ np.array(means)))


def selected(fit: Fit, threshold: float = 0.001) -> dict[str, float]:
    """Coefficients a lasso kept."""
    return {f: c for f, c in fit.coefficients().items() if abs(c) > threshold}


def fit_poly_ridge(train: DataFrame, columns: Sequence[str], label: str, alpha: float = 1.0) -> Fit:
    """Degree-2 terms of a few columns, then ridge."""
    terms = poly2_columns(columns)
    safe = {n: n.replace("^", "_pow_").replace("*", "_x_") for n in terms}
    prepare = lambda df: df.withColumns({safe[n]: c for n, c in terms.items() if n not in columns})
    fit = fit_ridge(prepare(train), [safe[n] for n in terms], label, alpha)
    return Fit(fit.model, fit.features, prepare)


def fit_plain(train: DataFrame, features: Sequence[str], label: str) -> Fit:
    """Unscaled linear regression; a singular design falls back to iteration."""
    estimator = LinearRegression(featuresCol=VECTOR, labelCol=label, regParam=0.0, standardization=False)
    return Fit(estimator.fit(assemble(train, features)), list(features))


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, c: float = 1.0,
                 multiclass: bool = False) -> Fit:
    """Logistic loss + |w|² / 2C, by default C = 1."""
    n = train.count()
    estimator = LogisticRegression(
        featuresCol=VECTOR, labelCol=label, regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0,
        standardization=False, maxIter=1000, family="multinomial" if multiclass else "auto")
    return Fit(estimator.fit(assemble(train, features)), list(features))


def odds_ratios(fit: Fit) -> list[tuple[str, float, float, str]]:
    """(feature, coefficient, exp(coefficient), direction)."""
    return [(f, c, float(np.exp(c)), "up" if c > 0 else "down") for f, c in fit.coefficients().items()]


def report(spark: SparkSession, values: dict[str, float], name: str = "coefficient") -> DataFrame:
    """Feature names and values as a table."""
    return spark.createDataFrame([(f, float(v)) for f, v in values.items()], f"feature string, {name} double")
