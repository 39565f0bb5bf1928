"""Trees, forests and boosted trees on unscaled features."""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.models import grower
from larkspur.models.linear import VECTOR, Fit, assemble

SEED = 42
BINS = 64
#: Levels up to which MLlib grows a single tree. Each of its tasks sends the sums of every node of a level; below, rows of small nodes are brought together instead.
DEEP = 10


def _fit(estimator, train: DataFrame, features: Sequence[str]) -> Fit:
    return Fit(estimator.fit(assemble(train, features)), list(features))


def fit_tree_regressor(train: DataFrame, features: Sequence[str], label: str, depth: int = 10) -> Fit | grower.TreeModel:
    if depth > DEEP:
        return fit_grown_regressor(train, features, label, depth)
    return _fit(DecisionTreeRegressor(featuresCol=VECTOR, labelCol=label, maxDepth=depth, maxBins=BINS, seed=SEED),
                train, features)


def fit_tree_classifier(train: DataFrame, features: Sequence[str], label: str, depth: int = 10) -> Fit | grower.TreeModel:
    """Labels are 0 ... classes - 1, as MLlib has them."""
    if depth > DEEP:
        return fit_grown_classifier(train, features, label, depth, max(2, int(train.agg(F.max(label)).first()[0] or 0) + 1))
    return _fit(DecisionTreeClassifier(featuresCol=VECTOR, labelCol=label, maxDepth=depth, maxBins=BINS, seed=SEED),
                train, features)


def _key(train: DataFrame) -> str | None:
    """The column that tells rows apart in a bootstrap."""
    return next((c for c in train.columns if c.endswith("_id")), None)


def fit_grown_regressor(train: DataFrame, features: Sequence[str], label: str, depth: int = 10) -> grower.TreeModel:
    """One tree by the histogram grower: whole-number labels give the very tree that SQL finds."""
    return grower.fit_forest(train, features, label, grower.Rule(depth), 1, bootstrapped=False)


def fit_grown_classifier(train: DataFrame, features: Sequence[str], label: str, depth: int = 10, classes: int = 2) -> grower.TreeModel:
    return grower.fit_forest(train, features, label, grower.Rule(depth), 1, classes, bootstrapped=False)


def fit_forest_regressor(train: DataFrame, features: Sequence[str], label: str, trees: int = 50,
                         depth: int = 20) -> grower.TreeModel:
    return grower.fit_forest(train, features, label, grower.Rule(depth), trees, key=_key(train))


def fit_forest_classifier(train: DataFrame, features: Sequence[str], label: str, trees: int = 50, depth: int = 20,
                          weight: str | None = None, classes: int | None = None) -> grower.TreeModel:
    """Nodes choose from sqrt(p) features. Labels are 0 ... classes - 1; by default the largest label is the last class."""
    if classes is None:
        classes = int(train.agg(F.max(label)).first()[0] or 0) + 1
    rule = grower.Rule(depth, least=1e-12, subset=max(1, round(len(features) ** 0.5)))
    return grower.fit_forest(train, features, label, rule, trees, max(2, classes), _key(train), weight)


def fit_boosted_regressor(train: DataFrame, features: Sequence[str], label: str, rounds: int = 100,
                          depth: int = 6, rate: float = 0.1, ridge: float = 1.0) -> grower.TreeModel:
    """Second-order boosting of the squared loss with a regularised gain."""
    return grower.fit_boosting(train, features, label, grower.Rule(depth, 1.0, ridge), rounds, rate)


def fit_boosted_classifier(train: DataFrame, features: Sequence[str], label: str, rounds: int = 100, depth: int = 6,
                           rate: float = 0.1, positive_weight: float = 10.0, ridge: float = 1.0) -> grower.TreeModel:
    """Second-order boosting of the logistic loss with a heavier positive class."""
    weighted = train.withColumn("_weight", F.when(F.col(label) == 1, positive_weight).otherwise(1.0))
    return grower.fit_boosting(weighted, features, label, grower.Rule(depth, 1.0, ridge), rounds, rate, 2, "_weight")


def balanced_weight(df: DataFrame, label: str) -> Column:
    """n / (k n_c) for each class, as an expression over the class counts."""
    rows = df.groupBy(label).agg(F.count("*").alias("n")).collect()
    total, classes = sum(r["n"] for r in rows), len(rows)
    pairs = [F.lit(x) for r in rows for x in (r[label], total / (classes * r["n"]))]
    return F.try_element_at(F.create_map(*pairs), F.col(label))


def importances(fit: Fit | grower.TreeModel) -> dict[str, float]:
    values = fit.model.featureImportances
    return dict(zip(fit.features, (float(v) for v in (values if isinstance(values, np.ndarray) else values.toArray()))))
