"""Many models over several feature sets, into one results table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.models import linear, trees
from larkspur.models.bayes import GaussianBayes
from larkspur.models.discriminant import Discriminant
from larkspur.models.perceptron import Perceptron
from larkspur.operators import evaluation
from larkspur.operators.encoding import Scaler
from larkspur.session import cut_lineage, spread

REG_METRICS = ["r2", "mae", "mse", "rmse"]
CLF_METRICS = ["accuracy", "f1", "precision", "recall"]


@dataclass(frozen=True)
class Model:
    """How to fit a model, and whether it wants standardised features."""

    fit: Callable
    scaled: bool = True


def regressors(poly: Sequence[str] | None = None, alpha: float = 0.1) -> dict[str, Model]:
    """The five regressors; each fits (train, features, label).

    Without a column list the polynomial model takes the five features with
    the largest ridge coefficients.
    """
    def polynomial(train, features, label):
        columns = [c for c in poly or [] if c in features][:5]
        if not columns:
            scaler = Scaler.fit(train, features)
            weights = linear.fit_ridge(scaler.apply(train), features, label).coefficients()
            columns = sorted(weights, key=lambda f: -abs(weights[f]))[:5]
        return linear.fit_poly_ridge(train, columns, label)

    return {
        "OLS": Model(linear.fit_ols), "Ridge": Model(linear.fit_ridge),
        "Lasso": Model(lambda t, f, y: linear.fit_lasso(t, f, y, alpha)),
        "Decision Tree": Model(trees.fit_tree_regressor, scaled=False),
        "Polynomial": Model(polynomial, scaled=False),
    }


def classifiers(key: str, partitions: int = 8) -> dict[str, Model]:
    """The five classifiers; ``partitions`` are the perceptron's mixing parts, which its weights depend on."""
    return {
        "Logistic Reg": Model(linear.fit_logistic),
        "Decision Tree": Model(trees.fit_tree_classifier, scaled=False),
        "Naive Bayes": Model(GaussianBayes.fit), "LDA": Model(Discriminant.fit),
        "Perceptron": Model(lambda t, f, y: Perceptron.fit(t, f, y, key, partitions)),
    }


def train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(~F.col("is_test")), df.where(F.col("is_test"))


def score_regression(fit, test: DataFrame, label: str) -> dict[str, float]:
    row = evaluation.regression_metrics(fit.transform(test), label, "prediction").first()
    return {m: row[m] for m in REG_METRICS}


def score_binary(fit, test: DataFrame, label: str) -> dict[str, float]:
    row = evaluation.binary_metrics(fit.transform(test), label, "prediction").first()
    return {m: row[m] for m in CLF_METRICS}


def run_grid(df: DataFrame, feature_sets: dict[str, Sequence[str]], label: str, models: dict[str, Model],
             score: Callable, metrics: Sequence[str], threads: int = 4) -> DataFrame:
    """Fit every model on every feature set; one row each.

    ``df`` carries ``is_test``. The driver only submits jobs: fits run side by
    side on the cluster and share one cached table. Scaling is a projection
    over it, with constants learnt on the train part.
    """
    rows = []
    used = dict.fromkeys(f for features in feature_sets.values() for f in features)
    keys = [c for c in df.columns if c in (label, "is_test") or c.endswith("_id")]
    table = spread(cut_lineage(df.select(*dict.fromkeys([*keys, *used])))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, features in feature_sets.items():
            features = list(features)
            raw = train_test(table)
            scaler = Scaler.fit(raw[0], features)
            scaled = tuple(scaler.apply(part) for part in raw)

            def one(item):
                model, how = item
                train, test = scaled if how.scaled else raw
                result = score(how.fit(train, features, label), test, label)
                return (name, model, len(features), *[
                    None if result[m] is None else float(result[m]) for m in metrics])

            with ThreadPoolExecutor(threads) as pool:
                rows += list(pool.map(one, models.items()))
    finally:
        table.unpersist()
    columns = ", ".join(f"{m} double" for m in metrics)
    return df.sparkSession.createDataFrame(
        rows, f"feature_set string, model string, n_features int, {columns}")


def importance_report(spark, values: dict[str, float], enrichment: Sequence[str], k: int = 5) -> DataFrame:
    """Top features by absolute value, marked when they come from enrichment."""
    from larkspur.operators.ordering import top_k_abs
    table = linear.report(spark, values, "importance")
    return top_k_abs(table, "importance", "feature", k).withColumn(
        "is_enrichment", F.col("feature").isin(list(enrichment)).cast("int"))
