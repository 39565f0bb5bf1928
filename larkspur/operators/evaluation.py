"""Model quality over a prediction table, for the whole or per segment.

Every function aggregates, so a segment of any size is combined on the map
side; ``by=[]`` is the whole table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.operators.ordering import extremes


def _ratio(top: Column, bottom: Column) -> Column:
    """Division where nothing over nothing counts as 0."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Metrics over the rows that have both a label and a prediction."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = df.where(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"), F.var_pop(y).alias("_v"))
    return sums.select(
        *by, "n", (1 - F.try_divide("mse", F.nullif("_v", F.lit(0.0)))).alias("r2"), "mae", "mse",
        F.sqrt("mse").alias("rmse"))


def _cells(label: str, prediction: str) -> dict[str, Column]:
    y, p = F.col(label), F.col(prediction)
    return {
        "tp": F.count_if((y == 1) & (p == 1)), "fp": F.count_if((y == 0) & (p == 1)),
        "fn": F.count_if((y == 1) & (p == 0)), "tn": F.count_if((y == 0) & (p == 0)),
    }


def binary_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    counts = df.groupBy(*by).agg(*[c.alias(n) for n, c in _cells(label, prediction).items()])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by, (tp + fp + fn + tn).alias("n"),
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """TN, FP, FN, TP and the specificity of a 0/1 prediction."""
    counts = df.groupBy(*by).agg(*[c.alias(n) for n, c in _cells(label, prediction).items()])
    return counts.select(*by, "tn", "fp", "fn", "tp",
                         _ratio(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"))


def class_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Hits, predictions and support per class, from one count of pairs."""
    pairs = df.groupBy(*by, F.col(label).alias("_y"), F.col(prediction).alias("_p")).agg(
        F.count("*").alias("_n"))
    sides = pairs.select(*by, "_n", F.inline(F.array(
        F.struct(F.col("_y").alias("cls"), F.lit(1).alias("_is_y"), (F.col("_y") == F.col("_p")).alias("_hit")),
        F.struct(F.col("_p").alias("cls"), F.lit(0).alias("_is_y"), F.lit(False).alias("_hit")))))
    total = lambda cond: F.sum(F.when(cond, F.col("_n")).otherwise(0))
    return sides.groupBy(*by, "cls").agg(
        total(F.col("_hit")).alias("hits"), total(F.col("_is_y") == 0).alias("predicted"),
        total(F.col("_is_y") == 1).alias("support"))


def class_scores(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    h, p, s = F.col("hits"), F.col("predicted"), F.col("support")
    return class_counts(df, label, prediction, by).select(
        *by, "cls", "hits", _ratio(h, p).alias("precision"), _ratio(h, s).alias("recall"),
        _ratio(2 * h, p + s).alias("f1"), "support")


def averaged_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, support-weighted precision/recall/F1, and macro F1."""
    n = F.sum("support")
    weighted = lambda c: _ratio(F.sum(F.col(c) * F.col("support")), n)
    return class_scores(df, label, prediction, by).groupBy(*by).agg(
        n.alias("n"), _ratio(F.sum("hits"), n).alias("accuracy"),
        weighted("precision").alias("precision_weighted"), weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"), F.avg("f1").alias("f1_macro"))


def classification_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Scores per class, then their plain and support-weighted means."""
    scores = class_scores(df, label, prediction, by)
    names = ("precision", "recall", "f1")
    plain = scores.select(*by, F.col("cls").cast("string").alias("row_name"), *names, "support")
    macro = scores.groupBy(*by).agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = scores.groupBy(*by).agg(
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"))
    return plain.unionByName(macro.withColumn("row_name", F.lit("macro avg"))) \
        .unionByName(weighted.withColumn("row_name", F.lit("weighted avg")))


def residual_summary(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    r = F.col(label) - F.col(prediction)
    return df.groupBy(*by).agg(
        F.count(r).alias("n"), F.avg(r).alias("mean_residual"), F.stddev_samp(r).alias("std_residual"),
        F.avg(F.abs(r)).alias("mean_abs_residual"), F.min(r).alias("min_residual"),
        F.max(r).alias("max_residual"))


def extreme_residuals(df: DataFrame, key: str, label: str, prediction: str, k: int = 3) -> DataFrame:
    residuals = df.select(key, label, prediction, (F.col(label) - F.col(prediction)).alias("residual"))
    return extremes(residuals, "residual", key, k)


def metric_delta(pairs: DataFrame, metric: str, band: float = fv.DELTA_BAND,
                 lower_is_better: bool = False) -> DataFrame:
    """Change from base to enriched, in points and percent, with a status."""
    base, enriched = F.col(f"base_{metric}"), F.col(f"enriched_{metric}")
    delta = enriched - base
    gain = -delta if lower_is_better else delta
    return pairs.withColumn("delta", delta).withColumn(
        "pct_change", F.try_divide(delta, F.nullif(F.abs(base), F.lit(0.0))) * 100).withColumn(
        "status", F.when(gain > band, "better").when(gain < -band, "worse").when(gain.isNotNull(), "same"))


def improvement_summary(deltas: DataFrame, metric: str, by: Sequence[str]) -> DataFrame:
    """Models improved and mean values before and after, per dataset or segment."""
    return deltas.groupBy(*by).agg(
        F.count("*").alias("n_models"), F.count_if(F.col("status") == "better").alias("n_better"),
        F.avg(f"base_{metric}").alias("mean_base"), F.avg(f"enriched_{metric}").alias("mean_enriched"),
        F.avg("pct_change").alias("mean_pct_change"))


def verdicts(measured: DataFrame, recorded: dict[str, float], name: str, value: str,
             band: float = fv.VERDICT_BAND) -> DataFrame:
    """Each measured figure against its recorded constant, with the wins."""
    pairs = [F.lit(x) for pair in recorded.items() for x in pair]
    known = F.try_element_at(F.create_map(*pairs), F.col(name))
    v = F.col(value)
    return measured.withColumn("recorded", known).where(F.col("recorded").isNotNull()).withColumn(
        "winner", F.when(v > F.col("recorded") + band, "new")
        .when(F.col("recorded") > v + band, "recorded").otherwise("tie")).withColumn(
        "is_win", (F.col("winner") == "new").cast("int"))


def prior_and_balance(df: DataFrame, label: str, value: str, total: int | None = None) -> DataFrame:
    """Share and value range of every class."""
    n = df.count() if total is None else total
    return df.groupBy(label).agg(
        F.count("*").alias("n"), (F.count("*") / F.lit(max(n, 1))).alias("prior"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def results_rows(metrics: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Wide metrics to one row per {keys…, metric, value}."""
    return metrics.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names])))
