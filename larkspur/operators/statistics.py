"""Descriptive statistics, histograms, correlations and trends."""

from __future__ import annotations

from statistics import NormalDist
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.cleaning import unpivot
from larkspur.operators.quantiles import quantile_columns, quantile_values, quantiles
from larkspur.operators.skew import lookup_join


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def group_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def group_mean_sorted(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias("mean_value"), F.count(value).alias("n")) \
        .orderBy("mean_value", *by)


def class_rate(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Rows, positives and positive share of each flag."""
    tall = df.agg(F.count("*").alias("n"), *[F.sum(c).alias(name) for name, c in flags.items()])
    return tall.select("n", F.inline(F.array(*[
        F.struct(F.lit(name).alias("target"), F.col(name).cast("bigint").alias("positives"))
        for name in flags]))).withColumn("rate", F.try_divide("positives", "n"))


def target_range(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """n, min, max, mean and exact median."""
    wide = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.min(value).alias("min_value"),
        F.max(value).alias("max_value"), F.avg(value).alias("mean_value"))
    if not by:
        return wide.withColumn("median_value", F.lit(quantile_values(df, value, [0.5])[0]).cast("double"))
    medians = quantile_columns(df, value, {"median_value": 0.5}, by)
    return wide.join(medians, list(by), "left")


def pearson(y: Column, x: Column) -> Column:
    """Correlation over the rows where both are known; NULL if either is constant there."""
    spread = F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))
    return F.regr_sxy(y, x) / F.nullif(spread, F.lit(0.0))


def pearson_pairs(df: DataFrame, features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Correlation of every feature with every target, in one pass.

    Features become rows under a small integer key and are combined on the map
    side: the generated code stays short however many features there are.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f).cast("double").alias("x"))
                      for i, f in enumerate(features)])
    ys = {f"_y{j}": F.col(t).cast("double") for j, t in enumerate(targets)}
    tall = df.select(*[c.alias(n) for n, c in ys.items()], F.inline(cells))
    r = tall.groupBy("i").agg(*[
        pearson(F.col(n), F.col("x")).alias(f"r_{t}") for n, t in zip(ys, targets)])
    name = F.get(F.array(*[F.lit(f) for f in features]), F.col("i"))
    return r.select(name.alias("feature"), *[f"r_{t}" for t in targets])


_GRAM = "i int, j int, n long, x double, y double, xx double, yy double, xy double"


def pair_sums(df: DataFrame, columns: Sequence[str], origin: Sequence[float]) -> DataFrame:
    """(i, j, n, x, y, xx, yy, xy) for i <= j: sums over the rows where both columns are known, about ``origin``.

    One scan: a task multiplies blocks of rows and sends one number a cell of
    the k x k matrices.
    """
    k, shift = len(columns), np.array(origin, float)
    upper = np.triu_indices(k)

    def blocks(batches):
        sums = np.zeros((6, k, k))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1) - shift
            known = ~np.isnan(x)
            x, one = np.where(known, x, 0.0), known.astype(float)
            sums += np.stack([one.T @ one, x.T @ one, one.T @ x, (x * x).T @ one, one.T @ (x * x), x.T @ x])
        cells = [pa.array(part[upper]) for part in sums]
        yield pa.RecordBatch.from_arrays([pa.array(u.astype(np.int32)) for u in upper] + [cells[0].cast(pa.int64()), *cells[1:]],
                                         names=["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    partial = df.select(*[F.col(c).cast("double") for c in columns]).mapInArrow(blocks, _GRAM)
    return partial.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every ordered pair over the rows where both are known, in long form.

    Constant columns give NULL; NaN counts as unknown. Sums are taken about
    the first row, so that large values with a small spread keep their digits.
    """
    names = F.array(*[F.lit(c) for c in columns])
    first = df.select(*[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)]).first()
    origin = [0.0 if first is None or v is None or v != v else v for v in (first or [None] * len(columns))]
    n = F.nullif(F.col("n").cast("double"), F.lit(0.0))
    spread = lambda square, total: F.when(F.col(square) - F.col(total) * F.col(total) / n > 1e-13 * F.col(square),
                                          F.col(square) - F.col(total) * F.col(total) / n)
    r = (F.col("xy") - F.col("x") * F.col("y") / n) / (F.sqrt(spread("xx", "x")) * F.sqrt(spread("yy", "y")))
    half = pair_sums(df, columns, origin).select("i", "j", r.alias("r"))
    ends = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return half.select("r", F.inline(ends)).select(F.get(names, F.col("i")).alias("x"), F.get(names, F.col("j")).alias("y"), "r")


def pivot_mean(df: DataFrame, row: str, column: str, values: Sequence[str], measure: str) -> DataFrame:
    """Mean by row and column label; NULL labels are left out."""
    kept = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return kept.groupBy(row).pivot(column, list(values)).agg(F.avg(measure))


def fixed_width_histogram(df: DataFrame, value: str, width: float, bins: int,
                          by: Sequence[str] = ()) -> DataFrame:
    """Counts in [0, width x bins]; the last bin includes its right edge."""
    x = F.col(value)
    number = F.least(F.floor(x / width), F.lit(bins - 1))
    inside = df.where((x >= 0) & (x <= width * bins))
    return (
        inside.groupBy(*by, number.cast("int").alias("bin")).agg(F.count("*").alias("n"))
        .withColumn("bin_start", F.col("bin") * F.lit(float(width)))
    )


def _bin_of(x: Column, low: float, high: float, bins: int) -> Column:
    width = (high - low) / bins
    if width == 0:
        return F.when(x.isNotNull(), F.lit(0))
    return F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def equal_width_histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equal bins from min to max; the last bin is closed."""
    ends = df.agg(F.min(value).cast("double").alias("a"), F.max(value).cast("double").alias("b")).first()
    low, high = (ends["a"] or 0.0), (ends["b"] or 0.0)
    number = _bin_of(F.col(value), low, high, bins)
    return (
        df.groupBy(*by, number.alias("bin")).agg(F.count(value).alias("n")).where("n > 0")
        .withColumn("bin_start", F.lit(low) + F.col("bin") * F.lit((high - low) / bins))
    )


def binned_mean(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Mean of y in equal bins of x with bin centres; empty bins stay, as NULL."""
    ends = df.agg(F.min(x).cast("double").alias("a"), F.max(x).cast("double").alias("b")).first()
    low, high = (ends["a"] or 0.0), (ends["b"] or 0.0)
    width = (high - low) / bins
    means = (
        df.groupBy(_bin_of(F.col(x), low, high, bins).alias("bin"))
        .agg(F.count("*").alias("n"), F.avg(y).alias("mean_y"))
    )
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        grid.join(means, "bin", "left").na.fill({"n": 0})
        .withColumn("center", F.lit(low) + (F.col("bin") + F.lit(0.5)) * F.lit(width))
    )


def box_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, and whiskers at the last values within 1.5 IQR."""
    by = list(by)
    quartiles = quantile_columns(df, value, {"q1": 0.25, "median_value": 0.5, "q3": 0.75}, by)
    fenced = lookup_join(df.select(*by, value), quartiles, by, "inner")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    x = F.col(value)
    inside = (x >= F.col("q1") - reach) & (x <= F.col("q3") + reach)
    return fenced.groupBy(*by, "q1", "median_value", "q3").agg(
        F.count(value).alias("n"),
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outside"))


def region_rows(df: DataFrame, regions: dict[str, Column]) -> DataFrame:
    """One row per region a row belongs to; regions may overlap."""
    named = F.array(*[F.when(cond, F.lit(name)) for name, cond in regions.items()])
    return df.withColumn("region", F.explode(F.array_compact(named)))


def linear_trend(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of y on x, with the ends of the drawn line."""
    both = F.col(y).isNotNull() & F.col(x).isNotNull()
    fit = df.where(both).groupBy(*by).agg(
        F.count("*").alias("n"), F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"), pearson(F.col(y), F.col(x)).alias("r"),
        F.regr_r2(y, x).alias("r2"), F.min(x).alias("x_min"), F.max(x).alias("x_max"))
    at = lambda c: F.col("intercept") + F.col("slope") * F.col(c)
    return fit.withColumn("y_start", at("x_min")).withColumn("y_end", at("x_max"))


def normal_points(m: int) -> list[tuple[float, float]]:
    """Filliben order-statistic medians and their standard normal quantiles."""
    last = 0.5 ** (1 / m)
    medians = [1 - last] + [(i - 0.3175) / (m + 0.365) for i in range(2, m)] + [last]
    return [(p, NormalDist().inv_cdf(p)) for p in medians]


def qq_points(df: DataFrame, value: str, m: int = 99) -> DataFrame:
    """Sample quantiles at m probabilities beside the normal quantiles."""
    points = normal_points(m)
    sample = quantiles(df, value, [p for p, _ in points])
    theory = F.get(F.array(*[F.lit(z) for _, z in points]), F.col("i"))
    return sample.select("i", "prob", theory.alias("theoretical"), F.col("quantile").alias("ordered"))


def qq_fit(points: DataFrame) -> DataFrame:
    """Slope, intercept and r of the Q-Q line."""
    return points.agg(
        F.count("*").alias("n_points"),
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        pearson(F.col("ordered"), F.col("theoretical")).alias("r"))


def compare_groups(df: DataFrame, groups: dict[str, Column], value: str) -> DataFrame:
    """Size and mean of several groups side by side, in one pass."""
    aggs = []
    for name, member in groups.items():
        x = F.when(member, F.col(value))
        aggs += [F.count(x).alias(f"{name}_n"), F.avg(x).alias(f"{name}_mean")]
    return df.agg(*aggs)


def price_deltas(df: DataFrame, group: str, first, second, by: Sequence[str], value: str) -> DataFrame:
    """Mean gap between two values of ``group`` at equal ``by``."""
    x = lambda v: F.avg(F.when(F.col(group) == v, F.col(value)))
    return (
        df.where(F.col(group).isin(first, second)).groupBy(*by)
        .agg(x(first).alias("first_mean"), x(second).alias("second_mean"))
        .where("first_mean is not null and second_mean is not null")
        .withColumn("saving", F.col("second_mean") - F.col("first_mean"))
    )


def all_price_deltas(df: DataFrame, group: str, by: Sequence[str], value: str) -> DataFrame:
    """Mean gap between every two values of ``group`` at equal ``by``; the values are few."""
    means = df.groupBy(group, *by).agg(F.avg(value).alias("_mean"))
    first = means.select(*by, F.col(group).alias("first"), F.col("_mean").alias("first_mean"))
    second = means.select(*by, F.col(group).alias("second"), F.col("_mean").alias("second_mean"))
    return first.join(second, list(by)).where("first < second").withColumn("saving", F.col("second_mean") - F.col("first_mean"))


def table_profile(df: DataFrame, target: str) -> DataFrame:
    """Rows, columns and the range of the target, in one row."""
    return target_range(df, target).select(
        F.col("n").alias("n_target"), "min_value", "max_value", "mean_value", "median_value",
    ).withColumn("n_columns", F.lit(len(df.columns))).withColumn("n_rows", F.lit(df.count()).cast("bigint"))
