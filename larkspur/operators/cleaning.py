"""Filters, audits, optional columns and the two modelling tables."""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.timeparts import wall_seconds
from larkspur.operators.skew import lookup_join


def drop_null_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def positive_filter(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) > 0)


def first_failed_rule(rules: dict[str, Column]) -> Column:
    """Name of the first rule whose condition does not hold, else NULL.

    An unknown condition counts as failed, as a filter would drop the row.
    """
    out = None
    for name, keep in rules.items():
        failed = ~F.coalesce(keep, F.lit(False))
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return out


def range_filters(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that pass every rule."""
    return df.where(first_failed_rule(rules).isNull())


def rule_removals(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows removed by each rule in turn, each counted after the one before.

    One pass: a row belongs to the first rule it fails.
    """
    counts = [F.count_if(first_failed_rule(rules) == name).alias(name) for name in rules]
    wide = df.agg(*counts, F.count_if(first_failed_rule(rules).isNull()).alias("kept"))
    return unpivot(wide, [*rules, "kept"], "rule", "n_rows")


def unpivot(wide: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row to many: (name, value) per listed column."""
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns
    ])))


def stratum_sizes(df: DataFrame, stratum: str, minimum: int = 10) -> DataFrame:
    """Strata with at least ``minimum`` rows."""
    return df.groupBy(stratum).agg(F.count("*").alias("stratum_n")).where(F.col("stratum_n") >= minimum)


def rare_stratum_filter(df: DataFrame, stratum: str, minimum: int = 10) -> DataFrame:
    """Rows of strata with at least ``minimum`` rows, with the stratum size."""
    return lookup_join(df, stratum_sizes(df, stratum, minimum), [stratum], "inner")


def valid_strata_semi(df: DataFrame, valid: DataFrame, stratum: str) -> DataFrame:
    """Rows whose stratum is in the valid set."""
    return lookup_join(df, valid.select(stratum), [stratum], "left_semi")


def segment_filter(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def optional_column(df: DataFrame, candidates: Sequence[str], default) -> Column:
    """The first candidate the table has, else a constant."""
    for name in candidates:
        if name in df.columns:
            return F.col(name)
    return F.lit(default)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return unpivot(wide, columns, "column_name", "n_null")


def not_null_validation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and verdict per column."""
    return null_counts(df, columns).withColumn("passed", (F.col("n_null") == 0).cast("int"))


def drop_report(df: DataFrame, keep: Column, watched: str) -> DataFrame:
    """Rows before, after and removed, and nulls left in the watched column."""
    kept = F.coalesce(keep, F.lit(False))
    counts = df.agg(
        F.count("*").alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
        F.count_if(kept & F.col(watched).isNull()).alias("nulls_left"),
    )
    return counts.select("rows_before", "rows_after",
                         (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"), "nulls_left")


def range_checks(df: DataFrame, violations: dict[str, Column]) -> DataFrame:
    """Rows that violate each rule."""
    wide = df.agg(*[F.count_if(v).alias(name) for name, v in violations.items()])
    return unpivot(wide, list(violations), "rule", "n_violations")


def complete_grid(df: DataFrame, time: str, by: Sequence[str], step: str = "1 hour") -> DataFrame:
    """One row per group and step, from the first to the last time of the group."""
    by = list(by)
    ends = df.groupBy(*by).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    grid = ends.select(*by, F.explode(F.expr(f"sequence(_a, _b, interval {step})")).alias(time))
    return grid.join(df, [*by, time], "left")


def fill_gaps(df: DataFrame, time: str, value: str, by: Sequence[str], step: str = "1 hour") -> DataFrame:
    """Complete the time grid, then fill: last known value, and on the line
    between the neighbours.

    A series holds one row per step, so its length is bounded by the calendar
    whatever the number of measurements behind it. Both frames run up to the
    current row, one of them in descending time, so a series costs one pass each.
    """
    grid = complete_grid(df, time, by, step)
    back = Window.partitionBy(*by).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*by).orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(F.col(value).isNotNull(), F.col(time))
    out = (
        grid.withColumn("_v0", F.last(value, ignorenulls=True).over(back))
        .withColumn("_v1", F.last(value, ignorenulls=True).over(ahead))
        .withColumn("_t0", F.last(known, ignorenulls=True).over(back))
        .withColumn("_t1", F.last(known, ignorenulls=True).over(ahead))
    )
    span = wall_seconds(F.col("_t1")) - wall_seconds(F.col("_t0"))
    done = wall_seconds(F.col(time)) - wall_seconds(F.col("_t0"))
    line = F.when(span == 0, F.col("_v0")).otherwise(
        F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.try_divide(done, span))
    return out.select(*by, time, value, F.col("_v0").alias(f"{value}_filled"),
                      line.alias(f"{value}_linear"))


def feature_select(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select([c for c in wanted if c in df.columns])


def leakage_columns(columns: Sequence[str], pattern: str = "surge",
                    listed: Sequence[str] = ("name", "name_encoded", "is_premium")) -> list[str]:
    """Columns that would give the class target away."""
    return [c for c in columns if re.search(pattern, c) or c in listed]


def leakage_exclude(df: DataFrame, pattern: str = "surge",
                    listed: Sequence[str] = ("name", "name_encoded", "is_premium")) -> tuple[DataFrame, list[str]]:
    """The table without leaking columns, and the names removed."""
    removed = leakage_columns(df.columns, pattern, listed)
    return df.drop(*removed), removed


def strip_suffix(df: DataFrame) -> DataFrame:
    """Drop the ``_encoded`` and ``_enc`` endings of column names."""
    return df.withColumnsRenamed({c: re.sub(r"_(encoded|enc)$", "", c) for c in df.columns})


def task_split(df: DataFrame, features: Sequence[str], regression_target: str, class_target: str,
               keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Regression table (features + target) and classification table
    (features without leakage + target) from one feature table."""
    present = [c for c in features if c in df.columns]
    safe = [c for c in present if c not in leakage_columns(present)]
    regression = df.select(*keys, *present, regression_target)
    classes = df.select(*keys, *[c for c in safe if c != class_target], class_target)
    return strip_suffix(regression), strip_suffix(classes)
