"""Exact quantiles without gathering a column in one task.

The input becomes counts of distinct values per group, so a value that fills
much of a group is one row with a large count. One range exchange deals these
over the cluster in order, and a sum per range tells where each range begins.
A wanted order statistic lies in one range; the rows of such ranges get their
ranks, the wanted ranks are merged into them, and each takes the value it falls
on. The steps are the same for every size and any number of probabilities.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import cut_lineage

_X = "_x"


def quantile_arrays(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles: one row (by…, q) with an array per group.

    NULL and NaN values are ignored; a group without any other gives NULL.
    """
    by, probs = list(by), [float(p) for p in probs]
    # NaN to NULL, which is not counted; a filter would repeat a long expression in the scan
    x = F.nanvl(F.col(value).cast("double"), F.lit(None))
    counts = df.select(*by, x.alias(_X)).groupBy(*by, _X).agg(F.count(_X).alias("_n"))
    order = [F.col(c).asc_nulls_first() for c in (*by, _X)]
    ranged = cut_lineage(counts.repartitionByRange(*order)).withColumn("_part", F.spark_partition_id())
    group = Window.partitionBy(*(by or [F.lit(0)]))
    # one row per group and range
    parts = ranged.groupBy(*by, "_part").agg(F.sum("_n").alias("_size")).withColumns({
        "_upto": F.sum("_size").over(group.orderBy("_part")), "_total": F.sum("_size").over(group)})
    place = F.col("_p.p") * (F.col("_total") - 1)
    wanted = parts.withColumn("_p", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(probs)]))) \
        .select(*by, "_part", "_upto", (F.col("_upto") - F.col("_size")).alias("_from"), F.col("_p.i").alias("_i"), place.alias("_place")) \
        .withColumn("_k", F.explode(F.array(F.floor("_place"), F.ceil("_place")))) \
        .where("_k >= _from and _k < _upto")
    wanted = cut_lineage(wanted)
    here = wanted.select(*by, "_part", "_from").distinct()
    inside = Window.partitionBy(*by, "_part")
    upto = F.sum("_n").over(inside.orderBy(_X)) + F.col("_from")
    ranks = _same_group(ranged.where(F.col(_X).isNotNull()), here, [*by, "_part"]).select(
        *by, "_part", (upto - F.col("_n")).alias("_k"), F.lit(0).alias("_kind"), F.lit(None).cast("int").alias("_i"),
        F.lit(None).cast("double").alias("_place"), _X)
    asked = wanted.select(*by, "_part", "_k", F.lit(1).alias("_kind"), "_i", "_place", F.lit(None).cast("double").alias(_X))
    last = F.last(_X, ignorenulls=True).over(inside.orderBy("_k", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = ranks.unionByName(asked).withColumn("_v", last).where("_kind = 1")
    low, high = (F.max(F.when(F.col("_k") == f("_place"), F.col("_v"))) for f in (F.floor, F.ceil))
    part = F.col("_place") - F.floor("_place")
    each = found.groupBy(*by, "_i", "_place").agg(low.alias("_low"), high.alias("_high")).select(
        *by, "_i", F.when(part == 0, F.col("_low")).otherwise(
            (F.ceil("_place") - F.col("_place")) * F.col("_low") + part * F.col("_high")).alias("_v"))
    # one short array per group: as many entries as probabilities
    arrays = each.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_i", "_v")))["_v"].alias("q"))
    if not by:
        return arrays.select(F.when(F.size("q") > 0, F.col("q")).alias("q"))
    groups = parts.select(*by).distinct()
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
    return groups.alias("l").join(arrays.alias("r"), same, "left").select(*[f"l.{c}" for c in by], "r.q")


def _same_group(df: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which NULL is a group like any other."""
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on]
    return df.alias("l").join(side.alias("r"), same).select("l.*", *[f"r.{c}" for c in side.columns if c not in on])


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """One row (by…, i, prob, quantile) per group and probability."""
    arrays = quantile_arrays(df, value, probs, by)
    tall = arrays.select(*by, F.posexplode("q").alias("i", "quantile"))
    prob = F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("i"))
    return tall.select(*by, "i", prob.alias("prob"), "quantile")


def quantile_values(df: DataFrame, value: str, probs: Sequence[float]) -> list[float | None]:
    """Whole-table quantiles as driver-side numbers, one per probability."""
    row = quantile_arrays(df, value, probs).first()
    return list(row["q"]) if row and row["q"] else [None] * len(probs)


def quantile_columns(df: DataFrame, value: str, probs: dict[str, float],
                     by: Sequence[str] = ()) -> DataFrame:
    """One row per group with a named column per probability."""
    arrays = quantile_arrays(df, value, list(probs.values()), by)
    return arrays.select(*by, *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(probs)])
