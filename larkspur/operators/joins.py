"""Enrichment joins."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.timeparts import flag, nearest_hour
from larkspur.operators.skew import lookup_join
from larkspur.session import cut_lineage


def hourly_join(df: DataFrame, ts: str, hourly: DataFrame, hour: str, order: str) -> DataFrame:
    """Left join on the nearest hour.

    The hourly side is reduced to one row per hour first (the least value of
    ``order`` wins), so the join never multiplies rows.
    """
    measures = [c for c in hourly.columns if c != hour]
    single = (
        hourly.withColumn("_hour", nearest_hour(F.col(hour)))
        .groupBy("_hour").agg(F.min_by(F.struct(*measures), F.col(order)).alias("_m"))
        .select("_hour", "_m.*")
    )
    keyed = df.withColumn("_hour", nearest_hour(F.col(ts)))
    return lookup_join(keyed, single, ["_hour"], "left").withColumnRenamed("_hour", "merge_time")


def code_lookup(df: DataFrame, column: str, labels: dict, name: str) -> DataFrame:
    """Label for a code from a fixed table; unmapped codes give NULL."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return df.withColumn(name, F.try_element_at(F.create_map(*pairs), F.col(column)))


def label_join(df: DataFrame, labels: DataFrame, on: list[str]) -> DataFrame:
    """The same with a label table instead of a fixed one."""
    return lookup_join(df, labels, on, "left")


def membership_semi(df: DataFrame, members: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is listed in another table."""
    return lookup_join(df, members.select(*on).distinct(), on, "left_semi")


def window_join(df: DataFrame, ts: str, place: str, calendar: DataFrame, slices: int = 8) -> DataFrame:
    """Rides against event windows: start <= ts < end.

    ``calendar`` has (event_date, starts, ends, venue). A window counts on
    every day it touches; ``is_event_day`` tells whether any does. Windows are
    cut at full hours, so each hour stands alone: its starts and ends and its
    rides, sorted by time, are swept once with a running count of open
    windows, in all and per venue. A busy hour's rides are dealt into
    ``slices``, each with all the hour's starts and ends.
    """
    whole = calendar.where("starts < ends")
    hour = F.explode(F.sequence(F.date_trunc("hour", "starts").cast("timestamp_ntz"), F.col("ends") - F.expr("interval 1 microsecond"), F.expr("interval 1 hour")))
    touched = whole.withColumn("_hour", hour).select(
        "_hour", "venue", F.greatest("starts", "_hour").alias("a"), F.least("ends", F.col("_hour") + F.expr("interval 1 hour")).alias("b"))
    row = F.struct(*df.columns)
    steps = touched.select("_hour", "venue", F.inline(F.array(
        F.struct(F.col("a").alias("_at"), F.lit(1).alias("_step")), F.struct(F.col("b").alias("_at"), F.lit(-1).alias("_step"))))) \
        .groupBy("_hour", "venue", "_at").agg(F.sum("_step").alias("_step")) \
        .select("_hour", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice"), F.col("venue").alias("_place"), "_at", F.col("_step").cast("long"))
    at = F.col(ts).cast("timestamp_ntz")
    rides = df.select(F.date_trunc("hour", at).cast("timestamp_ntz").alias("_hour"), F.pmod(F.xxhash64(*df.columns), F.lit(slices)).cast("int").alias("_slice"),
                      F.col(place).alias("_place"), at.alias("_at"), row.alias("_row"))
    both = steps.withColumn("_row", F.lit(None).cast(rides.schema["_row"].dataType)).unionByName(
        rides.withColumn("_step", F.lit(0).cast("long")))
    # a step at a ride's very instant comes before the ride
    upto = lambda *keys: Window.partitionBy(*keys).orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = both.withColumns({"_open": F.sum("_step").over(upto("_hour", "_slice")),
                              "_here": F.sum("_step").over(upto("_hour", "_slice", "_place"))}).where("_row is not null")
    days = touched.select(F.to_date("_hour").alias("_day")).distinct().withColumn("_any", F.lit(1))
    dated = lookup_join(swept.withColumn("_day", F.to_date("_at")), days, ["_day"])
    return dated.select("_row.*", F.col("_day").alias("event_date"), F.col("_open").cast("long").alias("n_events"),
                        flag(F.col("_any").isNotNull()).alias("is_event_day"), flag(F.col("_open") > 0).alias("is_during_event"),
                        flag((F.col("_here") > 0) & F.col("_place").isNotNull()).alias("is_at_event_venue"))


def asof_join(df: DataFrame, ts: str, series: DataFrame, at: str, values: Sequence[str]) -> DataFrame:
    """The last series row at or before each ride, however long ago; of rows at one instant the greatest.

    Rides and series rows are sorted together into ranges of time. Inside a
    range the last series row is carried along; what a range starts with is
    the last series row of the ranges before, one row each. Rides of one
    instant may lie in several ranges.
    """
    row, item = F.struct(*df.columns), F.struct(F.col(at).alias("_from"), *values)
    known = series.where(F.col(at).isNotNull()).select(F.col(at).cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_salt"),
                                                       item.alias("_item"))
    rides = df.select(F.col(ts).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_kind"), F.xxhash64(*df.columns).alias("_salt"), row.alias("_row"))
    both = known.unionByName(rides, allowMissingColumns=True)
    order = ["_t", "_kind", "_item", "_salt"]
    dealt = cut_lineage(both.repartitionByRange(*order)).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per range
    ends = dealt.groupBy("_part").agg(F.max(F.when(F.col("_kind") == 0, F.struct("_t", "_item"))).alias("_last"))
    before = ends.select("_part", F.last("_last._item", ignorenulls=True).over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    carried = dealt.withColumn("_hit", F.last("_item", ignorenulls=True).over(inside)).where("_kind = 1")
    # a ride without a time matches nothing
    hit = F.when(F.col("_t").isNotNull(), F.coalesce("_hit", "_before"))
    return lookup_join(carried, before, ["_part"]).withColumn("_hit", hit).select(
        "_row.*", F.col("_hit._from").alias(f"{at}_matched"), *[F.col(f"_hit.{v}") for v in values])


def keyed_join(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Left equi-join to a table with one row per key."""
    return lookup_join(df, other, on, "left")


def station_delays(alerts: DataFrame, stations: str, hour: str, delay: str) -> DataFrame:
    """Alerts with station lists to one row per station and hour."""
    exploded = alerts.select(F.explode(stations).alias("station"), hour, delay)
    return exploded.groupBy("station", hour).agg(
        F.max(delay).alias("max_delay"), F.avg(delay).alias("avg_delay"),
        F.count("*").alias("n_alerts"))


def scenario_grid(options: DataFrame, axes: dict[str, Sequence]) -> DataFrame:
    """Every option under every combination of a few fixed values."""
    out = options
    for name, values in axes.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def base_vs_enriched(results: DataFrame, on: list[str], metrics: Sequence[str],
                     which: str = "feature_set") -> DataFrame:
    """Base and enriched results of the same model side by side."""
    def side(name: str) -> DataFrame:
        return results.where(F.col(which) == name).select(
            *on, *[F.col(m).alias(f"{name}_{m}") for m in metrics])
    return side("base").join(side("enriched"), on)
