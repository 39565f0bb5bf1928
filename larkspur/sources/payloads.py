"""Shaping of nested payloads that are stored as JSON text."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOURLY_MEASURES = ["temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m"]


def hourly_schema(measures: Sequence[str] = HOURLY_MEASURES) -> str:
    arrays = ", ".join(f"{m}: array<double>" for m in measures)
    return f"hourly struct<time: array<timestamp_ntz>, {arrays}>"


def pack_hourly(hourly: DataFrame, time: str, measures: dict[str, str], by: Column) -> DataFrame:
    """Hourly rows to one JSON payload of parallel arrays per ``by`` value.

    A payload holds the hours of one day, so its arrays stay short.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(time).alias("time"), *[
        F.col(c).alias(m) for m, c in measures.items()])))
    packed = hourly.groupBy(by.alias("payload_id")).agg(rows.alias("r"))
    arrays = [F.col("r.time").alias("time"), *[F.col(f"r.{m}").alias(m) for m in measures]]
    return packed.select("payload_id", F.to_json(F.struct(F.struct(*arrays).alias("hourly"))).alias("payload"))


def unpivot_hourly(payloads: DataFrame, payload: str, names: dict[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays to one row per hour; ``names`` renames the measures."""
    parsed = F.from_json(payload, hourly_schema(list(names)))
    zipped = F.arrays_zip("p.time", *[f"p.{m}" for m in names])
    return (
        payloads.select(*keys, parsed["hourly"].alias("p"))
        .select(*keys, F.inline(zipped))
        .select(*keys, F.col("time").alias("hour_ts"), *[F.col(m).alias(n) for m, n in names.items()])
    )


def first_match(payload: Column, schema: str, path: str) -> Column:
    """First element of a nested array; NULL when the array is empty or absent."""
    return F.get(F.from_json(payload, schema)[path], F.lit(0))


def lat_lon(coordinates: Column) -> Column:
    """A GeoJSON position [lon, lat] as a (lat, lon) struct."""
    return F.struct(F.get(coordinates, F.lit(1)).alias("lat"), F.get(coordinates, F.lit(0)).alias("lon"))


def leading_features(df: DataFrame, features: str, keys: Sequence[str], n: int) -> DataFrame:
    """The first n elements of an array, one row each, with their position."""
    return df.select(*keys, F.posexplode(F.slice(F.col(features), 1, n)).alias("pos", "feature"))


def map_rows(df: DataFrame, mapping: str, key: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """{key: [values]} to one row per key and value."""
    pairs = df.select(*keys, F.explode(mapping).alias(key, "_values"))
    return pairs.select(*keys, key, F.explode("_values").alias(value))
