"""Reference tables from fixed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur import fixed_values as fv


def coast_points(spark: SparkSession) -> DataFrame:
    rows = [(i, lat, lon) for i, (lat, lon) in enumerate(fv.COAST_POINTS)]
    return spark.createDataFrame(rows, "point int, lat double, lon double")


def cities(spark: SparkSession, extended: bool = False) -> DataFrame:
    points = fv.CITIES | (fv.EXTRA_CITIES if extended else {})
    return spark.createDataFrame([(n, *p) for n, p in points.items()], "city string, lat double, lon double")


def climate_zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fv.ZONE_NAMES.items()), "climate_zone int, zone_name string")


def line_stations(spark: SparkSession) -> DataFrame:
    rows = [(line, stations) for line, stations in fv.LINE_STATIONS.items()]
    return spark.createDataFrame(rows, "line string, stations array<string>")


def delay_probabilities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fv.DELAY_PROBABILITY.items()), "condition string, probability double")


def fare_rates(spark: SparkSession) -> DataFrame:
    rows = [(name, float(rate)) for name, rate in fv.FARE_RATES.items()]
    return spark.createDataFrame(rows, "vehicle_type string, rate double")


def with_fallback(fetched: Column, fallback: Column) -> Column:
    """A fetched value, or the fixed one when the fetch gave nothing."""
    return F.coalesce(fetched, fallback)
