"""Registered queries, by family."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.catalog import checked_models, features, grown, models, reports, rows, solved, studies, tables  # noqa: F401
from larkspur.catalog.registry import QUERIES, oracles
from larkspur.functions import distance
from larkspur.sources.tables import Tables


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return oracles()


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    rides = features.clock(Tables(spark, folder).priced)
    return (
        rides.withColumn("band", distance.price_band(F.col("price")))
        .groupBy("name", "cab_type", "band", "is_rush_hour")
        .agg(F.count("*").alias("n"), F.round(F.avg("price"), 6).alias("mean_price"),
             F.round(F.avg("distance"), 6).alias("mean_distance"))
        .orderBy("mean_price", "name", "cab_type", "band", "is_rush_hour")
    )
