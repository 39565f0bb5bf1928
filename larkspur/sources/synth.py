"""Synthetic rides: every value is a function of the row's key.

Uniform numbers come from hash digits, so rows can be generated in any
partition, again after a failure, or in another engine, with equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur import fixed_values as fv

_SPAN = 16 ** 8


def uniform(key: str, stream: str) -> Column:
    """Uniform in [0, 1) from 32 hash bits of (key, stream)."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{stream}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(_SPAN)


def weighted(u: Column, levels: list[tuple[float, object]]) -> Column:
    """The level whose cumulative share first exceeds u."""
    out = None
    for share, level in levels:
        out = F.when(u < share, level) if out is None else out.when(u < share, level)
    return out.otherwise(levels[-1][1])


def synth_rides(keys: DataFrame, key: str) -> DataFrame:
    """Distance, hour, monsoon flag, vehicle type and traffic level per key."""
    vehicles = list(fv.FARE_RATES)
    return keys.select(
        key,
        (1 + uniform(key, "distance") * 24).alias("distance_km"),
        F.floor(uniform(key, "hour") * 24).cast("int").alias("hour"),
        (uniform(key, "monsoon") < fv.MONSOON_SHARE).cast("int").alias("is_monsoon"),
        weighted(uniform(key, "vehicle"), [((i + 1) / len(vehicles), v) for i, v in enumerate(vehicles)])
        .alias("vehicle_type"),
        weighted(uniform(key, "traffic"), fv.TRAFFIC_LEVELS).alias("traffic_level"),
    )


def synth_range(spark, n: int) -> DataFrame:
    """n synthetic rides with keys 0 to n - 1."""
    return synth_rides(spark.range(n).withColumnRenamed("id", "ride_id"), "ride_id")
