"""The stateless features on a stream.

Every scalar feature is a column expression, so the batch functions run on a
streaming frame as they are. The hourly weather side is a static table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.functions.timeparts import nearest_hour
from larkspur.plans.rides import engineer


def stream_features(rides: DataFrame, premium: str = fv.PREMIUM_PATTERN, humid: float = 70) -> DataFrame:
    """Cleaned and engineered rides from a streaming source."""
    return engineer(rides.where("price > 0 and distance is not null"), premium, humid)


def stream_with_weather(rides: DataFrame, hourly: DataFrame, hour: str = "hour_ts") -> DataFrame:
    """Stream-static left join on the nearest hour; ``hourly`` has one row per hour."""
    keyed = rides.withColumn("merge_time", nearest_hour(F.col("ts")))
    return keyed.join(hourly.withColumnRenamed(hour, "merge_time"), "merge_time", "left")
