"""Ride pricing: raw rides to modelling tables, enrichment, and ten models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.functions import distance as fd
from larkspur.functions import ride, timeparts as tp, weather
from larkspur.functions.timeparts import flag
from larkspur.models import grid
from larkspur.operators import cleaning, encoding, sampling

C = F.col
CATEGORIES = ["cab_type", "name", "source", "destination", "route"]
BASE_FEATURES = [
    "distance", "log_distance", "surge_multiplier", "hour", "day_of_week", "is_weekend", "hour_sin", "hour_cos",
    "dow_sin", "dow_cos", "is_morning_rush", "is_evening_rush", "is_rush_hour", "is_night", "temperature",
    "humidity", "windSpeed", "is_rainy", "is_cold", "weather_severity", "cab_type_encoded", "name_encoded",
    "is_premium", "source_encoded", "destination_encoded", "route_encoded", "distance_surge", "weather_surge",
    "rush_surge", "short_ride", "medium_ride", "long_ride",
]
ENRICHED_FEATURES = [
    "weather_severity_enhanced", "is_adverse_weather", "is_event_time", "likely_transit_delay",
    "is_high_demand_zone", "distance_event_interaction", "weather_rush_interaction", "cab_weather_interaction",
]
EARLIER_FEATURES = [c for c in BASE_FEATURES if c not in (
    "log_distance", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "route_encoded")]


def clean(rides: DataFrame) -> DataFrame:
    """Rides with a positive price, a distance and a surge multiplier."""
    complete = cleaning.drop_null_subset(rides, ["price", "distance", "surge_multiplier"])
    return cleaning.positive_filter(complete, "price")


def sample(rides: DataFrame, key: str, size: int) -> DataFrame:
    """Strata by platform, service and price band; rare ones dropped; exactly
    ``size`` rows when there are that many."""
    strata = rides.withColumn("stratum", sampling.strata_key(
        C("cab_type"), C("name"), fd.price_band(C("price"))))
    valid = cleaning.rare_stratum_filter(strata, "stratum").drop("stratum_n")
    return sampling.sample_with_top_up(valid, key, "stratum", size).drop("stratum", "origin")


def engineer(rides: DataFrame, premium: str = fv.PREMIUM_PATTERN, humid: float = 70) -> DataFrame:
    """The derived columns, in three projections."""
    first = rides.withColumns(
        tp.time_parts(C("ts")) | fd.ride_bands(C("distance")) | {
            "log_distance": F.log1p("distance"), "is_premium": ride.premium_by_pattern(C("name"), premium),
            "route": ride.route_key(C("source"), C("destination"))}
        | weather.weather_flags(C("precipIntensity"), C("temperature"), C("humidity"), humid=humid)
        | weather.extended_flags(*[C(c) for c in (
            "temperature", "apparentTemperature", "visibility", "precipProbability", "pressure", "windGust",
            "cloudCover")]))
    second = first.withColumns(
        {"is_weekend": tp.weekend_flag(C("day_of_week")), "is_night": tp.night_flag(C("hour"))}
        | tp.rush_flags(C("hour"), tp.weekend_flag(C("day_of_week")))
        | tp.cyclic_encoding(C("hour"), C("day_of_week"))
        | weather.severity_scores(*[C(c) for c in (
            "is_rainy", "is_cold", "is_high_humidity", "low_visibility", "high_wind", "low_pressure",
            "high_precip_prob")]))
    return second.withColumns(
        ride.surge_interactions(C("distance"), C("surge_multiplier"), C("is_rainy"), C("is_rush_hour"),
                                C("weather_severity"))
        | ride.condition_interactions(
            C("is_rainy"), C("is_cold"), C("is_rush_hour"), C("is_night"), C("severe_weather"),
            C("precipProbability"), C("visibility"), C("distance"), C("pressure")))


def encode(df: DataFrame, categories=CATEGORIES) -> tuple[DataFrame, DataFrame]:
    """Codes for the categories, and the dictionary they came from."""
    dictionary = encoding.fit_dictionary(df, categories)
    return encoding.apply_dictionary(df, dictionary, categories), dictionary


def enrich(df: DataFrame, zones=fv.DEMAND_ZONES, earlier: bool = False) -> DataFrame:
    """The eight enrichment columns that are not weather scores already.

    Zone membership is read from the raw names. The earlier variant adds the
    fuel indicator.
    """
    event = ride.event_window_flag(C("hour"), C("is_night"), C("is_weekend"))["is_event_time"]
    out = df.withColumns({
        "is_event_time": event,
        "likely_transit_delay": ride.transit_delay_flag(C("is_rush_hour"), C("is_rainy")),
        "is_high_demand_zone": ride.demand_zone_flag(C("source"), zones)})
    out = out.withColumns(ride.enrichment_interactions(
        C("distance"), C("is_event_time"), C("is_rainy"), C("is_rush_hour"), C("cab_type_encoded")))
    if earlier:
        out = out.withColumn("fuel_price_indicator", ride.fuel_indicator(C("distance"), C("surge_multiplier")))
    return out


def feature_lists(regression: bool, enriched: bool) -> list[str]:
    columns = BASE_FEATURES + (ENRICHED_FEATURES if enriched else [])
    return columns if regression else [c for c in columns if c not in cleaning.leakage_columns(columns)]


def feature_table(rides: DataFrame, key: str, size: int | None = None, premium: str = fv.PREMIUM_PATTERN,
                  humid: float = 70, zones=fv.DEMAND_ZONES) -> DataFrame:
    """Raw rides to one table with base and enriched columns."""
    kept = clean(rides)
    if size is not None:
        kept = sample(kept, key, size)
    coded, _ = encode(engineer(kept, premium, humid))
    return enrich(coded, zones)


def run_models(table: DataFrame, key: str, threads: int = 4) -> DataFrame:
    """Five regressors and five classifiers, base and enriched, in one results table."""
    split = sampling.split_by_hash(table, key)
    sets = lambda regression: {
        "base": feature_lists(regression, False), "enriched": feature_lists(regression, True)}
    regression = grid.run_grid(split, sets(True), "price", grid.regressors(), grid.score_regression,
                               grid.REG_METRICS, threads)
    classes = sampling.split_stratified(table, key, "is_premium")
    binary = grid.run_grid(classes, sets(False), "is_premium", grid.classifiers(key), grid.score_binary,
                           grid.CLF_METRICS, threads)
    return regression.unionByName(binary, allowMissingColumns=True)
