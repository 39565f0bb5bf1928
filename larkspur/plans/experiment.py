"""Base-versus-enriched studies on the ride feature table."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.models import grid, linear
from larkspur.models.perceptron import Perceptron
from larkspur.operators import cleaning, evaluation, joins, ordering, sampling
from larkspur.plans import rides
from larkspur.plans.trainers import score_weighted

C = F.col
SURGE_FEATURES = [c.replace("_enc", "_encoded") for c in fv.SURGE_FEATURES]
SERVICE_FEATURES = [c.replace("_enc", "_encoded") for c in fv.SERVICE_FEATURES]
TIME = ["hour", "hour_sin", "hour_cos", "day_of_week", "is_weekend", "is_rush_hour", "is_night"]
WEATHER = ["temperature", "humidity", "windSpeed", "precipIntensity", "visibility", "pressure", "cloudCover",
           "windGust", "is_rainy", "is_cold", "wind_chill", "low_visibility"]
PLACE = ["distance", "short_ride", "long_ride", "cab_type_encoded", "source_encoded", "destination_encoded"]
PLATFORM_FEATURES = [c for c in TIME + WEATHER + ["severe_weather", "rain_rush", "overcast"] + PLACE
                     if c != "cab_type_encoded"]
TIER_FEATURES = TIME + WEATHER + PLACE + ["distance_surge", "surge_multiplier", "rain_rush", "name_encoded"]


def enrichment_sets(regression: bool) -> dict[str, list[str]]:
    """Base columns, and the same with seven raw and seven derived weather columns."""
    base = [c for c in rides.EARLIER_FEATURES if regression or c not in cleaning.leakage_columns(
        rides.EARLIER_FEATURES)]
    return {"base": base, "enriched": base + fv.RAW_ENRICHMENT + fv.DERIVED_ENRICHMENT}


def surge_study(table: DataFrame, key: str) -> DataFrame:
    """Can surge be told from time, weather and place?"""
    labelled = table.withColumns({
        "is_surging": (C("surge_multiplier") > 1).cast("int"), "is_late_night": C("hour").between(0, 3).cast("int")})
    return grid.run_grid(sampling.split_stratified(labelled, key, "is_surging"), {"all": SURGE_FEATURES},
                         "is_surging", grid.classifiers(key), grid.score_binary, grid.CLF_METRICS)


def platform_study(table: DataFrame, key: str, platform: str) -> DataFrame:
    labelled = table.withColumn("is_platform", (C("cab_type") == platform).cast("int"))
    return grid.run_grid(sampling.split_stratified(labelled, key, "is_platform"), {"all": PLATFORM_FEATURES},
                         "is_platform", grid.classifiers(key), grid.score_binary, grid.CLF_METRICS)


def within_service(table: DataFrame, key: str, services: Sequence[str]) -> DataFrame:
    """Price inside one service, with and without the surge columns."""
    sets = {"without surge": SERVICE_FEATURES,
            "with surge": SERVICE_FEATURES + ["surge_multiplier"]}
    table = table.withColumn("distance_sq", C("distance") * C("distance"))
    out = None
    for service in services:
        part = cleaning.segment_filter(table, "name", [service])
        results = grid.run_grid(sampling.split_by_hash(part, key), sets, "price",
                                grid.regressors(["distance", "surge_multiplier", "hour"]), grid.score_regression,
                                grid.REG_METRICS).withColumn("service", F.lit(service))
        out = results if out is None else out.unionByName(results)
    return out


def tiers(table: DataFrame) -> DataFrame:
    """Four price classes cut at the quartiles."""
    return ordering.quantile_tiers(table, "price")


def tier_study(table: DataFrame, key: str, partitions: int = 8) -> DataFrame:
    """Five classifiers on the four price classes, scored by class size."""
    models = grid.classifiers(key) | {
        "Logistic Reg": grid.Model(lambda t, f, y: linear.fit_logistic(t, f, y, multiclass=True)),
        "Perceptron": grid.Model(lambda t, f, y: Perceptron.fit(t, f, y, key, partitions, classes=4))}
    split = sampling.split_stratified(tiers(table), key, "tier")
    return grid.run_grid(split, {"all": TIER_FEATURES}, "tier", models, score_weighted, grid.CLF_METRICS)


def enrichment_study(table: DataFrame, key: str, regression: bool = True) -> DataFrame:
    """Base against enriched, with the change per model."""
    if regression:
        results = grid.run_grid(sampling.split_by_hash(table, key), enrichment_sets(True), "price",
                                grid.regressors(["distance", "surge_multiplier", "distance_surge"]),
                                grid.score_regression, grid.REG_METRICS)
        metric = "r2"
    else:
        results = grid.run_grid(sampling.split_stratified(table, key, "is_premium"), enrichment_sets(False),
                                "is_premium", grid.classifiers(key), grid.score_binary, grid.CLF_METRICS)
        metric = "f1"
    pairs = joins.base_vs_enriched(results, ["model"], [metric])
    return evaluation.metric_delta(pairs, metric)
