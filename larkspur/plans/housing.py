"""Housing: cleaning with counts, derived columns, geographic enrichment, ten models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.functions import geo, housing
from larkspur.models import grid
from larkspur.operators import cleaning, ordering, sampling

C = F.col
RAW = ["MedInc", "HouseAge", "AveRooms", "AveBedrms", "Population", "AveOccup", "Latitude", "Longitude"]
DERIVED = ["bedroom_ratio", "rooms_per_person", "pop_density", "log_population", "log_income", "is_new_house",
           "is_old_house", "is_low_income", "is_high_income", "is_crowded", "income_age", "income_rooms"]
POLY_CANDIDATES = ["MedInc", "AveRooms", "AveOccup", "rooms_per_person", "dist_to_coast", "coastal_income",
                   "income_coast_interaction", "HouseAge", "Latitude", "Longitude"]


def outlier_rules(cap: float = fv.HOUSING_CAPS["target"]) -> dict:
    return {
        "value_cap": C("MedHouseVal") < cap, "occupancy_cap": C("AveOccup") <= fv.HOUSING_CAPS["AveOccup"],
        "rooms_cap": C("AveRooms") <= fv.HOUSING_CAPS["AveRooms"],
        "bedrooms_cap": C("AveBedrms") <= fv.HOUSING_CAPS["AveBedrms"]}


def engineer(blocks: DataFrame) -> DataFrame:
    """Twelve derived columns."""
    ratios = housing.housing_ratios(C("AveBedrms"), C("AveRooms"), C("AveOccup"), C("Population"))
    ratios.pop("urban_density")
    return blocks.withColumns(
        ratios | housing.housing_flags(C("HouseAge"), C("MedInc"), C("AveOccup")) | {
            "log_population": F.log1p("Population"), "log_income": F.log1p("MedInc"),
            "income_age": C("MedInc") * C("HouseAge"), "income_rooms": C("MedInc") * C("AveRooms")})


def enrich(blocks: DataFrame) -> DataFrame:
    """Fourteen geographic columns."""
    placed = geo.with_unit_vector(blocks, "Latitude", "Longitude")
    located = placed.withColumns({"dist_to_coast": geo.nearest_miles()} | geo.city_distances())
    flagged = located.withColumns(geo.region_flags(C("dist_to_coast"), C("dist_SF"), C("dist_LA"))
                                  | {"climate_zone": geo.latitude_zone(C("Latitude"))})
    products = housing.housing_interactions(
        C("MedInc"), C("HouseAge"), C("AveRooms"), C("dist_to_coast"), C("is_coastal"))
    ratios = housing.housing_ratios(C("AveBedrms"), C("AveRooms"), C("AveOccup"), C("Population"))
    return flagged.withColumns({
        "income_coast_interaction": products["income_coast_interaction"],
        "urban_density": ratios["urban_density"], "coastal_income": products["coastal_income"],
    }).drop(*geo.UNIT)


def feature_table(blocks: DataFrame, cap: float = fv.HOUSING_CAPS["target"]) -> DataFrame:
    """Clean blocks with every column and the median-split class."""
    kept = cleaning.range_filters(blocks, outlier_rules(cap))
    return enrich(engineer(kept)).withColumn("is_high_value", ordering.above_median(kept, "MedHouseVal"))


def feature_sets() -> dict[str, list[str]]:
    return {"base": RAW + DERIVED, "enriched": RAW + DERIVED + fv.GEO_ENRICHMENT}


def run_models(table: DataFrame, key: str, threads: int = 4) -> DataFrame:
    """Five regressors and five classifiers, base and enriched."""
    regression = grid.run_grid(
        sampling.split_by_hash(table, key), feature_sets(), "MedHouseVal",
        grid.regressors(POLY_CANDIDATES, alpha=0.01), grid.score_regression, grid.REG_METRICS, threads)
    binary = grid.run_grid(
        sampling.split_stratified(table, key, "is_high_value"), feature_sets(), "is_high_value",
        grid.classifiers(key), grid.score_binary, grid.CLF_METRICS, threads)
    return regression.unionByName(binary, allowMissingColumns=True)
