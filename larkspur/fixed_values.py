"""Thresholds, lookup tables and reference coordinates.

Everything in this file is a constant that results depend on. Nothing here is
computed; change a value only when the definition of a feature changes.
"""

# --- calendar -------------------------------------------------------------
MORNING_RUSH_HOURS = (7, 9)
EVENING_RUSH_HOURS = (17, 19)
SEASON_MONTHS = {
    "winter": [12, 1, 2],
    "spring": [3, 4, 5],
    "summer": [6, 7, 8],
    "fall": [9, 10, 11],
}
# name -> [first hour, end hour)
DAY_PARTS = {
    "early_morning": (5, 8),
    "morning": (8, 12),
    "afternoon": (12, 16),
    "evening": (16, 20),
}
EVENT_EXIT_HOURS = [21, 22, 23]
PEAK_FARE_HOURS = [8, 9, 17, 18]

# --- distance and price bands ---------------------------------------------
RIDE_CUTS_MILES = (2, 5)
HAUL_CUTS_MILES = (500, 1500)
PRICE_BAND_EDGES = [0, 10, 15, 25, 1000]
PRICE_BAND_LABELS = ["low", "mid", "high", "premium"]
TIER_NAMES = ["Budget", "Economy", "Premium", "Luxury"]
SURGE_LEVELS = [1.0, 1.25, 1.5, 1.75, 2.0, 2.5, 3.0]
SURGE_LABELS = ["1x", "1.25x", "1.5x", "1.75x", "2x", "2.5x", "3x"]
SEVERITY_LABELS = {0: "Clear", 1: "Moderate", 2: "Severe"}

# --- code of a service in alphabetical order -> its name --------------------
SERVICE_NAMES = {
    0: "Black", 1: "Black SUV", 2: "Lux", 3: "Lux Black", 4: "Lux Black XL",
    5: "Lyft", 6: "Lyft XL", 7: "Shared", 8: "Taxi", 9: "UberPool",
    10: "UberX", 11: "UberXL", 12: "WAV",
}

# --- service classes ------------------------------------------------------
PREMIUM_PATTERN = "Black|Lux|SUV|XL"

# --- pickup zones with high demand: short list used by the feature, and the
# --- longer list from the feature documentation ---------------------------
DEMAND_ZONES = [
    "North Station", "South Station", "TD Garden", "Fenway", "Back Bay",
]
DEMAND_ZONES_LONG = [
    "North Station", "South Station", "Back Bay", "Fenway",
    "Theatre District", "Financial District", "Seaport",
    "Boston University", "Northeastern University", "Harvard Square",
    "MIT/Kendall",
]

# --- transit: stations by line, and probability of a delay -----------------
LINE_STATIONS = {
    "red": ["South Station", "Park Street", "Harvard"],
    "green": ["Copley", "Kenmore", "North Station"],
    "orange": ["North Station", "State", "Downtown Crossing"],
    "blue": ["Airport", "Maverick"],
}
DELAY_PROBABILITY = {
    "weekday_morning": 0.15,
    "weekday_evening": 0.20,
    "weekend": 0.05,
    "rain": 0.30,
    "snow": 0.60,
}

# --- geography ------------------------------------------------------------
EARTH_RADIUS_MILES = 3959
# (latitude, longitude) along the coast, south to north
COAST_POINTS = [
    (32.54, -117.12), (32.72, -117.17), (33.01, -117.29), (33.19, -117.38),
    (33.46, -117.60), (33.62, -117.93), (33.74, -118.29), (33.86, -118.40),
    (33.95, -118.47), (34.03, -118.77), (34.40, -119.69), (34.95, -120.44),
    (35.37, -120.85), (35.63, -121.19), (36.22, -121.76), (36.60, -121.89),
    (36.96, -122.02), (37.50, -122.43), (37.62, -122.49), (37.79, -122.51),
    (37.83, -122.48), (38.06, -122.70), (38.30, -123.07), (38.79, -123.59),
    (39.43, -123.81), (40.44, -124.10), (40.80, -124.16), (41.06, -124.14),
    (41.76, -124.20),
]
CITIES = {
    "SF": (37.7749, -122.4194),
    "LA": (34.0522, -118.2437),
    "San_Diego": (32.7157, -117.1611),
    "Sacramento": (38.5816, -121.4944),
    "San_Jose": (37.3382, -121.8863),
}
EXTRA_CITIES = {
    "Oakland": (37.8044, -122.2712),
    "Fresno": (36.7378, -119.7871),
}
ZONE_CUTS = [34, 36, 38]
ZONE_NAMES = {1: "warm", 2: "mediterranean", 3: "temperate", 4: "cool"}
COASTAL_MILES = 30
BAY_MILES = 50
SOUTH_MILES = 60

# --- housing outlier caps -------------------------------------------------
HOUSING_CAPS = {"target": 5.0001, "AveOccup": 10, "AveRooms": 15, "AveBedrms": 5}

# --- synthetic fares ------------------------------------------------------
FARE_RATES = {"Rickshaw": 15, "UberGo": 18, "Premier": 25}
FUEL_PRICE_DEFAULT = 89.50
FUEL_SHARE = 0.05
PEAK_FACTOR = 1.4
MONSOON_FACTOR = 1.3
MONSOON_SHARE = 0.2
# cumulative share -> level
TRAFFIC_LEVELS = [(0.5, 1.0), (0.8, 1.5), (1.0, 2.0)]

# --- feature lists of the studies, as published; "_enc" columns are codes ----
SURGE_FEATURES = [
    "hour", "hour_sin", "hour_cos", "day_of_week", "is_weekend",
    "is_morning_rush", "is_evening_rush", "is_rush_hour", "is_night", "is_late_night",
    "temperature", "humidity", "windSpeed", "precipIntensity", "precipProbability",
    "visibility", "pressure", "cloudCover", "windGust", "dewPoint",
    "is_rainy", "is_cold", "wind_chill", "low_visibility", "high_precip_prob",
    "low_pressure", "high_wind", "overcast", "severe_weather",
    "rain_rush", "cold_night", "rain_night", "bad_weather_rush",
    "distance", "short_ride", "long_ride",
    "cab_type_enc", "source_enc", "destination_enc",
]
SERVICE_FEATURES = [
    "distance", "distance_sq", "hour", "hour_sin", "hour_cos",
    "day_of_week", "is_weekend", "is_rush_hour", "is_night",
    "temperature", "humidity", "windSpeed", "precipIntensity",
    "is_rainy", "is_cold", "wind_chill", "low_visibility",
    "rain_rush", "source_enc", "destination_enc",
]

# --- enrichment study: raw and derived columns, recorded results ------------
RAW_ENRICHMENT = [
    "apparentTemperature", "precipProbability", "visibility", "pressure",
    "windGust", "cloudCover", "dewPoint",
]
DERIVED_ENRICHMENT = [
    "wind_chill", "low_visibility", "storm_indicator", "high_gust",
    "precip_rush", "visibility_distance", "severe_composite",
]
GEO_ENRICHMENT = [
    "dist_to_coast", "dist_SF", "dist_LA", "dist_San_Diego",
    "dist_Sacramento", "dist_San_Jose", "dist_nearest_city", "is_coastal",
    "is_bay_area", "is_socal", "climate_zone", "income_coast_interaction",
    "urban_density", "coastal_income",
]
RECORDED_RESULTS = {
    "reg_best_r2": 0.9639,
    "reg_avg_r2": 0.7755,
    "reg_enrichment": 0.0,
    "clf_best_f1": 0.6892,
    "clf_avg_f1": 0.6488,
    "clf_enrichment": 0.001,
}
DELTA_BAND = 0.001
VERDICT_BAND = 0.0005

# --- investment score -----------------------------------------------------
COASTAL_PREMIUM = 0.5
GROWTH_PREMIUM = 0.2
INVESTMENT_CUTS = [0.3, 0.6, 0.9]
INVESTMENT_TIERS = ["Underperforming", "Moderate", "Strong Value", "Prime Investment"]
