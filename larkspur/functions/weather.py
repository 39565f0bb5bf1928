"""Weather flags and severity scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.timeparts import flag


def weather_flags(rain: Column, temperature: Column, humidity: Column, *, cold: float = 40,
                  hot: float = 75, humid: float = 70) -> dict[str, Column]:
    """Rain, cold, heat and humidity flags.

    Humidity comes as a share in some inputs and as a percentage in others;
    set ``humid`` to the scale at hand (0.8 for shares).
    """
    return {
        "is_rainy": flag(rain > 0),
        "is_cold": flag(temperature < cold),
        "is_hot": flag(temperature > hot),
        "is_high_humidity": flag(humidity > humid),
    }


def extended_flags(temperature: Column, apparent: Column, visibility: Column,
                   precip_probability: Column, pressure: Column, gust: Column,
                   cloud: Column) -> dict[str, Column]:
    return {
        "wind_chill": apparent - temperature,
        "low_visibility": flag(visibility < 3),
        "high_precip_prob": flag(precip_probability > 0.5),
        "low_pressure": flag(pressure < 1005),
        "high_wind": flag(gust > 20),
        "high_gust": flag(gust > 15),
        "overcast": flag(cloud > 0.8),
    }


def severity_scores(rainy: Column, cold: Column, humid: Column, low_visibility: Column,
                    high_wind: Column, low_pressure: Column,
                    high_precip_prob: Column) -> dict[str, Column]:
    """Sums of flags; ``enhanced`` weighs rain twice, adverse means 2 or more."""
    enhanced = rainy * 2 + cold + humid
    return {
        "weather_severity": rainy + cold + humid,
        "weather_severity_two": rainy + cold,
        "severe_weather": rainy + cold + low_visibility + high_wind,
        "severe_composite": low_visibility + low_pressure + high_wind + high_precip_prob,
        "weather_severity_enhanced": enhanced,
        "is_adverse_weather": flag(enhanced >= 2),
    }


def hourly_severity(temp_c: Column, precipitation: Column, wind: Column) -> dict[str, Column]:
    """Metric flags on an hourly weather table, and their sum from 0 to 5."""
    raining = flag(precipitation > 0)
    heavy = flag(precipitation > 5)
    cold = flag(temp_c < 5)
    hot = flag(temp_c > 30)
    windy = flag(wind > 20)
    return {
        "is_raining": raining,
        "is_heavy_rain": heavy,
        "is_cold": cold,
        "is_hot": hot,
        "is_windy": windy,
        "is_storm": raining * windy,
        "weather_severity_score": raining + heavy + cold + hot + windy,
    }
