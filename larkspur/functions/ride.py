"""Ride features: surge and condition interactions, service class, enrichment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.functions.timeparts import flag


def surge_interactions(distance: Column, surge: Column | None, rainy: Column, rush: Column,
                       severity: Column) -> dict[str, Column]:
    """Products with the surge multiplier; a missing multiplier counts as 1."""
    factor = F.lit(1.0) if surge is None else F.coalesce(surge, F.lit(1.0))
    return {
        "distance_surge": distance * factor,
        "weather_surge": rainy * factor,
        "rush_surge": rush * factor,
        "severity_surge": severity * factor,
    }


def condition_interactions(rainy: Column, cold: Column, rush: Column, night: Column,
                           severe: Column, precip_probability: Column, visibility: Column,
                           distance: Column, pressure: Column) -> dict[str, Column]:
    return {
        "rain_rush": rainy * rush,
        "cold_night": cold * night,
        "rain_night": rainy * night,
        "bad_weather_rush": severe * rush,
        "precip_rush": precip_probability * rush,
        "visibility_distance": visibility * distance,
        "storm_indicator": flag((pressure < 1005) & (rainy == 1)),
    }


def premium_by_pattern(name: Column, pattern: str = fv.PREMIUM_PATTERN) -> Column:
    """1 where the service name contains the pattern, in any case; NULL gives 0."""
    return flag(name.rlike(f"(?i){pattern}"))


def premium_by_list(platform: Column, name: Column, lists: dict[str, list[str]]) -> dict[str, Column]:
    """One flag per platform from its own list of names, and their union."""
    flags = {
        f"{key.lower()}_premium": flag((platform == key) & name.isin(names))
        for key, names in lists.items()
    }
    union = reduce(lambda a, b: a.bitwiseOR(b), flags.values())
    return flags | {"is_premium": union}


def route_key(source: Column, destination: Column, link: str = "_") -> Column:
    return F.concat_ws(link, F.coalesce(source, F.lit("nan")), F.coalesce(destination, F.lit("nan")))


def event_window_flag(hour: Column, night: Column, weekend: Column) -> dict[str, Column]:
    """Crowds leaving an event on a weekday night.

    The first flag also asks for night, which starts at 22, so 21 never
    fires; the second leaves the night test out.
    """
    leaving = hour.isin(fv.EVENT_EXIT_HOURS) & (weekend == 0)
    return {
        "is_event_time": flag(leaving & (night == 1)),
        "is_event_time_wide": flag(leaving),
    }


def transit_delay_flag(rush: Column, rainy: Column) -> Column:
    return flag((rush == 1) & (rainy == 1))


def demand_zone_flag(source: Column, zones: list[str] = fv.DEMAND_ZONES) -> Column:
    """Membership of the raw place name, before any encoding."""
    return flag(source.isin(list(zones)))


def fuel_indicator(distance: Column, surge: Column | None = None) -> Column:
    """Long ride under surge; long ride alone when there is no surge column."""
    long_ride = distance > 5
    return flag(long_ride if surge is None else long_ride & (surge > 1.0))


def enrichment_interactions(distance: Column, event_time: Column, rainy: Column, rush: Column,
                            platform_code: Column, premium: Column | None = None) -> dict[str, Column]:
    """Products used by the enriched tables.

    ``premium_weather`` appears only when asked for: it leaks the class target.
    """
    out = {
        "distance_event_interaction": distance * event_time,
        "weather_rush_interaction": rainy * rush,
        "cab_weather_interaction": platform_code * rainy,
    }
    return out if premium is None else out | {"premium_weather_interaction": premium * rainy}


def fare_formula(distance_km: Column, rate: Column, hour: Column, monsoon: Column,
                 traffic: Column, fuel_price: Column | None = None,
                 noise: Column | None = None) -> Column:
    """(km x rate + share of fuel price) x peak x monsoon x traffic (+ noise)."""
    fuel = F.lit(fv.FUEL_PRICE_DEFAULT) if fuel_price is None else fuel_price
    fare = (
        (distance_km * rate + fuel * fv.FUEL_SHARE)
        * F.when(hour.isin(fv.PEAK_FARE_HOURS), fv.PEAK_FACTOR).otherwise(1.0)
        * F.when(monsoon == 1, fv.MONSOON_FACTOR).otherwise(1.0)
        * traffic
    )
    return fare if noise is None else fare + noise
