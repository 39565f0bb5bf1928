"""Great-circle distances and regions.

Reference points are short fixed lists, so they are folded into one
expression per row: no join, no shuffle, and nothing to broadcast.

The row's position is turned into a unit vector once. The squared chord to a
point then takes three differences, the nearest point is the smallest chord,
and a single arcsine turns the winner into miles. Differences keep short
distances exact, as the haversine form does.
"""

from __future__ import annotations

from math import cos, nan, radians, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.functions.timeparts import flag

UNIT = ("_ux", "_uy", "_uz")


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    return 2 * fv.EARTH_RADIUS_MILES * F.asin(F.sqrt(chord))


def with_unit_vector(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Add the position on the unit sphere.

    Missing coordinates become NaN, and so do their distances. The columns
    are then never NULL: the long expressions carry no null checks, and the
    optimizer drops the not-null filters it would otherwise copy them into.
    """
    phi, theta = F.radians(lat), F.radians(lon)
    values = (F.cos(phi) * F.cos(theta), F.cos(phi) * F.sin(theta), F.sin(phi))
    return df.withColumns({u: F.coalesce(v, F.lit(nan)) for u, v in zip(UNIT, values)})


def _chord2(point: tuple[float, float]) -> str:
    phi, theta = radians(point[0]), radians(point[1])
    target = (cos(phi) * cos(theta), cos(phi) * sin(theta), sin(phi))
    return " + ".join(f"({u} - {t!r}D) * ({u} - {t!r}D)" for u, t in zip(UNIT, target))


def _miles(chord2: str) -> str:
    return f"{2 * fv.EARTH_RADIUS_MILES} * asin(sqrt({chord2}) / 2D)"


def miles_to(point: tuple[float, float]) -> Column:
    """Miles from the row's unit vector to one point."""
    return F.expr(_miles(_chord2(point)))


def nearest_miles(points=fv.COAST_POINTS) -> Column:
    """Miles to the nearest of several points."""
    return F.expr(_miles(f"least({', '.join(_chord2(p) for p in points)})"))


def nearest_point(points=fv.COAST_POINTS) -> Column:
    """Struct (distance, point): miles to the nearest point and its 0-based position.

    Structs compare field by field, so equal distances resolve to the lower
    position.
    """
    best = F.expr("array_min(array({}))".format(
        ", ".join(f"struct({_chord2(p)} as chord2, {i} as point)" for i, p in enumerate(points))))
    distance = 2 * fv.EARTH_RADIUS_MILES * F.asin(F.sqrt(best["chord2"]) / 2)
    return F.struct(distance.alias("distance"), F.coalesce(best["point"], F.lit(-1)).alias("point"))


def city_distances(cities=fv.CITIES) -> dict[str, Column]:
    """One column per city, then the smallest of them."""
    columns = {f"dist_{name}": miles_to(p) for name, p in cities.items()}
    return columns | {"dist_nearest_city": nearest_miles(cities.values())}


def region_flags(to_coast: Column, to_first_city: Column, to_second_city: Column) -> dict[str, Column]:
    return {
        "is_coastal": flag(to_coast < fv.COASTAL_MILES),
        "is_bay_area": flag(to_first_city < fv.BAY_MILES),
        "is_socal": flag(to_second_city < fv.SOUTH_MILES),
    }


def latitude_zone(lat: Column) -> Column:
    """Zones 1 to 4, south to north; a cut belongs to the zone above it."""
    first, second, third = fv.ZONE_CUTS
    return (
        F.when(lat < first, 1).when(lat < second, 2).when(lat < third, 3).when(lat >= third, 4)
    )
