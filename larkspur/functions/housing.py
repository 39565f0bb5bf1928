"""Housing block features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.timeparts import flag


def housing_ratios(bedrooms: Column, rooms: Column, occupancy: Column,
                   population: Column) -> dict[str, Column]:
    """Ratios whose small offset keeps the divisor away from zero."""
    return {
        "bedroom_ratio": bedrooms / (rooms + F.lit(0.001)),
        "rooms_per_person": rooms / (occupancy + F.lit(0.001)),
        "pop_density": population / (occupancy + F.lit(0.001)),
        "urban_density": population / (occupancy + F.lit(0.1)),
    }


def housing_flags(age: Column, income: Column, occupancy: Column) -> dict[str, Column]:
    return {
        "is_new_house": flag(age <= 10),
        "is_old_house": flag(age >= 40),
        "is_low_income": flag(income < 3.0),
        "is_high_income": flag(income > 6.0),
        "is_crowded": flag(occupancy > 3.5),
    }


def housing_interactions(income: Column, age: Column, rooms: Column, to_coast: Column,
                         coastal: Column) -> dict[str, Column]:
    return {
        "income_age": income * age,
        "income_rooms": income * rooms,
        "income_coast_interaction": income * (1 / (to_coast + 1)),
        "coastal_income": income * coastal,
    }
