"""Distance bands, transforms and price bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.functions.timeparts import flag


def band_flags(x: Column, cuts: tuple[float, float], names: tuple[str, str, str]) -> dict[str, Column]:
    """Three left-closed bands split at two cuts."""
    low, high = cuts
    return {
        names[0]: flag(x < low),
        names[1]: flag((x >= low) & (x < high)),
        names[2]: flag(x >= high),
    }


def ride_bands(distance: Column) -> dict[str, Column]:
    return band_flags(distance, fv.RIDE_CUTS_MILES, ("short_ride", "medium_ride", "long_ride"))


def haul_bands(distance: Column) -> dict[str, Column]:
    return band_flags(distance, fv.HAUL_CUTS_MILES, ("short_haul", "medium_haul", "long_haul"))


def band_label(x: Column, cuts=fv.RIDE_CUTS_MILES) -> Column:
    """Label written from the cuts themselves, so it cannot disagree with them."""
    low, high = cuts
    return (
        F.when(x < low, f"short (<{low})")
        .when(x < high, f"medium ({low}-{high})")
        .when(x >= high, f"long (>={high})")
    )


def right_closed_band(x: Column, edges: list[float], labels: list[str]) -> Column:
    """Bins (a, b] with a label each; values outside every bin give NULL."""
    out = None
    for left, right, label in zip(edges, edges[1:], labels):
        inside = (x > left) & (x <= right)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def price_band(price: Column, top: float | None = None) -> Column:
    edges = fv.PRICE_BAND_EDGES if top is None else fv.PRICE_BAND_EDGES[:-1] + [top]
    return right_closed_band(price, edges, fv.PRICE_BAND_LABELS)


def tier_of(x: Column, cuts: list[float]) -> Column:
    """Class index by ascending cuts; a value equal to a cut goes low."""
    out = F.when(x.isNull(), F.lit(None).cast("int"))
    for index, cut in enumerate(cuts):
        out = out.when(x <= F.lit(cut), index)
    return out.otherwise(len(cuts))


def label_of(index: Column, names: list[str]) -> Column:
    """Name at a small integer position (0-based); outside the list gives NULL."""
    return F.get(F.array(*[F.lit(n) for n in names]), index)
