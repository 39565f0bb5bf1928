"""Calendar features. Every function maps columns to ``{name: Column}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur import fixed_values as fv


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def time_parts(ts: Column) -> dict[str, Column]:
    """Hour, day of month, day of week (Monday = 0) and month."""
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
    }


def weekend_flag(day_of_week: Column) -> Column:
    return flag(day_of_week >= 5)


def rush_flags(hour: Column, weekend: Column) -> dict[str, Column]:
    """Morning and evening rush on weekdays, and their union."""
    weekday = weekend == 0
    morning = flag(hour.between(*fv.MORNING_RUSH_HOURS) & weekday)
    evening = flag(hour.between(*fv.EVENING_RUSH_HOURS) & weekday)
    return {
        "is_morning_rush": morning,
        "is_evening_rush": evening,
        "is_rush_hour": morning.bitwiseOR(evening),
    }


def rush_compact(hour: Column, weekend: Column) -> Column:
    """The same flag as a product: (either window) x (1 - weekend)."""
    in_window = hour.between(*fv.MORNING_RUSH_HOURS) | hour.between(*fv.EVENING_RUSH_HOURS)
    return flag(in_window) * (F.lit(1) - weekend)


def night_flag(hour: Column, start: int = 22, end: int = 5) -> Column:
    """Night wraps midnight: from ``start`` through ``end``, both included."""
    return flag((hour >= start) | (hour <= end))


def night_flags(hour: Column, weekend: Column) -> dict[str, Column]:
    """The ride definition and its three variants."""
    return {
        "is_night": night_flag(hour),
        "is_night_early": night_flag(hour, 20, 4),
        "is_late_night": flag(hour.between(0, 3)),
        "is_night_after_midnight": flag(hour.between(0, 5)),
        "weekend_night": weekend * night_flag(hour, 20, 4),
    }


def day_part_flags(hour: Column) -> dict[str, Column]:
    parts = {
        f"is_{name}": flag((hour >= first) & (hour < end))
        for name, (first, end) in fv.DAY_PARTS.items()
    }
    return parts | {"is_night": night_flag(hour, 20, 4)}


def season_flags(month: Column, weekend: Column | None = None) -> dict[str, Column]:
    """Season flags; the weekend flag is 0 when only the month is known."""
    seasons = {f"is_{s}": flag(month.isin(m)) for s, m in fv.SEASON_MONTHS.items()}
    return seasons | {"is_weekend": F.lit(0) if weekend is None else weekend}


def calendar_extras(ts: Column) -> dict[str, Column]:
    return {
        "is_business_hours": flag(F.hour(ts).between(9, 17) & (F.weekday(ts) < 5)),
        "week_of_year": F.weekofyear(ts),
        "quarter": F.quarter(ts),
    }


def cyclic_encoding(hour: Column, day_of_week: Column) -> dict[str, Column]:
    """Position on the 24-hour and 7-day circles."""
    hour_angle = hour * (2 * F.pi() / 24)
    day_angle = day_of_week * (2 * F.pi() / 7)
    return {
        "hour_sin": F.sin(hour_angle),
        "hour_cos": F.cos(hour_angle),
        "dow_sin": F.sin(day_angle),
        "dow_cos": F.cos(day_angle),
    }


def hour_floor(ts: Column) -> Column:
    """Start of the hour. ``date_trunc`` would go through the session's time zone."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def week_floor(ts: Column) -> Column:
    """Midnight of the week's Monday."""
    return F.trunc(F.to_date(ts), "week").cast("timestamp_ntz")


def nearest_hour(ts: Column) -> Column:
    """Round to the nearest hour; exactly half past goes up.

    Rounding half to even would differ only at :30:00.000000.
    """
    return hour_floor(ts + F.expr("INTERVAL 30 MINUTES"))


def wall_seconds(ts: Column) -> Column:
    """Seconds since 1970 on the clock shown, whatever the session's time zone."""
    days = F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
