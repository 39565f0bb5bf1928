"""Registry of queries with their SQL counterparts.

A query is a function of ``Tables``. ``doubles`` are rounded and ``bigints``
cast in both engines, so the two results can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.sources import standins
from larkspur.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, tuple[str, list[str]]] = {}

_PRICED = "select * from rides where price is not null and price > 0"
_VIEWS = {
    "rides": (standins.RIDES_SQL, ()),
    "priced": (_PRICED, ("rides",)),
    "blocks": (standins.BLOCKS_SQL, ()),
    "flights": (standins.FLIGHTS_SQL, ()),
    "hourly": (standins.HOURLY_SQL, ()),
    "fuel": (standins.FUEL_SQL, ()),
    "calendar": (standins.CALENDAR_SQL, ()),
}


def view(name: str, sql: str, *needs: str) -> None:
    """Add a named stand-in view for use in SQL counterparts."""
    _VIEWS[name] = (sql, needs)


def with_views(names: list[str]) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _VIEWS[name][1]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return ""
    return "with " + ", ".join(f"{n} as ({_VIEWS[n][0]})" for n in ordered) + " "


def query(sql: str | None = None, uses: str = "", doubles: str = "", bigints: str = "", digits: int = 6,
          name: str | None = None):
    """Register a query, and its SQL unless it has none."""
    rounded, whole = doubles.split(), bigints.split()

    def register(fn: Callable[[Tables], DataFrame]):
        slug = name or fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(Tables(spark, folder))
            changes = {c: F.round(F.col(c), digits) + F.lit(0.0) for c in rounded}
            changes |= {c: F.col(c).cast("bigint") for c in whole}
            return df.select([changes[c].alias(c) if c in changes else F.col(f"`{c}`") for c in df.columns])

        run.__name__ = slug
        QUERIES[slug] = run
        if sql is not None:
            edits = [f"round({c}, {digits}) + 0e0 as {c}" for c in rounded]
            edits += [f"cast({c} as bigint) as {c}" for c in whole]
            replace = f" replace ({', '.join(edits)})" if edits else ""
            _SQL[slug] = (f"select *{replace} from ({sql})", uses.split())
        return fn

    return register


def oracles() -> dict[str, str]:
    """Complete SQL texts, each with the stand-in views it uses."""
    return {slug: with_views(uses) + sql for slug, (sql, uses) in _SQL.items()}
