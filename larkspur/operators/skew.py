"""Per-key values brought back to the rows they belong to.

There is one plan for every size. Catalyst broadcasts the smaller side when its
measured size allows; otherwise adaptive execution splits the partitions that a
hot key makes large (inner, left, semi and anti joins), whatever the rows hold.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a computed table that are sent to every task. More are joined by key, which deals rows over as many tasks as there are keys.
SENT_ROWS = 100_000


def sent_if_few(side: DataFrame) -> DataFrame:
    """A computed table marked to be sent to the rows it is joined to, if its rows are few.

    Catalyst's estimate of what joins and aggregates leave is their inputs'
    size, and a join by key of two classes would put all rows into two tasks.
    """
    return F.broadcast(side) if side.count() <= SENT_ROWS else side


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows to a table with one row per key."""
    return big.join(small, list(on), how)
