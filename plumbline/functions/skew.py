"""Lookup of a per-group row when a few groups hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import settle

# A table of at most so many rows is broadcast, after it was counted.
BROADCAST_ROWS = 50_000


def sized(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` settled and counted, marked for broadcast if it has at most ``rows`` rows.

    A larger one takes part in an ordinary shuffle join, whose hot keys adaptive execution splits.
    """
    settled = settle(table)
    return F.broadcast(settled) if settled.count() <= rows else settled


def lookup_groups(
    rows: DataFrame, groups: DataFrame, on: Sequence[str], how: str = "left", counted: int | None = None
) -> DataFrame:
    """Join ``rows`` to ``groups`` (one row per key, null keys equal); both are read once.

    ``counted``: an upper bound of the rows of ``groups``, where the caller knows one.
    """
    extra = [c for c in groups.columns if c not in on]
    renamed = groups.select(*[F.col(c).alias(f"__g_{c}") for c in on], *extra)
    if counted is None:
        table = sized(renamed)
    else:
        table = F.broadcast(renamed) if counted <= BROADCAST_ROWS else renamed
    return rows.join(table, _same(on), how).select(*rows.columns, *extra)


def _same(on: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in on])
