"""One-row statistics as scalar subqueries.

A statistic such as a median stays in the plan as a subquery, so nothing is
collected on the driver and no join is needed to bring it to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, stats: DataFrame, name: str) -> DataFrame:
    """Add a one-row table to every row as the struct column ``name``.

    All fields come from one subquery, however often they are used.
    """
    return df.withColumn(name, scalar(stats))


def scalar(stats: DataFrame) -> Column:
    """A one-row table as a struct-valued scalar subquery."""
    return stats.select(F.struct(*[F.col(c) for c in stats.columns]).alias("s")).scalar()
