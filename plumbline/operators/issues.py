"""Shared form of row findings: all checks of a row in one pass.

A check is a predicate plus the columns it reports. All checks of a row become
one array of structs, which is exploded once: one scan, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import count_where, percent


@dataclass(frozen=True)
class Check:
    """One row check; ``fails`` is true for a finding (null counts as no finding)."""

    check_id: str
    name: str
    category: str
    severity: str
    columns: str
    description: str
    fails: Column
    value: Column
    details: Column


def finding_log(df: DataFrame, checks: Sequence[Check], key: str, row_id: str = "id") -> DataFrame:
    """One row per finding."""
    identity = F.col(row_id).cast("string") if row_id in df.columns else F.col(key).cast("string")
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    c.fails,
                    F.struct(
                        F.lit(c.check_id).alias("check_id"),
                        F.lit(c.name).alias("check_name"),
                        F.lit(c.severity).alias("severity"),
                        F.lit(c.columns).alias("column"),
                        c.value.cast("string").alias("value"),
                        c.details.alias("details"),
                    ),
                )
                for c in checks
            ]
        )
    )
    rows = df.select(F.col(key), F.coalesce(identity, F.col(key).cast("string")).alias("listing_id"), found.alias("f"))
    return rows.select(key, "listing_id", F.inline("f"))


def finding_summary(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Findings per check, checks without findings included."""
    one = df.agg(F.count("*").alias("n"), *[count_where(c.fails).alias(f"c{i}") for i, c in enumerate(checks)])
    parts = F.array(
        *[
            F.struct(
                F.lit(c.check_id).alias("check_id"),
                F.lit(c.name).alias("check_name"),
                F.lit(c.category).alias("category"),
                F.lit(c.description).alias("description"),
                F.col(f"c{i}").alias("violation_count"),
                F.coalesce(percent(F.col(f"c{i}"), F.col("n"), 2), F.lit(0.0)).alias("violation_pct"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return one.select(F.inline(parts))
