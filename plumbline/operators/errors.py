"""Statistical row errors: fences, impossible values, z-scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import as_double
from plumbline.functions.quantiles import quantile_row, quantile_table
from plumbline.functions.scalars import attach
from plumbline.operators.issues import Check, finding_log, finding_summary

# Fixed values.
FENCE_FACTOR = 3.0
NIGHTS_FENCE_FLOOR = 30.0
MAX_NIGHTS = 365
HIGH_PRICE = 500
CRITICAL_ERRORS = ["IMPOSSIBLE_PRICE", "IMPOSSIBLE_MIN_NIGHTS", "MIN_NIGHTS_GREATER_THAN_MAX"]


def upper_fences(df: DataFrame) -> DataFrame:
    """One row: upper fences of price and minimum nights."""
    values = {"price": as_double(df, "price", currency=True), "nights": as_double(df, "minimum_nights")}
    q = quantile_row(df, values, {"q1": 0.25, "q3": 0.75})
    return q.select(
        (F.col("price_q3") + FENCE_FACTOR * (F.col("price_q3") - F.col("price_q1"))).alias("price_fence"),
        F.greatest(
            F.lit(NIGHTS_FENCE_FLOOR),
            F.col("nights_q3") + FENCE_FACTOR * (F.col("nights_q3") - F.col("nights_q1")),
        ).alias("nights_fence"),
    )


def with_fences(df: DataFrame) -> DataFrame:
    """Rows with the fences attached, as :func:`error_checks` needs them."""
    return attach(df, upper_fences(df), "__fences")


def error_checks(df: DataFrame) -> list[Check]:
    """The six statistical checks, for the rows of :func:`with_fences`."""
    fence = F.col("__fences")
    price = as_double(df, "price", currency=True)
    nights = as_double(df, "minimum_nights")
    free = as_double(df, "availability_365")

    def check(name: str, column: str, fails: Column, value: Column, details: str) -> Check:
        severity = "CRITICAL" if name in CRITICAL_ERRORS else "HIGH"
        return Check(name, name, "statistical_error", severity, column, details, fails, value, F.lit(details))

    found = [
        check("IMPOSSIBLE_PRICE", "price", price <= 0, price, "price is not above 0"),
        check(
            "EXTREME_PRICE_OUTLIER",
            "price",
            (price > 0) & (price > fence["price_fence"]),
            price,
            "price is above the 3 IQR fence",
        ),
        check("IMPOSSIBLE_MIN_NIGHTS", "minimum_nights", nights > MAX_NIGHTS, nights, "minimum stay exceeds a year"),
        check(
            "EXTREME_MIN_NIGHTS_OUTLIER",
            "minimum_nights",
            (nights <= MAX_NIGHTS) & (nights > fence["nights_fence"]),
            nights,
            "minimum stay is above the 3 IQR fence",
        ),
        check(
            "SUSPICIOUS_UNAVAILABLE_HIGH_PRICE",
            "availability_365",
            (free == 0) & (price > HIGH_PRICE),
            free,
            "never available at a high price",
        ),
    ]
    if "maximum_nights" in df.columns:
        found.append(
            check(
                "MIN_NIGHTS_GREATER_THAN_MAX",
                "minimum_nights",
                nights > as_double(df, "maximum_nights"),
                nights,
                "minimum stay exceeds the maximum stay",
            )
        )
    return found


def statistical_errors(df: DataFrame, key: str, row_id: str = "id") -> DataFrame:
    """Error log: one row per finding."""
    log = finding_log(with_fences(df), error_checks(df), key, row_id)
    return log.withColumnRenamed("check_name", "error_type").drop("check_id")


def error_summary(df: DataFrame) -> DataFrame:
    return finding_summary(with_fences(df), error_checks(df)).select(
        F.col("check_name").alias("error_type"), "violation_count", "violation_pct"
    )


def zscore_outliers(df: DataFrame, columns: Sequence[str], keys: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Rows further than ``threshold`` deviations from the mean of a column."""
    value = {c: as_double(df, c) for c in columns}
    moments = df.agg(
        *[
            a
            for c in columns
            for a in (F.avg(value[c]).alias(f"{c}_mean"), F.stddev_samp(value[c]).alias(f"{c}_std"))
        ]
    )
    stats = F.col("__stats")
    hits = []
    for c in columns:
        z = F.try_divide(value[c] - stats[f"{c}_mean"], stats[f"{c}_std"])
        hits.append(
            F.when(
                F.abs(z) > threshold,
                F.struct(F.lit(c).alias("column"), value[c].alias("value"), F.round(z, 4).alias("z_score")),
            )
        )
    rows = attach(df, moments, "__stats").select(*keys, F.array_compact(F.array(*hits)).alias("h"))
    return rows.select(*keys, F.inline("h"))


def iqr_outliers(df: DataFrame, columns: Sequence[str], keys: Sequence[str], factor: float = FENCE_FACTOR) -> DataFrame:
    """Rows above ``q3 + factor * IQR`` of any column."""
    value = {c: as_double(df, c) for c in columns}
    q = quantile_table(df, value, {"q1": 0.25, "q3": 0.75})
    limits = q.agg(
        *[
            F.max(F.when(F.col("column") == c, F.col("q3") + factor * (F.col("q3") - F.col("q1")))).alias(c)
            for c in columns
        ]
    )
    fences = F.col("__fences")
    hits = [
        F.when(
            value[c] > fences[c],
            F.struct(F.lit(c).alias("column"), value[c].alias("value"), fences[c].alias("fence")),
        )
        for c in columns
    ]
    rows = attach(df, limits, "__fences").select(*keys, F.array_compact(F.array(*hits)).alias("h"))
    return rows.select(*keys, F.inline("h"))
