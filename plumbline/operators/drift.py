"""Distribution drift between two cohorts: KS statistic, p-value, Wasserstein-1."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.numeric import as_double, count_where, is_text
from plumbline.functions.quantiles import long_values, quantile_row, quantile_table
from plumbline.functions.running import running_totals
from plumbline.functions.scalars import scalar
from plumbline.operators.normalize import parse_date
from plumbline.session import settle

# Fixed values.
DRIFT_COLUMNS = ["price", "minimum_nights", "availability_365", "number_of_reviews"]
MIN_DATES = 20
MIN_SIDE = 5
ALPHA = 0.05
EXACT_ROWS = 10_000  # most rows of a sample for which the p-value is exact


def date_micros(df: DataFrame, column: str) -> Column:
    """A date or timestamp column as microseconds, so that a median can be taken."""
    if is_text(df, column):
        stamp = parse_date(df, column, day_first=False).cast("timestamp_ntz")
    else:
        stamp = F.col(column).cast("timestamp_ntz")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, stamp).cast("double")


def median_split(df: DataFrame, column: str) -> Column:
    """1 up to the median date, 2 after it, null without a date or with too few dates."""
    at = date_micros(df, column)
    split = scalar(
        quantile_table(df, {"d": at}, {"median": 0.5}).select(F.when(F.col("n") >= MIN_DATES, F.col("median")).alias("at"))
    )["at"]
    return F.when(at <= split, F.lit(1)).when(at > split, F.lit(2))


def median_date(df: DataFrame, column: str) -> Column:
    """The split date as ISO text."""
    micros = quantile_row(df, {"d": date_micros(df, column)}, {"median": 0.5}).scalar()
    return F.date_format(F.timestamp_micros(F.floor(micros).cast("bigint")), "yyyy-MM-dd")


def kolmogorov_p(statistic: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of the two-sample KS statistic (Smirnov 1948)."""
    scale = statistic * F.sqrt(n1.cast("double") * n2 / (n1 + n2))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * j * j * scale * scale),
    )
    # The alternating series does not converge near zero, where p is one.
    return F.when(scale < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def lattice_p(statistic: float, n1: int, n2: int) -> float:
    """Exact two-sided p-value of the two-sample KS statistic.

    Under the hypothesis all orders of the two samples are alike, so the pooled rows draw from the sample that has more
    left with that chance. The chance of each state (rows drawn from the smaller sample) is carried forward
    draw by draw; the p-value is what leaves the band in which the distance is below the statistic.
    """
    few, many = sorted((int(n1), int(n2)))
    both, shared = few + many, math.gcd(few, many)
    reach = round(statistic * (few // shared * many)) * shared  # of |both * i - few * t|, i of t draws from the smaller
    if reach == 0:
        return 1.0
    low, chance, left = 0, np.ones(1), 0.0
    for t in range(1, both + 1):
        i = np.arange(low, low + len(chance))
        rest = both - t + 1
        new = np.zeros(len(chance) + 1)
        new[:-1] = chance * (many - (t - 1 - i)) / rest
        new[1:] += chance * (few - i) / rest
        first = max(low, (few * t - reach) // both + 1)
        end = min(low + len(new), (few * t + reach - 1) // both + 1)
        if first >= end:
            return 1.0
        left += new[: first - low].sum() + new[end - low :].sum()
        low, chance = first, new[first - low : end - low]
    return min(left, 1.0)


@F.pandas_udf(T.DoubleType())
def exact_p(statistic: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    """:func:`lattice_p` of one row per column; null for samples of more than ``EXACT_ROWS``."""
    rows = zip(statistic, n1, n2, strict=True)
    return pd.Series([lattice_p(d, a, b) if max(a, b) <= EXACT_ROWS else None for d, a, b in rows], dtype="float64")


def cohort_counts(tagged: DataFrame, columns: Sequence[str], cohort: str = "cohort") -> DataFrame:
    """Rows of each cohort per (column, value), settled.

    The table is counted once; a value that fills a third of a column is one
    row after the map-side combine.
    """
    exprs = {c: as_double(tagged, c, currency=True) for c in columns}
    values = long_values(tagged.where(F.col(cohort).isNotNull()), exprs, [cohort])
    return settle(
        values.groupBy("column", "value").agg(
            count_where(F.col(cohort) == 1).alias("a"), count_where(F.col(cohort) == 2).alias("b")
        )
    )


def drift_between(tagged: DataFrame, columns: Sequence[str], cohort: str = "cohort") -> DataFrame:
    """Drift of each column between cohort 1 and cohort 2.

    Columns with five values or fewer on a side are left out. P-values are exact for samples of up to
    ``EXACT_ROWS`` rows, asymptotic beyond.
    """
    totals = cohort_counts(tagged, [c for c in columns if c in tagged.columns], cohort)
    counted = totals.groupBy("column").agg(
        F.sum("a").alias("n1"),
        F.sum("b").alias("n2"),
        F.try_divide(F.sum(F.col("a") * F.col("value")), F.sum("a")).alias("m1"),
        F.try_divide(F.sum(F.col("b") * F.col("value")), F.sum("b")).alias("m2"),
    )
    sizes = counted.where((F.col("n1") > MIN_SIDE) & (F.col("n2") > MIN_SIDE))
    steps = running_totals(totals, "column", "value", ["a", "b"])
    steps = steps.join(F.broadcast(sizes), "column")  # one row per column
    gap = F.abs(F.col("cum_a") / F.col("n1") - F.col("cum_b") / F.col("n2"))
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    measured = steps.groupBy("column", "n1", "n2", "m1", "m2").agg(
        F.max(gap).alias("ks"), F.sum(gap * width).alias("w")
    )
    measured = measured.withColumn("exact", exact_p("ks", "n1", "n2"))
    p = F.coalesce("exact", kolmogorov_p(F.col("ks"), F.col("n1"), F.col("n2")))
    return measured.select(
        "column",
        F.round("ks", 4).alias("ks_statistic"),
        F.round(p, 5).alias("p_value"),
        F.round("w", 4).alias("wasserstein_distance"),
        F.when(p < ALPHA, "DRIFT_DETECTED").otherwise("STABLE").alias("drift_status"),
        F.round("m1", 2).alias("cohort1_mean"),
        F.round("m2", 2).alias("cohort2_mean"),
        F.col("n1").alias("cohort1_size"),
        F.col("n2").alias("cohort2_size"),
    )


def drift_by_date(df: DataFrame, date_column: str, columns: Sequence[str] = DRIFT_COLUMNS) -> DataFrame:
    """Drift between rows up to the median date and rows after it.

    Empty when the date column is absent or holds fewer than 20 dates.
    """
    if date_column not in df.columns:
        df = df.withColumn("cohort", F.lit(None).cast("int"))
        return drift_between(df, columns).where(F.lit(False))
    kept = [c for c in columns if c in df.columns]
    tagged = df.select(*kept, median_split(df, date_column).alias("cohort"))
    return drift_between(tagged, kept)


def drift_report(df: DataFrame, date_column: str, columns: Sequence[str] = DRIFT_COLUMNS) -> DataFrame:
    """:func:`drift_by_date` with the date that splits the cohorts."""
    found = drift_by_date(df, date_column, columns)
    split = median_date(df, date_column) if date_column in df.columns else F.lit(None).cast("string")
    return found.withColumn("split_date", split)


def drift_between_tables(baseline: DataFrame, current: DataFrame, columns: Sequence[str] = DRIFT_COLUMNS) -> DataFrame:
    """Drift of a table against a baseline table."""
    shared = [c for c in columns if c in baseline.columns and c in current.columns]

    def side(df: DataFrame, cohort: int) -> DataFrame:
        return df.select(*[as_double(df, c, currency=True).alias(c) for c in shared], F.lit(cohort).alias("cohort"))

    return drift_between(side(baseline, 1).unionByName(side(current, 2)), shared)


