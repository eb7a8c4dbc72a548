"""Quality score of a table: completeness, consistency, validity, and deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import as_double, count_where, is_missing, is_numeric, percent
from plumbline.functions.text import strip
from plumbline.operators.profile import dataset_summary
from plumbline.operators.schema import BATHROOM_FORMAT, KEY_COLUMNS, PRICE_FORMAT, ROOM_TYPES

# Order of the metrics in a score table.
SUB_SCORES = ["completeness_score", "consistency_score", "validity_score"]


def _format_pct(df: DataFrame, column: str, pattern: str) -> Column:
    """Share of present values that start with the format; 100 when there are none."""
    present = F.col(column).isNotNull()
    match = strip(F.col(column).cast("string")).rlike(pattern)
    return F.coalesce(percent(count_where(present & match), F.count(column), 2), F.lit(100.0))


def _present_numeric_pct(column: str) -> Column:
    return F.when(F.count(column) > 0, 100.0).otherwise(0.0)


def _range_pct(value: Column, low: float, high: float | None) -> Column:
    """Share of present values inside the range; 100 when there are none."""
    inside = value >= low if high is None else value.between(low, high)
    return F.coalesce(percent(count_where(inside), F.count(value), 2), F.lit(100.0))


def quality_row(
    df: DataFrame,
    key: str | None = None,
    key_columns: Sequence[str] = KEY_COLUMNS,
    price_format: str = PRICE_FORMAT,
    bathroom_format: str = BATHROOM_FORMAT,
    room_types: Sequence[str] = ROOM_TYPES,
) -> DataFrame:
    """All metrics of the score in one row, from one aggregate.

    A metric whose columns are absent is neutral (100). ``key`` names the row
    key, which is not part of the table being scored.
    """
    names = [c for c in df.columns if c != key]
    rows = F.count("*")
    present = {c: count_where(~is_missing(df, c)) for c in names}
    cells_pct = percent(sum(present.values(), F.lit(0)), rows * len(names), 2)
    in_table = [c for c in key_columns if c in names]
    keys_pct = percent(sum((present[c] for c in in_table), F.lit(0)), rows * len(key_columns), 2)
    neutral = F.lit(100.0)

    id_pct = percent(F.count_distinct("id"), rows, 2) if "id" in names else neutral
    price_pct = neutral
    if "price" in names:
        price_pct = _present_numeric_pct("price") if is_numeric(df, "price") else _format_pct(df, "price", price_format)
    bath_pct = neutral
    if "bathrooms" in names and is_numeric(df, "bathrooms"):
        bath_pct = _present_numeric_pct("bathrooms")
    elif "bathrooms_text" in names:
        bath_pct = _format_pct(df, "bathrooms_text", bathroom_format)
    nights_pct = neutral
    if {"minimum_nights", "maximum_nights"} <= set(names):
        low, high = as_double(df, "minimum_nights"), as_double(df, "maximum_nights")
        both = low.isNotNull() & high.isNotNull()
        nights_pct = F.coalesce(percent(count_where(low <= high), count_where(both), 2), neutral)

    price_ok = _range_pct(as_double(df, "price", currency=True), 0.0, None) if "price" in names else neutral
    nights_ok = _range_pct(as_double(df, "minimum_nights"), 1, 365) if "minimum_nights" in names else neutral
    free_ok = _range_pct(as_double(df, "availability_365"), 0, 365) if "availability_365" in names else neutral
    room_ok = percent(count_where(F.col("room_type").isin(list(room_types))), rows, 2) if "room_type" in names else neutral
    place_ok = neutral
    if {"latitude", "longitude"} <= set(names):
        lat, lon = as_double(df, "latitude"), as_double(df, "longitude")
        good = count_where(lat.between(-90, 90)) + count_where(lon.between(-180, 180))
        place_ok = percent(good, rows * 2, 2)

    one = df.agg(
        rows.alias("total_rows"),
        cells_pct.alias("overall_cell_completeness_pct"),
        keys_pct.alias("key_columns_completeness_pct"),
        id_pct.alias("id_uniqueness_pct"),
        price_pct.alias("price_format_consistency_pct"),
        bath_pct.alias("bathrooms_format_consistency_pct"),
        nights_pct.alias("min_max_nights_logic_pct"),
        price_ok.alias("price_validity_pct"),
        nights_ok.alias("minimum_nights_validity_pct"),
        free_ok.alias("availability_365_validity_pct"),
        room_ok.alias("room_type_validity_pct"),
        place_ok.alias("geo_coordinates_validity_pct"),
    )

    def mean(columns: Sequence[str]) -> Column:
        return F.round(sum((F.col(c) for c in columns), F.lit(0.0)) / len(columns), 2)

    metrics = [c for c in one.columns if c != "total_rows"]
    scored = one.withColumns(
        {
            "completeness_score": mean(metrics[:2]),
            "consistency_score": mean(metrics[2:6]),
            "validity_score": mean(metrics[6:]),
        }
    )
    return scored.withColumn("overall_quality_score", mean(SUB_SCORES))


def quality_score(df: DataFrame, key: str | None = None, **options) -> DataFrame:
    """The score as a table ``(metric, score)``."""
    one = quality_row(df, key, **options)
    names = [c for c in one.columns if c != "total_rows"]
    return one.select(*names).unpivot([], names, "metric", "score")


def missing_gaps(df: DataFrame, key: str | None = None) -> DataFrame:
    """Columns with missing cells: count and share."""
    names = [c for c in df.columns if c != key]
    one = df.agg(F.count("*").alias("__n"), *[count_where(is_missing(df, c)).alias(c) for c in names])
    long = one.unpivot(["__n"], names, "column", "missing_count").where(F.col("missing_count") > 0)
    return long.select("column", "missing_count", percent(F.col("missing_count"), F.col("__n"), 2).alias("missing_pct"))


def quality_summary(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows, columns, cells and duplicate rows next to the scores."""
    return dataset_summary(df, key).withColumn("total_cells", F.col("total_rows") * F.col("total_columns"))


def quality_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """After minus before per metric, with a verdict on the overall score."""
    b = before.select("metric", F.col("score").alias("before_score"))
    a = after.select("metric", F.col("score").alias("after_score"))
    delta = F.round(F.col("after_score") - F.col("before_score"), 2)
    # One row per metric on both sides.
    return b.join(F.broadcast(a), "metric").select(
        "metric",
        "before_score",
        "after_score",
        delta.alias("delta"),
        F.when(delta > 0, "MEASURABLE_IMPROVEMENT_PASSED").otherwise("NO_IMPROVEMENT").alias("verdict"),
    )
