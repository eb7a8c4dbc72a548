"""Column and row flags: personal data, mixed formats, impossible values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.numeric import as_double, count_where, percent
from plumbline.functions.text import strip
from plumbline.operators.profile import column_profile

# Column names that hold personal data, with their category.
PII_COLUMNS = {
    "host_name": "Direct Identifier (Name)",
    "host_id": "Direct Identifier (ID)",
    "latitude": "Location PII",
    "longitude": "Location PII",
    "host_url": "Direct Identifier (URL)",
    "listing_url": "Location PII (URL)",
    "host_location": "Location PII",
    "host_about": "Quasi-Identifier / Free Text",
    "host_thumbnail_url": "Biometric / Media PII",
    "host_picture_url": "Biometric / Media PII",
}
PII_REASONS = {
    "host_name": "names a person",
    "host_id": "stands for one person in the system",
    "latitude": "places a home",
    "longitude": "places a home",
    "host_url": "leads to a person's page",
    "listing_url": "leads to one home's page",
    "host_location": "tells where a person lives",
    "host_about": "free text that may hold personal details",
    "host_thumbnail_url": "shows a person's face",
    "host_picture_url": "shows a person's face",
}
REQUIRED_PII = ["host_name", "host_id", "latitude", "longitude"]

# Personal data inside text.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?[0-9]{0,2}[ .-]?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}

# Classes of bathroom text, first match wins.
BATHROOM_CLASSES = {
    "half_bath_text": "half",
    "shared_or_private_text": "shared|private",
    "standard_numeric_bath": r"^\d+(\.\d+)?\s+(bath|baths)$",
}
ZERO_PRICES = ["$0.00", "$0", "0", "0.0", "$0.0"]


def pii_columns(df: DataFrame, names: Mapping[str, str] = PII_COLUMNS) -> DataFrame:
    """Columns whose name marks personal data. Needs the schema only."""
    found = [
        (c, names[c.lower()], PII_REASONS.get(c.lower()), c.lower() in REQUIRED_PII) for c in df.columns if c.lower() in names
    ]
    return df.sparkSession.createDataFrame(found, "column string, category string, reason string, required boolean")


def pii_profile(df: DataFrame, key: str, names: Mapping[str, str] = PII_COLUMNS) -> DataFrame:
    """The personal-data columns with their present and distinct values."""
    found = pii_columns(df, names)
    held = df.select(key, *[c for c in df.columns if c.lower() in names])
    # One row per column on both sides.
    return column_profile(held, key).join(F.broadcast(found), "column").select(
        "column", "category", "required", "non_null_count", "unique_count"
    )


def required_pii_present(df: DataFrame, required: Sequence[str] = REQUIRED_PII) -> bool:
    return set(required) <= {c.lower() for c in df.columns}


def pii_scan(df: DataFrame, columns: Sequence[str], patterns: Mapping[str, str] = PII_PATTERNS) -> DataFrame:
    """Rows and matches per (text column, kind), counted over the whole text in one scan."""
    hits = [(c, kind, F.regexp_count(c, F.lit(p))) for c in columns for kind, p in patterns.items()]
    one = df.agg(
        *[
            a
            for i, (_, _, n) in enumerate(hits)
            for a in (
                count_where(n > 0).alias(f"r{i}"),
                F.coalesce(F.sum(n.cast("bigint")), F.lit(0)).alias(f"m{i}"),
            )
        ]
    )
    rows = ", ".join(f"'{c}', '{kind}', r{i}, m{i}" for i, (c, kind, _) in enumerate(hits))
    return one.selectExpr(f"stack({len(hits)}, {rows}) AS (column, kind, rows_with_match, matches)")


def format_classes(
    df: DataFrame, column: str = "bathrooms_text", classes: Mapping[str, str] = BATHROOM_CLASSES
) -> DataFrame:
    """Rows and distinct values per format class; every class has a row.

    Values are grouped first, so the patterns run once per distinct value.
    """
    values = df.groupBy(column).agg(F.count("*").alias("c"))
    text = F.lower(strip(F.col(column)))
    chosen = F.when(F.col(column).isNull(), "null")
    for name, pattern in classes.items():
        chosen = chosen.when(text.rlike(f"(?U){pattern}"), name)  # digits and blanks of all scripts, as published
    grouped = (
        values.groupBy(chosen.otherwise("other_unclassified").alias("class"))
        .agg(F.sum("c").alias("row_count"), F.count(column).alias("distinct_values"))
    )
    every = df.sparkSession.createDataFrame([(n,) for n in [*classes, "other_unclassified", "null"]], "class string")
    return every.join(F.broadcast(grouped), "class", "left").select(  # one row per class
        "class",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
    )


def format_samples(df: DataFrame, key: str, column: str = "bathrooms_text", limit: int = 10) -> DataFrame:
    """The first distinct values of a column, by first appearance."""
    values = df.where(F.col(column).isNotNull()).groupBy(strip(F.col(column)).alias("value"))
    return values.agg(F.min(key).alias("first_key")).orderBy("first_key").limit(limit)


def zero_price(column: str = "price") -> Column:
    text = strip(F.col(column).cast("string"))
    return text.isin(ZERO_PRICES) | (F.trim(F.regexp_replace(text, "[$,]", "")) == "0.00")


def suspicious_predicates(df: DataFrame) -> dict[str, Column]:
    """Row flags that apply to the columns at hand."""
    found = {}
    if "price" in df.columns:
        found["zero_price_rows"] = F.coalesce(zero_price(), F.lit(False))
    if "minimum_nights" in df.columns:
        found["extreme_minimum_nights"] = F.coalesce(as_double(df, "minimum_nights") > 365, F.lit(False))
    return found


def suspicious_rows(df: DataFrame, predicates: Mapping[str, Column] | None = None) -> DataFrame:
    """Count and share of the rows behind each flag."""
    flags = predicates or suspicious_predicates(df)
    one = df.agg(F.count("*").alias("n"), *[count_where(p).alias(name) for name, p in flags.items()])
    long = one.unpivot(["n"], list(flags), "flag", "row_count")
    return long.select(
        "flag",
        (F.col("row_count") > 0).alias("flagged"),
        "row_count",
        F.coalesce(percent(F.col("row_count"), F.col("n"), 4), F.lit(0.0)).alias("pct"),
    )


def suspicious_samples(
    df: DataFrame, key: str, predicates: Mapping[str, Column] | None = None, limit: int = 10
) -> DataFrame:
    """The first flagged row keys per flag (a report of ``limit`` rows each)."""
    flags = predicates or suspicious_predicates(df)
    tags = F.array_compact(F.array(*[F.when(p, F.lit(name)) for name, p in flags.items()]))
    tagged = df.where(reduce(lambda a, b: a | b, flags.values())).select(F.explode(tags).alias("flag"), key)
    first = Window.partitionBy("flag").orderBy(key)
    return tagged.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= limit)
