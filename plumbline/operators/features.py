"""Categorical codes and derived numeric features."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import as_double, round_half_even
from plumbline.functions.running import numbered
from plumbline.operators.normalize import DEFAULT_DATE, DEFAULT_TENURE_DAYS, parse_date

# Codes of the room types.
ROOM_TYPE_CODES = {"Entire home/apt": 0, "Private room": 1, "Hotel room": 2, "Shared room": 3}

NULL_TEXT = "nan"


def encode_fixed(
    df: DataFrame, column: str = "room_type", codes: Mapping[str, int] = ROOM_TYPE_CODES, out: str | None = None
) -> DataFrame:
    """Codes from a fixed map; unknown and null become 0."""
    lookup = F.create_map(*[F.lit(x) for item in codes.items() for x in item])
    return df.withColumn(out or f"{column}_encoded", F.coalesce(lookup[F.col(column)], F.lit(0)))


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """``(label, code)``: ranks of the distinct texts, where a null has the text ``nan``."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(NULL_TEXT))
    return numbered(df.select(text.alias("label")).distinct(), "label", "code")


def encode_labels(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Rank of the value's text among the sorted distinct texts; a null takes a rank but gets 0."""
    joined = df.join(label_codes(df, column), F.col(column).cast("string") == F.col("label"), "left")
    return joined.withColumn(out or f"{column}_encoded", F.coalesce(F.col("code"), F.lit(0)).cast("bigint")).drop(
        "label", "code"
    )


def tenure_days(
    df: DataFrame,
    seen: str = "last_scraped",
    since: str = "host_since",
    out: str = "host_tenure_days",
    default_date: str = DEFAULT_DATE,
) -> DataFrame:
    """Days from the start of hosting to the scrape date, never negative."""
    seen_date = F.coalesce(parse_date(df, seen, day_first=False), F.lit(default_date).cast("date"))
    since_date = F.coalesce(parse_date(df, since, day_first=False), F.date_sub(seen_date, DEFAULT_TENURE_DAYS))
    return df.withColumn(out, F.greatest(F.datediff(seen_date, since_date), F.lit(0)))


def unit_price(
    df: DataFrame, price: str = "price", units: str = "bedrooms", out: str = "price_per_bedroom"
) -> DataFrame:
    """Price per unit: null price counts 0, null units count 1, fewer than one counts one."""
    amount = F.coalesce(as_double(df, price, currency=False), F.lit(0.0))
    count: Column = F.coalesce(as_double(df, units), F.lit(1.0)) if units in df.columns else F.lit(1.0)
    return df.withColumn(out, round_half_even(amount / F.greatest(count, F.lit(1.0)), 2))


def transform_table(df: DataFrame) -> DataFrame:
    """All codes and features the columns at hand allow."""
    out = df
    if "room_type" in out.columns:
        out = encode_fixed(out)
    if "neighbourhood_group_cleansed" in out.columns:
        out = encode_labels(out, "neighbourhood_group_cleansed")
    return out.transform(tenure_days).transform(unit_price)
