"""Format normalization of currency, quantity, place and date columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.numeric import as_double, is_text, round_half_even
from plumbline.functions.quantiles import quantile_row
from plumbline.functions.text import strip, title_case

# Fixed values.
DEFAULT_DATE = "2026-06-16"
DEFAULT_PRICE = 100.0
DAYS_PER_YEAR = 365.25
DAYS_PER_MONTH = 30.4375
DEFAULT_TENURE_DAYS = 365

#: Forms of a date in text; parts in brackets may be absent.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd[' ']['T']HH:mm[:ss][.SSSSSS][.SSS][XXX]",
    "dd-MM-yyyy",
    "yyyy/MM/dd",
    "dd/MM/yyyy",
    "yyyyMMdd",
    "d MMM yyyy",
    "d MMMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
)


def keep_first(df: DataFrame, key: str, on: list[str]) -> DataFrame:
    """The first row (by ``key``) of each ``on`` group.

    The rank filter becomes a group limit in every task before the shuffle, so
    a key with very many rows sends one row per task.
    """
    first = Window.partitionBy(*on).orderBy(key)
    return df.withColumn("__rn", F.row_number().over(first)).where(F.col("__rn") == 1).drop("__rn")


def price_value(df: DataFrame, column: str = "price") -> Column:
    return as_double(df, column, currency=True)


def normalize_price(
    df: DataFrame,
    raw: DataFrame | None = None,
    key: str = "row_id",
    row_id: str = "id",
    column: str = "price",
    one_per_id: bool = False,
) -> DataFrame:
    """Price as a positive number with two decimals.

    A value that is absent or not positive is replaced by the positive price of
    the first raw row with the same id, else by the median of the valid prices
    (of the raw table when there are none, of nothing: 100). ``one_per_id``: no id comes twice in ``df``.
    """
    # Text is parsed once for each row; conditions and values then read the number.
    priced = df.withColumn("__value", price_value(df, column))
    good = F.when(F.col("__value") > 0, F.col("__value"))
    median = quantile_row(priced, {column: good}, {"median": 0.5}).first()[0]
    if raw is not None and column in raw.columns:
        raw_priced = raw.withColumn("__value", price_value(raw, column))
        if median is None:
            median = quantile_row(raw_priced, {column: good}, {"median": 0.5}).first()[0]
    fallback = F.lit(DEFAULT_PRICE if median is None else median)
    if raw is None or row_id not in raw.columns or row_id not in df.columns or column not in raw.columns:
        return priced.withColumn(column, round_half_even(F.coalesce(good, fallback), 2)).drop("__value")
    first_raw = keep_first(raw_priced.select(key, row_id, "__value"), key, [row_id])
    lookup = first_raw.where(F.col("__value") > 0).select(
        F.col(row_id).cast("string").alias("__raw_id"), F.lit(True).alias("__raw"), F.col("__value").alias("__raw_price")
    )
    priced = priced.withColumn("__good", good)
    kind = df.schema[row_id].dataType
    if one_per_id and kind == raw.schema[row_id].dataType and isinstance(kind, (T.IntegralType, T.StringType)):
        # Both sides are dealt by the id already, and no id is frequent.
        found = first_raw.where(F.col("__value") > 0).select(F.col(row_id).alias("__raw_id"), F.col("__value").alias("__raw_price"))
        joined = priced.join(found, F.col(row_id) == F.col("__raw_id"), "left")
        return joined.withColumn(column, round_half_even(F.coalesce("__good", "__raw_price", fallback), 2)).drop(
            "__value", "__good", "__raw_id", "__raw_price"
        )
    # Only rows with an id and without a good price look anything up. The others join
    # on their own key, which spreads them evenly and matches nothing.
    wanting = F.col("__good").isNull() & F.col(row_id).isNotNull()
    join_key = F.when(wanting, F.col(row_id).cast("string")).otherwise(F.col(key).cast("string"))
    joined = priced.withColumns({"__need": join_key, "__open": wanting}).join(
        lookup, (F.col("__need") == F.col("__raw_id")) & (F.col("__open") == F.col("__raw")), "left"
    )
    return joined.withColumn(column, round_half_even(F.coalesce("__good", "__raw_price", fallback), 2)).drop(
        "__value", "__good", "__need", "__open", "__raw_id", "__raw", "__raw_price"
    )


def parse_quantity_text(df: DataFrame, text: str = "bathrooms_text", number: str = "bathrooms") -> DataFrame:
    """Quantity and kind from text such as ``1.5 shared baths`` or ``Half-bath``."""
    t = F.lower(strip(F.coalesce(F.col(text), F.lit("")))) if text in df.columns else F.lit("")
    kind = F.when(t.contains("shared"), "shared").when(t.contains("private"), "private").otherwise("standard")
    half = t.contains("half")
    kind = F.when(~half, kind).when(kind == "standard", "half").otherwise(F.concat(kind, F.lit("_half")))
    digits = F.regexp_extract(t, r"(\d+(?:\.\d+)?)", 1)
    current = as_double(df, number) if number in df.columns else F.lit(None).cast("double")
    value = (
        F.when(digits != "", digits.try_cast("double"))
        .when(half, F.lit(0.5))
        .when(current >= 0, current)
        .otherwise(F.lit(1.0))
    )
    return df.withColumns({number: value, "bathroom_type": kind})


def standardize_places(
    df: DataFrame, cleansed: str = "neighbourhood_cleansed", display: str = "neighbourhood"
) -> DataFrame:
    """Upper-case the cleansed place name and fill and title-case the display name."""
    source = F.col(cleansed) if cleansed in df.columns else F.lit(None).cast("string")
    shown = F.coalesce(F.col(display).cast("string"), source) if display in df.columns else source

    def or_default(value: Column, formatted: Column, default: str) -> Column:
        return F.when(strip(value) != "", formatted).otherwise(F.lit(default))

    return df.withColumns(
        {
            cleansed: or_default(source, F.upper(strip(source)), "UNKNOWN"),
            display: or_default(shown, title_case(strip(shown)), "Unknown"),
        }
    )


def parse_date(df: DataFrame, name: str, day_first: bool, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date of a text column, or of a date column.

    The whole text must have one of ``formats``, tried in order; ``day_first`` puts those that begin
    with the day in front. Other texts give null.
    """
    if name not in df.columns:
        return F.lit(None).cast("date")
    if not is_text(df, name):
        return F.col(name).cast("date")
    text = F.trim(F.col(name))
    if all("yy" in f for f in formats):  # a year has digits: other texts need not fail once for each format
        text = F.when(text.rlike("[0-9]"), text)
    ordered = sorted(formats, key=lambda f: not f.startswith("d")) if day_first else formats
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in ordered])


def parse_dates(
    df: DataFrame,
    seen: str = "last_scraped",
    since: str = "host_since",
    years: str = "hosts_time_as_host_years",
    months: str = "hosts_time_as_host_months",
    first_review: str = "first_review",
    default_date: str = DEFAULT_DATE,
) -> DataFrame:
    """ISO text for the scrape date and the start of hosting.

    A missing start is derived from the tenure, else from the first review,
    else it lies a year before the scrape date.
    """
    # The scrape date is parsed once for each row; both columns read it.
    df = df.withColumn("__seen", F.coalesce(parse_date(df, seen, day_first=True), F.lit(default_date).cast("date")))
    seen_date = F.col("__seen")

    def amount(name: str) -> Column:
        return as_double(df, name) if name in df.columns else F.lit(0.0)

    y, m = amount(years), amount(months)
    days = F.floor(y * DAYS_PER_YEAR + m * DAYS_PER_MONTH).cast("int")
    review_date = parse_date(df, first_review, day_first=True)
    derived = F.when((y.isNotNull() & m.isNotNull()) & ((y > 0) | (m > 0)), F.date_sub(seen_date, days)).otherwise(
        F.coalesce(review_date, F.date_sub(seen_date, DEFAULT_TENURE_DAYS))
    )
    since_date = F.coalesce(parse_date(df, since, day_first=False), derived)
    return df.withColumns(
        {seen: F.date_format(seen_date, "yyyy-MM-dd"), since: F.date_format(since_date, "yyyy-MM-dd")}
    ).drop("__seen")


def normalize_table(df: DataFrame, raw: DataFrame | None = None, key: str = "row_id", row_id: str = "id") -> DataFrame:
    """First row per id, then price, quantity, place and date columns."""
    out = keep_first(df, key, [row_id]) if row_id in df.columns else df
    if "price" in out.columns:
        out = normalize_price(out, raw, key, row_id, one_per_id=row_id in df.columns)
    return out.transform(parse_quantity_text).transform(standardize_places).transform(parse_dates)
