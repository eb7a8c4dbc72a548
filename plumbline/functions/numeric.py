"""Numeric column expressions: parsing, safe division, rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: text accepted as a number.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_number(text: Column) -> Column:
    """Plain numeric text to double, null when it is not a number.

    The whole text is extracted where it matches, so that ``text`` is worked out once; no number gives an empty text.
    """
    return F.regexp_extract(F.trim(text), rf"{NUMBER_PATTERN}[\s\S]*", 0).try_cast("double")


def parse_currency(text: Column) -> Column:
    """Currency text such as ``$1,234.00`` to double, null when it does not parse."""
    return parse_number(F.regexp_replace(text, r"[$,]", ""))


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(dtype_of(df, name), T.NumericType)


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(dtype_of(df, name), T.StringType)


def as_double(df: DataFrame, name: str, currency: bool = False) -> Column:
    """Column as double: text is parsed, NaN becomes null."""
    if is_text(df, name):
        return parse_currency(F.col(name)) if currency else parse_number(F.col(name))
    value = F.col(name).cast("double")
    if isinstance(dtype_of(df, name), (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def is_missing(df: DataFrame, name: str) -> Column:
    """Null test that also counts NaN, as the profile does."""
    if isinstance(dtype_of(df, name), (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` as a rounded percentage; null when ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, digits)


def round_half_even(value: Column, digits: int) -> Column:
    """Scaled rounding of doubles, exact halves to the even digit."""
    scale = F.lit(10.0**digits)
    return F.rint(value * scale) / scale


def count_where(predicate: Column) -> Column:
    """Rows meeting ``predicate`` (null counts as no)."""
    return F.count(F.when(predicate, F.lit(1)))
