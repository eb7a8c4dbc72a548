"""Declarative row rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import as_double, is_text, parse_number
from plumbline.functions.skew import sized
from plumbline.functions.text import strip
from plumbline.operators.issues import Check, finding_log, finding_summary
from plumbline.operators.profile import require_columns
from plumbline.operators.schema import ROOM_TYPES

# The districts and the bounding box of the default city.
CITY_NAME = "Albany, NY"
DISTRICTS = [
    "FIRST WARD",
    "SECOND WARD",
    "THIRD WARD",
    "FOURTH WARD",
    "FIFTH WARD",
    "SIXTH WARD",
    "SEVENTH WARD",
    "EIGHTH WARD",
    "NINTH WARD",
    "TENTH WARD",
    "ELEVENTH WARD",
    "TWELFTH WARD",
    "THIRTEENTH WARD",
    "FOURTEENTH WARD",
    "FIFTEENTH WARD",
]
BOUNDING_BOX = {"min_lat": 42.64, "max_lat": 42.71, "min_lon": -73.85, "max_lon": -73.74}


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _number(df: DataFrame, column: str, currency: bool = False) -> Column:
    """The column as a number; an absent column counts as null in every row."""
    return as_double(df, column, currency) if column in df.columns else F.lit(None).cast("double")


def _shown(df: DataFrame, column: str) -> Column:
    return F.coalesce(_text(column), F.lit("null")) if column in df.columns else F.lit("null")


def range_rule(
    df: DataFrame,
    rule_id: str,
    name: str,
    column: str,
    low: float,
    high: float | None = None,
    severity: str = "HIGH",
    exclusive: bool = False,
    currency: bool = False,
) -> Check:
    """The value must be a number inside the range; null fails."""
    value = _number(df, column, currency)
    inside = value > low if exclusive else value >= low
    inside = inside if high is None else inside & (value <= high)
    limits = f"{'> ' if exclusive else ''}{low}" if high is None else f"[{low}, {high}]"
    return Check(
        rule_id,
        name,
        "numeric_range",
        severity,
        column,
        f"{column} must be a number in {limits}",
        ~F.coalesce(inside, F.lit(False)),
        _shown(df, column),
        F.concat(F.lit(f"{column} "), _shown(df, column), F.lit(f" is not in {limits}")),
    )


def member_rule(
    df: DataFrame, rule_id: str, name: str, column: str, allowed: Sequence[str], upper: bool = False, severity: str = "HIGH"
) -> Check:
    """The trimmed text must be one of ``allowed``; null fails."""
    value = strip(_text(column)) if column in df.columns else F.lit(None).cast("string")
    value = F.upper(value) if upper else value
    return Check(
        rule_id,
        name,
        "categorical_consistency",
        severity,
        column,
        f"{column} must be one of {len(allowed)} allowed values",
        ~F.coalesce(value.isin(list(allowed)), F.lit(False)),
        _shown(df, column),
        F.concat(F.lit(f"{column} "), _shown(df, column), F.lit(" is not an allowed value")),
    )


def box_rule(df: DataFrame, rule_id: str, name: str, lat: str, lon: str, box: dict[str, float]) -> Check:
    """The point must lie in the box; a null coordinate fails."""
    inside = _number(df, lat).between(box["min_lat"], box["max_lat"]) & _number(df, lon).between(
        box["min_lon"], box["max_lon"]
    )
    shown = F.concat(F.lit("("), _shown(df, lat), F.lit(", "), _shown(df, lon), F.lit(")"))
    return Check(
        rule_id,
        name,
        "coordinate_sanity",
        "CRITICAL",
        f"{lat},{lon}",
        f"{lat} and {lon} must lie in the city box",
        ~F.coalesce(inside, F.lit(False)),
        shown,
        F.concat(F.lit("point "), shown, F.lit(" lies outside the city box")),
    )


def order_rule(df: DataFrame, rule_id: str, name: str, low: str, high: str) -> Check:
    """``low`` must not exceed ``high``; a null side fails."""
    ordered = _number(df, low) <= _number(df, high)
    shown = F.concat(F.lit(f"{low}="), _shown(df, low), F.lit(f", {high}="), _shown(df, high))
    return Check(
        rule_id,
        name,
        "cross_field_consistency",
        "CRITICAL",
        f"{low},{high}",
        f"{high} must be at least {low}",
        ~F.coalesce(ordered, F.lit(False)),
        shown,
        F.concat(shown, F.lit(" are out of order or incomplete")),
    )


def expression_rule(
    rule_id: str, name: str, category: str, severity: str, columns: str, holds: str | Column, description: str = ""
) -> Check:
    """A rule given as SQL text or a Column that holds for good rows; null fails."""
    condition = F.expr(holds) if isinstance(holds, str) else holds
    first = columns.split(",")[0]
    return Check(
        rule_id,
        name,
        category,
        severity,
        columns,
        description or (holds if isinstance(holds, str) else name),
        ~F.coalesce(condition, F.lit(False)),
        _text(first),
        F.concat(F.lit(f"{name} fails for "), F.coalesce(_text(first), F.lit("null"))),
    )


def standard_rules(
    df: DataFrame, districts: Sequence[str] = DISTRICTS, box: dict[str, float] | None = None
) -> list[Check]:
    """The seven rules of a listing table."""
    return [
        range_rule(
            df, "R001", "price_greater_than_zero", "price", 0, severity="CRITICAL", exclusive=True, currency=True
        ),
        range_rule(df, "R002", "minimum_nights_in_range", "minimum_nights", 1, 365),
        range_rule(df, "R003", "availability_365_in_range", "availability_365", 0, 365),
        member_rule(df, "R004", "room_type_valid", "room_type", ROOM_TYPES),
        member_rule(df, "R005", "neighbourhood_group_valid", "neighbourhood_group_cleansed", districts, upper=True),
        box_rule(df, "R006", "coordinate_bounding_box", "latitude", "longitude", box or BOUNDING_BOX),
        order_rule(df, "R007", "min_nights_le_max_nights", "minimum_nights", "maximum_nights"),
    ]


def response_rate_rule(df: DataFrame, column: str = "host_response_rate") -> Check:
    """Percent text must lie in 0..100; an absent value is fine."""
    require_columns(df, [column])
    number = parse_number(F.regexp_replace(F.col(column), "%", "")) if is_text(df, column) else as_double(df, column)
    return expression_rule(
        "R008",
        "response_rate_in_range",
        "numeric_range",
        "HIGH",
        column,
        F.col(column).isNull() | number.between(0, 100),
        f"{column} must be a percentage from 0 to 100",
    )


def rule_violations(df: DataFrame, key: str, row_id: str = "id", rules: Sequence[Check] | None = None) -> DataFrame:
    """Violation log of the given rules (the standard ones by default)."""
    log = finding_log(df, rules or standard_rules(df), key, row_id)
    return log.withColumnsRenamed({"check_id": "rule_id", "check_name": "rule_name"})


def rule_summary(df: DataFrame, rules: Sequence[Check] | None = None) -> DataFrame:
    """Violations per rule, with zeros."""
    table = finding_summary(df, rules or standard_rules(df))
    return table.withColumnsRenamed({"check_id": "rule_id", "check_name": "rule_name", "category": "rule_category"})


def unknown_members(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Rows whose value is not in a reference table of any size.

    The reference side is distinct; values are compared trimmed and in upper case.
    """
    allowed = sized(reference.select(F.upper(strip(F.col(reference_column))).alias("__allowed")).distinct())
    return df.join(allowed, F.upper(strip(F.col(column))) == F.col("__allowed"), "left_anti")
