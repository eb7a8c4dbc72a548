"""Inference of a rule specification from a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import as_double, count_where, is_missing, is_numeric, is_text, parse_number
from plumbline.operators.profile import has_few_values
from plumbline.sources.files import SPEC_SCHEMA

# The specification of the key columns. Fields: expected type,
# semantic type, nullable, unique, minimum, maximum, allowed values, format.
ROOM_TYPES = ["Entire home/apt", "Private room", "Hotel room", "Shared room"]
PRICE_FORMAT = r"^\$\d{1,3}(,\d{3})*(\.\d{2})?$"
BATHROOM_FORMAT = r"^\d+(\.\d+)?\s+"
KEY_COLUMN_SPECS = {
    "id": ("integer", "ID", False, True, None, None, None, None),
    "price": ("float", "numeric", False, None, 0.0, None, None, PRICE_FORMAT),
    "minimum_nights": ("integer", "numeric", False, None, 1.0, 365.0, None, None),
    "availability_365": ("integer", "numeric", False, None, 0.0, 365.0, None, None),
    "room_type": ("categorical", "categorical", False, None, None, None, ROOM_TYPES, None),
    "bathrooms_text": ("string", "text", True, None, None, None, None, BATHROOM_FORMAT),
    "latitude": ("float", "numeric", False, None, -90.0, 90.0, None, None),
    "longitude": ("float", "numeric", False, None, -180.0, 180.0, None, None),
    "review_scores_rating": ("float", "numeric", True, None, 1.0, 5.0, None, None),
    "license": ("string", "text", False, None, None, None, None, None),
}
KEY_COLUMNS = list(KEY_COLUMN_SPECS)
FEW = 10


def infer_schema(df: DataFrame, key: str | None = None, key_specs: dict | None = None) -> DataFrame:
    """One specification row per column.

    Columns named in ``key_specs`` take their fixed row, the others are typed
    from their Spark type, their nulls and whether they have fewer than ``FEW`` distinct values.
    """
    specs = KEY_COLUMN_SPECS if key_specs is None else key_specs
    spark = df.sparkSession
    fixed = spark.createDataFrame([(c, *spec, True) for c, spec in specs.items()], SPEC_SCHEMA)
    names = [c for c in df.columns if c != key]
    dtypes = {c: df.schema[c].dataType.simpleString() for c in names}
    counts = df.agg(F.count("*").alias("__rows"), *[count_where(is_missing(df, c)).alias(c) for c in names]).first()
    missing = {c: counts[c] for c in names} if counts["__rows"] else {}
    asked = [c for c in names if c not in specs and not is_numeric(df, c) and not missing.get(c)]
    categories = has_few_values(df, asked, FEW) if missing else set()
    profile = spark.createDataFrame(
        [(c, dtypes[c], bool(missing[c]), c in categories) for c in names if c in missing], "column string, dtype string, nullable boolean, few boolean"
    )
    nullable = F.col("nullable")
    whole = F.col("dtype").isin("tinyint", "smallint", "int", "bigint")
    real = F.col("dtype").isin("float", "double") | F.col("dtype").startswith("decimal")
    few = F.col("few")

    def pick(integer: str, number: str, category: str, other: str) -> Column:
        return F.when(whole, integer).when(real, number).when(few, category).otherwise(other)

    inferred = profile.select(
        "column",
        pick("integer", "float", "categorical", "string").alias("expected_dtype"),
        pick("numeric", "numeric", "categorical", "free text").alias("semantic_type"),
        nullable.alias("is_nullable"),
    )
    f = fixed.alias("f")
    joined = inferred.alias("i").join(F.broadcast(f), "column", "left")  # one row per named spec
    known = F.col("f.is_key_column").isNotNull()
    return joined.select(
        "column",
        F.coalesce("f.expected_dtype", "i.expected_dtype").alias("expected_dtype"),
        F.coalesce("f.semantic_type", "i.semantic_type").alias("semantic_type"),
        F.when(known, F.col("f.is_nullable")).otherwise(F.col("i.is_nullable")).alias("is_nullable"),
        F.coalesce("f.is_unique", F.lit(False)).alias("is_unique"),
        "f.min_value",
        "f.max_value",
        "f.allowed_values",
        "f.format_pattern",
        known.alias("is_key_column"),
    )


def observed_bounds(df: DataFrame, key: str) -> DataFrame:
    """Types and bounds read from the values themselves.

    Text columns whose present values are all of one kind are reported as
    ``boolean``, ``integer``, ``float`` or ``datetime``; bounds are numeric.
    """
    names = [c for c in df.columns if c != key]
    aggregates = []
    for i, c in enumerate(names):
        text = is_text(df, c)
        value = F.trim(F.col(c).cast("string")) if text else F.col(c).cast("string")
        present = F.col(c).isNotNull()
        number = parse_number(F.col(c)) if text else as_double(df, c) if is_numeric(df, c) else F.lit(None).cast("double")
        if text:
            is_date = F.coalesce(
                F.try_to_timestamp(value, F.lit("dd-MM-yyyy")), F.try_to_timestamp(value, F.lit("yyyy-MM-dd"))
            ).isNotNull()
            kinds = {
                "b": F.lower(value).isin("t", "f", "true", "false"),
                "i": number.isNotNull() & value.rlike(r"^[+-]?\d+$"),
                "f": number.isNotNull(),
                "d": value.rlike(r"^\d{2}-\d{2}-\d{4}$|^\d{4}-\d{2}-\d{2}$") & is_date,
            }
        else:
            dtype = df.schema[c].dataType.simpleString()
            kinds = {
                "b": F.lit(dtype == "boolean"),
                "i": F.lit(dtype in ("tinyint", "smallint", "int", "bigint")),
                "f": F.lit(is_numeric(df, c)),
                "d": F.lit(dtype.startswith(("timestamp", "date"))),
            }
        aggregates += [F.count(F.when(present, 1)).alias(f"n{i}")]
        aggregates += [count_where(present & F.coalesce(k, F.lit(False))).alias(f"{m}{i}") for m, k in kinds.items()]
        aggregates += [F.min(number).alias(f"lo{i}"), F.max(number).alias(f"hi{i}")]
    rows = ", ".join(f"'{c}', n{i}, b{i}, i{i}, f{i}, d{i}, lo{i}, hi{i}" for i, c in enumerate(names))
    long = df.agg(*aggregates).selectExpr(
        f"stack({len(names)}, {rows}) AS (column, n, as_bool, as_int, as_float, as_date, lo, hi)"
    )

    def every(kind: str) -> Column:
        return (F.col("n") > 0) & (F.col(kind) == F.col("n"))

    numeric = every("as_float")
    return long.select(
        "column",
        F.when(every("as_bool"), "boolean")
        .when(every("as_int"), "integer")
        .when(numeric, "float")
        .when(every("as_date"), "datetime")
        .otherwise("string")
        .alias("observed_dtype"),
        F.when(numeric, F.col("lo")).alias("min_value"),
        F.when(numeric, F.col("hi")).alias("max_value"),
    )


def schema_document(spec: DataFrame, dataset_name: str) -> DataFrame:
    """The specification as one nested row: name, column count, key columns, columns."""
    return spec.agg(
        F.lit(dataset_name).alias("dataset_name"),
        F.count("*").alias("total_columns"),
        F.sort_array(F.collect_list(F.when(F.col("is_key_column"), F.col("column")))).alias("key_columns"),
        F.map_from_entries(
            F.collect_list(F.struct("column", F.struct(*[c for c in spec.columns if c != "column"])))
        ).alias("columns"),
    )

