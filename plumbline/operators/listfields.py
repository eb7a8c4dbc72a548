"""Lists kept as text in one cell: parsing, cleaning, counts, categories."""

from __future__ import annotations

import ast
import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.numeric import count_where
from plumbline.functions.text import strip

# Issue names, and patterns per category.
FALLBACK_ISSUE = "Fallback comma parsing required"
ARTIFACT_ISSUE = "contains_encoding_artifacts"
DUPLICATE_ISSUE = "contains_duplicate_items"
MISSING_ISSUE = "Null or NaN amenities field"
EMPTY_ISSUE = "Empty amenities array"
CATEGORIES = {
    "wifi": [r"\bwifi\b", r"\binternet\b"],
    "kitchen": [r"\bkitchen\b", r"\bkitchenette\b"],
    "air_conditioning": [r"\bair conditioning\b", r"\bac\b", r"\bcentral air\b"],
    "heating": [r"\bheating\b", r"\bheater\b"],
    "free_parking": [r"\bfree parking\b", r"\bdriveway\b", r"\bcarport\b"],
    "paid_parking": [r"\bpaid parking\b", r"\bparking on premises\b"],
    "washer": [r"\bwasher\b", r"\blaundry\b"],
    "dryer": [r"\bdryer\b"],
    "tv": [r"\btv\b", r"\bhdtv\b", r"\btelevision\b"],
    "dedicated_workspace": [r"\bworkspace\b", r"\bdesk\b"],
    "smoke_alarm": [r"\bsmoke alarm\b", r"\bsmoke detector\b"],
    "carbon_monoxide_alarm": [r"\bcarbon monoxide\b"],
    "dishwasher": [r"\bdishwasher\b"],
    "microwave": [r"\bmicrowave\b"],
    "refrigerator": [r"\brefrigerator\b", r"\bfridge\b"],
    "coffee_maker": [r"\bcoffee\b", r"\bespresso\b"],
    "patio_or_balcony": [r"\bpatio\b", r"\bbalcony\b"],
    "bbq_grill": [r"\bbbq\b", r"\bbarbecue\b", r"\bgrill\b"],
    "pool_or_hot_tub": [r"\bpool\b", r"\bhot tub\b"],
}
# Characters replaced before normalization.
REPLACED = {"\ufffd": "'", "\u2013": "-", "\u2014": "-", "\u202f": " ", "\xa0": " "}

STRICT_JSON = {"allowSingleQuotes": "false"}
ITEMS = T.ArrayType(T.StringType())


@F.pandas_udf(ITEMS)
def literal_items(texts: pd.Series) -> pd.Series:
    """Items of a Python literal; null where the text is none. Only texts that are not JSON arrive."""

    def parse(text: str | None):
        if text is None:
            return None
        try:
            found = ast.literal_eval(text)
        except Exception:
            return None
        return [str(x) for x in found] if isinstance(found, (list, tuple, set)) else [str(found)]

    return texts.map(parse)


@F.pandas_udf(ITEMS)
def normalized_items(items: pd.Series) -> pd.Series:
    """Replaced characters and compatibility forms. Only lists with non-ASCII text arrive."""
    table = str.maketrans(REPLACED)
    return items.map(
        lambda values: None if values is None else [unicodedata.normalize("NFKC", v.translate(table)) for v in values]
    )


def _issue(present: Column, name: str) -> Column:
    return F.when(present, F.lit(name))


def parse_list_field(df: DataFrame, column: str = "amenities") -> DataFrame:
    """Add ``items`` (clean, distinct, in order), ``format_type`` and ``issues``."""
    text = strip(F.col(column))
    missing = F.col(column).isNull()
    empty = text.isin("", "[]", "{}")
    # One JSON value, seen as the only element of a list.
    single = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", STRICT_JSON)
    is_json = F.coalesce(F.size(single) == 1, F.lit(False))
    as_list = F.when(text.startswith("["), F.from_json(text, "array<string>", STRICT_JSON)).otherwise(single)
    json_items = F.transform(as_list, lambda x: F.coalesce(x, F.lit("None")))
    comma = F.filter(F.transform(F.split(text, ","), strip), lambda x: x != "")
    step = df.withColumns(
        {
            "__json": F.when(~missing & ~empty & is_json, json_items),
            "__other": F.when(~missing & ~empty & ~is_json, text),
            "__state": F.when(missing, "MISSING").when(empty, "EMPTY"),
            "__comma": comma,
        }
    ).withColumn("__literal", literal_items("__other"))
    step = step.withColumns(
        {
            "format_type": F.coalesce(
                "__state",
                F.when(F.col("__json").isNotNull(), "JSON")
                .when(F.col("__literal").isNotNull(), "PYTHON_LITERAL")
                .otherwise("PLAIN_TEXT_COMMA"),
            ),
            "__raw": F.when(F.col("__state").isNotNull(), F.array().cast("array<string>")).otherwise(
                F.coalesce("__json", "__literal", "__comma")
            ),
        }
    )
    foreign = F.exists("__raw", lambda x: x.rlike(r"[^\x00-\x7F]"))
    artifact = foreign | F.exists("__raw", lambda x: x.contains("\\u"))
    step = step.withColumns(
        {"__artifact": artifact, "__normal": F.coalesce(normalized_items(F.when(foreign, F.col("__raw"))), F.col("__raw"))}
    )
    clean = F.filter(
        F.transform(
            "__normal", lambda x: F.regexp_replace(F.regexp_replace(x, "<[^>]+>", ""), "^[\"' ]+|[\"' ]+$", "")
        ),
        lambda x: x != "",
    )
    step = step.withColumn("__clean", clean).withColumn("items", F.array_distinct("__clean"))
    issues = F.array_compact(
        F.array(
            _issue(F.col("format_type") == "MISSING", MISSING_ISSUE),
            _issue(F.col("format_type") == "EMPTY", EMPTY_ISSUE),
            _issue(F.col("format_type") == "PLAIN_TEXT_COMMA", FALLBACK_ISSUE),
            _issue(F.col("__artifact"), ARTIFACT_ISSUE),
            _issue(F.size("__clean") != F.size("items"), DUPLICATE_ISSUE),
        )
    )
    return step.withColumn("issues", issues).drop(
        "__json", "__other", "__state", "__comma", "__literal", "__raw", "__artifact", "__normal", "__clean"
    )


def item_counts(parsed: DataFrame, key: str) -> DataFrame:
    """Rows per distinct item and its first place ``(key, position)``."""
    items = parsed.select(key, F.posexplode("items").alias("pos", "item"))
    return items.groupBy("item").agg(F.count("*").alias("frequency"), F.min(F.struct(key, "pos")).alias("first_seen"))


def list_metrics(parsed: DataFrame, key: str) -> DataFrame:
    """One row of counts over the list column."""
    size = F.size("items")
    one = parsed.agg(
        F.count("*").alias("total_processed"),
        count_where(F.col("format_type") == "JSON").alias("valid_json_count"),
        count_where(F.array_contains("issues", ARTIFACT_ISSUE)).alias("encoding_artifact_count"),
        count_where(F.array_contains("issues", DUPLICATE_ISSUE)).alias("duplicate_items_count"),
        count_where(size == 0).alias("empty_count"),
        F.round(F.avg(size), 2).alias("avg_items"),
        F.min(size).cast("bigint").alias("min_items"),
        F.max(size).cast("bigint").alias("max_items"),
    )
    return one.withColumn("distinct_items", item_counts(parsed, key).agg(F.count("*")).scalar())


def top_items(parsed: DataFrame, key: str, limit: int = 20) -> DataFrame:
    """Most frequent items, ties by first appearance (a report of ``limit`` rows)."""
    ranked = item_counts(parsed, key).orderBy(F.desc("frequency"), "first_seen").limit(limit)
    return ranked.select("item", "frequency")


def category_counts(parsed: DataFrame, key: str, categories: Mapping[str, Sequence[str]] = CATEGORIES) -> DataFrame:
    """Item occurrences per category; an item can be in several.

    The patterns run once per distinct item, not once per occurrence.
    """
    counts = item_counts(parsed, key).select(F.lower("item").alias("item"), "frequency")
    hits = F.array_compact(
        F.array(*[F.when(F.col("item").rlike("|".join(patterns)), F.lit(c)) for c, patterns in categories.items()])
    )
    return (
        counts.select(F.explode(hits).alias("category"), "frequency")
        .groupBy("category")
        .agg(F.sum("frequency").alias("matches"))
    )


def list_issues(parsed: DataFrame, key: str, row_id: str = "id") -> DataFrame:
    """Rows whose list cell has an issue."""
    identity = [F.col(row_id).cast("string").alias("listing_id")] if row_id in parsed.columns else []
    return parsed.where(F.size("issues") > 0).select(
        key, *identity, "format_type", F.size("items").alias("item_count"), "issues"
    )
