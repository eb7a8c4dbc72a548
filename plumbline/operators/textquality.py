"""Quality classes of free-text columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import percent
from plumbline.functions.text import NOT_WORD_OR_SPACE, strip, words

# Fixed values.
GENUINE = "GENUINE_LISTING_TEXT"
PLACEHOLDER = "PLACEHOLDER"
NEAR_EMPTY = "NEAR_EMPTY_OR_SHORT"
MISSING = "MISSING_OR_NULL"
PLACEHOLDER_PATTERN = (
    r"^(n/?a|na|none|null|tbd|test|no description|dot|\.|\?|same as title|listing|apartment|house|place|see title)$"
)
SINGLE_WORDS = ["apartment", "house", "studio", "room", "listing"]
TEXT_COLUMNS = ["description", "neighborhood_overview"]


def with_text_quality(df: DataFrame, column: str) -> DataFrame:
    """Add category, confidence, word and character counts and lexical diversity.

    Worked out in steps, so that each regular expression runs once per text.
    """
    step = df.withColumn("__s", strip(F.col(column)))
    step = step.withColumns({"__low": F.lower("__s"), "__words": F.size(words(F.col("__s")))})
    step = step.withColumn("__bare", strip(F.regexp_replace("__low", NOT_WORD_OR_SPACE, "")))
    count, lower, bare = F.col("__words"), F.col("__low"), F.col("__bare")
    missing = F.col(column).isNull() | (F.col("__s") == "")
    placeholder = bare.rlike(PLACEHOLDER_PATTERN) | lower.rlike(PLACEHOLDER_PATTERN)
    single = (count == 1) & ((F.length(bare) < 15) | bare.isin(SINGLE_WORDS))
    short = (count <= 5) | (F.length("__s") < 25)
    case = F.when(missing, 0).when(placeholder, 1).when(single, 2).when(short, 3).otherwise(4)
    step = step.withColumn("__case", case)
    names = F.array(*[F.lit(c) for c in (MISSING, PLACEHOLDER, PLACEHOLDER, NEAR_EMPTY, GENUINE)])
    scores = F.array(*[F.lit(c) for c in (0.0, 0.05, 0.10, 0.35)])
    long_text = F.least(F.lit(1.0), F.round(0.5 + count / 100.0 * 0.5, 3))
    found = F.col("__case")
    distinct = F.size(F.array_distinct(words(lower)))
    return step.withColumns(
        {
            "category": F.element_at(names, found + 1),
            "confidence": F.when(found == 4, long_text).otherwise(F.get(scores, found)),
            "word_count": F.when(found == 0, 0).otherwise(count).cast("bigint"),
            "char_count": F.when(found == 0, 0).otherwise(F.length("__s")).cast("bigint"),
            "lexical_diversity": F.when(found == 4, F.round(distinct / count, 3)),
        }
    ).drop("__s", "__low", "__words", "__bare", "__case")


def classify_text(df: DataFrame, key: str | Sequence[str], columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Long form: one classified row per (row, text column); an absent column is all missing."""
    keys = [key] if isinstance(key, str) else list(key)
    parts = []
    for c in columns:
        text = F.col(c) if c in df.columns else F.lit(None).cast("string")
        parts.append(with_text_quality(df.select(*keys, F.lit(c).alias("column"), text.alias("text")), "text"))
    return reduce(DataFrame.unionByName, parts)


def text_summary(classified: DataFrame) -> DataFrame:
    """Per (column, category): rows and share."""
    counts = classified.groupBy("column", "category").agg(F.count("*").alias("rows"))
    totals = counts.groupBy("column").agg(F.sum("rows").alias("total"))
    # One row per text column.
    return counts.join(F.broadcast(totals), "column").select(
        "column", "category", "rows", percent(F.col("rows"), F.col("total"), 2).alias("pct")
    )


def text_means(classified: DataFrame) -> DataFrame:
    """Per column: rows, nulls and mean sizes and confidence."""
    return classified.groupBy("column").agg(
        F.count("*").alias("total_rows"),
        F.count("text").alias("non_null"),
        F.round(F.avg("word_count"), 2).alias("mean_word_count"),
        F.round(F.avg("char_count"), 2).alias("mean_char_count"),
        F.round(F.avg("confidence"), 3).alias("mean_confidence"),
    )


def text_issues(classified: DataFrame) -> DataFrame:
    """Rows without genuine text, with the first 100 characters as a sample."""
    kept = [c for c in classified.columns if c not in ("text", "lexical_diversity")]
    return classified.where(F.col("category") != GENUINE).select(
        *kept, F.substring("text", 1, 100).alias("text_sample")
    )
