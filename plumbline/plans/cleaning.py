"""Cleaning of a raw table: duplicates, missing cells, formats, features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import dedup, features, impute, normalize, quality, schema
from plumbline.session import compiled_methods, settle


@dataclass(frozen=True)
class CleanParams:
    """Settings of the cleaning job."""

    threshold: float = 0.85
    similarity: str = "ratio"
    imputation: str = "median"


@dataclass(frozen=True)
class Cleaned:
    """Results of the cleaning job; the reports are planned when asked for."""

    raw: DataFrame
    table: DataFrame
    duplicates: DataFrame
    key: str

    @property
    def log(self) -> DataFrame:
        return cleaning_log(self.raw, self.table, self.key)

    @property
    def before(self) -> DataFrame:
        return quality.quality_score(self.raw, self.key)

    @property
    def after(self) -> DataFrame:
        return quality.quality_score(self.table, self.key)

    @property
    def delta(self) -> DataFrame:
        return quality.quality_delta(self.before, self.after)


def clean_table(imputed: DataFrame, raw: DataFrame | None = None, key: str = "row_id") -> DataFrame:
    """Formats and features of an already imputed table."""
    return features.transform_table(normalize.normalize_table(imputed, raw, key))


def cleaning_log(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """One row: rows and columns before and after."""
    return after.agg(F.count("*").alias("rows_after")).select(
        before.agg(F.count("*")).scalar().alias("rows_before"),
        F.lit(len([c for c in before.columns if c != key])).alias("columns_before"),
        "rows_after",
        F.lit(len([c for c in after.columns if c != key])).alias("columns_after"),
    )


def run_cleaning(raw: DataFrame, key: str = "row_id", params: CleanParams | None = None) -> Cleaned:
    """Deduplicate, impute, normalize and score a raw table.

    The cleaned table is settled: scores, rules and anomalies read it many times.
    """
    compiled_methods(raw.sparkSession)
    params = params or CleanParams()
    unique, duplicates = dedup.deduplicate(raw, key, params.threshold, params.similarity)
    unique = settle(unique)
    spec = schema.infer_schema(unique, key)
    imputed = settle(impute.impute_table(unique, key, spec, params.imputation))
    cleaned = settle(clean_table(imputed, raw, key))
    return Cleaned(raw, cleaned, duplicates, key)
