"""The profile of a table as a dict of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from plumbline.operators import profile, schema, suspicious


def suspicious_report(df: DataFrame, key: str) -> dict[str, DataFrame]:
    """Personal-data columns, format classes and impossible values."""
    parts = {"pii_columns": suspicious.pii_columns(df)}
    if "bathrooms_text" in df.columns:
        parts["format_classes"] = suspicious.format_classes(df)
        parts["format_samples"] = suspicious.format_samples(df, key)
    if suspicious.suspicious_predicates(df):
        parts["suspicious_rows"] = suspicious.suspicious_rows(df)
        parts["suspicious_samples"] = suspicious.suspicious_samples(df, key)
    return parts


def run_profiling(df: DataFrame, key: str, approx: bool = False) -> dict[str, DataFrame]:
    """Everything the profile reports about ``df`` itself."""
    parts = {
        "dataset_summary": profile.dataset_summary(df, key),
        "column_profile": profile.column_profile(df, key, approx),
        "metadata": profile.metadata_report(df, key),
        "schema": schema.infer_schema(df, key),
        "missing_matrix": profile.missing_matrix(df, key),
    }
    numeric = [c for c in profile.numeric_columns(df) if c != key]
    if numeric:
        parts["distribution"] = profile.distribution_stats(df, numeric)
    correlated = [c for c in profile.CORRELATION_COLUMNS if c in numeric]
    if correlated:
        parts["correlation"] = profile.correlation_matrix(df, correlated)
    if len([c for c in profile.TRIANGLE_COLUMNS if c in numeric]) > 1:
        parts["correlation_triangle"] = profile.correlation_triangle(df)
    boxed = [c for c in ("minimum_nights", "availability_365") if c in df.columns]
    if boxed:
        parts["boxplot"] = profile.boxplot_stats(df, boxed)
    return parts | suspicious_report(df, key)
