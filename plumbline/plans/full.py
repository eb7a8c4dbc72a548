"""Profile, clean and validate a raw table in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans.cleaning import CleanParams, run_cleaning
from plumbline.plans.profiling import run_profiling
from plumbline.plans.validation import run_validation
from plumbline.sources.files import write_parquet, write_report


def run_all(
    raw: DataFrame,
    key: str = "row_id",
    params: CleanParams | None = None,
    contamination: float = 0.05,
    output: str | None = None,
) -> DataFrame:
    """One row: raw rows, cleaned rows, health score and grade.

    With ``output`` the cleaned table and all reports are written below it.
    """
    cleaned = run_cleaning(raw, key, params)
    checked = run_validation(cleaned.table, key, contamination)
    if output:
        write_report(run_profiling(raw, key), f"{output}/profile")
        write_parquet(cleaned.table, f"{output}/cleaned")
        write_report(
            {
                "duplicates": cleaned.duplicates,
                "log": cleaned.log,
                "score_before": cleaned.before,
                "score_after": cleaned.after,
                "delta": cleaned.delta,
            },
            f"{output}/cleaning",
        )
        parts = {
            "health": checked.health,
            "master_log": checked.master_log,
            "severities": checked.severities,
            "rule_summary": checked.rule_summary,
            "anomaly_overlap": checked.anomaly_overlap,
            "text_summary": checked.text_summary,
            "list_metrics": checked.list_metrics,
            "drift": checked.drift,
        }
        write_report({name: part for name, part in parts.items() if part is not None}, f"{output}/validation")
    return checked.health.select(
        raw.agg(F.count("*")).scalar().alias("raw_rows"),
        F.col("total_rows").alias("cleaned_rows"),
        "overall_health_score",
        "health_grade",
    )
