"""Validation of a cleaned table: rules, errors, anomalies, text, health."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plumbline.operators import anomaly, drift, errors, evaluate, health, listfields, rules, textquality
from plumbline.operators.issues import Check
from plumbline.session import compiled_methods, settle


@dataclass(frozen=True)
class Validated:
    """Results of the validation job; the reports are planned when asked for."""

    table: DataFrame
    key: str
    issues: DataFrame
    scores: DataFrame | None
    rule_list: Sequence[Check] | None = None

    @property
    def health(self) -> DataFrame:
        return health.health_score(self.issues, self.table)

    @property
    def rows(self) -> DataFrame:
        return health.row_health(self.issues, self.table, self.key)

    @property
    def master_log(self) -> DataFrame:
        return health.master_log(self.issues, self.table, self.key)

    @property
    def severities(self) -> DataFrame:
        return health.severity_summary(self.issues)

    @property
    def rule_summary(self) -> DataFrame:
        return rules.rule_summary(self.table, self.rule_list)

    @property
    def anomaly_overlap(self) -> DataFrame | None:
        return None if self.scores is None else anomaly.model_overlap(self.scores)

    @property
    def text_summary(self) -> DataFrame:
        return textquality.text_summary(textquality.classify_text(self.table, self.key))

    @property
    def list_metrics(self) -> DataFrame | None:
        if "amenities" not in self.table.columns:
            return None
        return listfields.list_metrics(listfields.parse_list_field(self.table), self.key)

    @property
    def drift(self) -> DataFrame:
        return drift.drift_report(self.table, "host_since")


def find_issues(
    df: DataFrame,
    key: str,
    rule_list: Sequence[Check] | None = None,
    scores: DataFrame | None = None,
    text_columns: Sequence[str] = textquality.TEXT_COLUMNS,
    count_list_issues: bool = False,
) -> DataFrame:
    """The issue table; anomalies take part when their ``scores`` are given.

    Rules, errors and texts are checked in one pass.
    """
    checks = rule_list or rules.standard_rules(df)
    table = health.checked_issues(errors.with_fences(df), key, checks, errors.error_checks(df), text_columns)
    lists = listfields.list_issues(listfields.parse_list_field(df), key) if count_list_issues else None
    rows = anomaly.anomaly_rows(df, key, scores=scores) if scores is not None else None
    if lists is None and rows is None:
        return table
    return table.unionByName(health.issue_table(key, anomalies=rows, lists=lists))


def run_validation(
    df: DataFrame,
    key: str = "row_id",
    contamination: float = anomaly.CONTAMINATION,
    rule_list: Sequence[Check] | None = None,
    with_anomalies: bool = True,
) -> Validated:
    """All findings about ``df`` and the scores built on them."""
    compiled_methods(df.sparkSession)
    scores = anomaly.anomaly_scores(df, key, contamination=contamination) if with_anomalies else None
    issues = settle(find_issues(df, key, rule_list, scores))
    return Validated(df, key, issues, scores, rule_list)


def run_text(
    df: DataFrame, key: str = "row_id", columns: Sequence[str] = textquality.TEXT_COLUMNS, list_column: str = "amenities"
) -> dict[str, DataFrame]:
    """Classes, means and findings of the text columns, and the figures of the list column."""
    classified = settle(textquality.classify_text(df, key, columns))
    parts = {
        "classified": classified,
        "summary": textquality.text_summary(classified),
        "means": textquality.text_means(classified),
        "issues": textquality.text_issues(classified),
    }
    if list_column in df.columns:
        lists = settle(listfields.parse_list_field(df, list_column))
        parts |= {
            "list_metrics": listfields.list_metrics(lists, key),
            "list_top_items": listfields.top_items(lists, key),
            "list_categories": listfields.category_counts(lists, key),
            "list_issues": listfields.list_issues(lists, key),
        }
    return parts


def run_evaluation(df: DataFrame, master_log: DataFrame, key: str = "row_id", sample_rows: int | None = 200) -> DataFrame:
    """Measures of the row scores on a seeded sample (the whole table with ``None``)."""
    sample = evaluate.seeded_sample(df, key, sample_rows) if sample_rows else None
    marked = settle(evaluate.labelled(df, master_log, key, sample))
    return evaluate.evaluation_metrics(marked).withColumn("roc_auc", evaluate.roc_auc(marked).scalar())
