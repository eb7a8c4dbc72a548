"""Severity-weighted health: issue table, sub-scores, row scores, row log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import attach
from plumbline.operators.anomaly import MODELS
from plumbline.operators.issues import Check
from plumbline.operators.textquality import GENUINE, MISSING, with_text_quality

# Fixed values.
WEIGHTS = {"CRITICAL": 15.0, "HIGH": 10.0, "MEDIUM": 5.0, "LOW": 2.0}
SOURCES = {"rule": 0.35, "anomaly": 0.25, "text": 0.20, "error": 0.20}
GRADES = [(90, "A+"), (80, "A"), (70, "B"), (60, "C"), (50, "D")]
PENALTY_FACTOR = 20.0
ROW_FACTOR = 3.0


def weight(severity: Column) -> Column:
    case = F.lit(0.0)
    for name, value in WEIGHTS.items():
        case = F.when(severity == name, value).otherwise(case)
    return case


def _issues(log: DataFrame, key: str, source: str, name: Column, severity: Column, detail: Column) -> DataFrame:
    return log.select(
        F.col(key).alias("row_key"),
        F.lit(source).alias("source"),
        name.alias("name"),
        severity.alias("severity"),
        detail.cast("string").alias("detail"),
    )


def issue_table(
    key: str,
    rules: DataFrame | None = None,
    errors: DataFrame | None = None,
    anomalies: DataFrame | None = None,
    texts: DataFrame | None = None,
    lists: DataFrame | None = None,
) -> DataFrame:
    """All findings in one form: ``(row_key, source, name, severity, detail, weight)``.

    ``lists`` counts list-field issues as LOW in the text source; leave it out
    to score without them.
    """
    parts = []
    if rules is not None:
        parts.append(_issues(rules, key, "rule", F.col("rule_name"), F.col("severity"), F.col("details")))
    if errors is not None:
        parts.append(_issues(errors, key, "error", F.col("error_type"), F.col("severity"), F.col("details")))
    if anomalies is not None:
        both = F.col("flagged_by")[MODELS[0]] & F.col("flagged_by")[MODELS[1]]
        severity = F.when(F.col("anomaly_consensus") | both, "HIGH").otherwise("MEDIUM")
        parts.append(
            _issues(anomalies, key, "anomaly", F.lit("anomaly"), severity, F.array_join("reasons", "; "))
        )
    if texts is not None:
        severity = F.when(F.col("category") == MISSING, "MEDIUM").otherwise("LOW")
        name = F.concat(F.col("column"), F.lit(":"), F.col("category"))
        parts.append(_issues(texts, key, "text", name, severity, F.col("text_sample")))
    if lists is not None:
        exploded = lists.select(key, F.explode("issues").alias("issue"))
        parts.append(_issues(exploded, key, "text", F.col("issue"), F.lit("LOW"), F.lit(None)))
    if not parts:
        raise ValueError("no issue source given")
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table.withColumn("weight", weight(F.col("severity")))


def checked_issues(
    df: DataFrame, key: str, rules: Sequence[Check], errors: Sequence[Check], text_columns: Sequence[str]
) -> DataFrame:
    """The issues of rules, errors and texts in one pass over ``df``, in the form of :func:`issue_table`.

    ``df`` has what the checks refer to (the fences, for the errors). All findings of a row are
    one array, so nothing is joined or read again.
    """
    rows, found = df, []
    for source, checks in (("rule", rules), ("error", errors)):
        found += [F.when(c.fails, _finding(source, F.lit(c.name), F.lit(c.severity), c.details)) for c in checks]
    for i, c in enumerate(text_columns):
        text = F.col(c) if c in df.columns else F.lit(None).cast("string")
        rows = with_text_quality(rows.withColumn("__text", text), "__text").withColumnsRenamed(
            {"category": f"__class{i}", "__text": f"__text{i}"}
        )
        rows = rows.drop("confidence", "word_count", "char_count", "lexical_diversity")
        category = F.col(f"__class{i}")
        severity = F.when(category == MISSING, "MEDIUM").otherwise("LOW")
        issue = _finding("text", F.concat(F.lit(f"{c}:"), category), severity, F.substring(f"__text{i}", 1, 100))
        found.append(F.when(category != GENUINE, issue))
    table = rows.select(F.col(key).alias("row_key"), F.inline(F.array_compact(F.array(*found))))
    return table.withColumn("weight", weight(F.col("severity")))


def _finding(source: str, name: Column, severity: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(source).alias("source"), name.alias("name"), severity.alias("severity"), detail.cast("string").alias("detail")
    )


def health_score(issues: DataFrame, base: DataFrame, shares: Mapping[str, float] = SOURCES) -> DataFrame:
    """One row: sub-score per source, overall score and grade."""
    rows = base.agg(F.count("*").alias("n"))
    sums = issues.agg(
        *[F.coalesce(F.sum(F.when(F.col("source") == s, F.col("weight"))), F.lit(0.0)).alias(s) for s in shares]
    )
    counted = attach(sums, rows, "__rows")
    n = F.col("__rows")["n"]
    subs = counted.select(
        n.alias("total_rows"),
        *[
            F.greatest(F.lit(0.0), F.round(100.0 - F.try_divide(F.col(s), n) * PENALTY_FACTOR, 2)).alias(f"{s}_score")
            for s in shares
        ],
    )
    overall = F.round(sum((F.col(f"{s}_score") * share for s, share in shares.items()), F.lit(0.0)), 2)
    grade = F.lit("F")
    for low, name in reversed(GRADES):
        grade = F.when(F.col("overall_health_score") >= low, name).otherwise(grade)
    return subs.withColumn("overall_health_score", overall).withColumn("health_grade", grade)


def row_health(issues: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Health of every row: 100 without issues."""
    penalties = issues.groupBy("row_key").agg(F.sum("weight").alias("penalty"), F.count("*").alias("issue_count"))
    joined = base.select(key).join(penalties, F.col(key) == F.col("row_key"), "left")
    return joined.select(
        key,
        F.greatest(F.lit(0.0), F.round(100.0 - F.coalesce("penalty", F.lit(0.0)) * ROW_FACTOR, 2)).alias("row_health_score"),
        F.coalesce("issue_count", F.lit(0)).alias("issue_count"),
    )


def severity_summary(issues: DataFrame) -> DataFrame:
    """Issues per severity, all four listed, in one row with the total."""
    return issues.agg(
        *[F.count_if(F.col("severity") == s).alias(f"{s.lower()}_count") for s in WEIGHTS],
        F.count("*").alias("total_issues_count"),
    )


def master_log(issues: DataFrame, base: DataFrame, key: str, row_id: str = "id") -> DataFrame:
    """Rows with issues: health score and one list of issues per source.

    A row has at most one issue per check and text column, so the lists are short.
    """
    fields = F.struct("name", "severity", "detail")
    lists = {
        "rule_violations": "rule",
        "anomalies": "anomaly",
        "text_issues": "text",
        "statistical_errors": "error",
    }
    grouped = issues.groupBy("row_key").agg(
        F.sum("weight").alias("penalty"),
        *[
            F.sort_array(F.collect_list(F.when(F.col("source") == s, fields))).alias(name)
            for name, s in lists.items()
        ],
    )
    identity = F.col(row_id).cast("string") if row_id in base.columns else F.col(key).cast("string")
    ids = base.select(F.col(key).alias("__k"), identity.alias("listing_id"))
    return grouped.join(ids, F.col("row_key") == F.col("__k")).select(
        F.col("row_key").alias(key),
        "listing_id",
        F.greatest(F.lit(0.0), F.round(100.0 - F.col("penalty") * ROW_FACTOR, 2)).alias("row_health_score"),
        *lists,
    )
