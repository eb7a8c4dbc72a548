"""Registered queries: one per operator, over the given tables.

Every query reads whole tables. Results are flat: arrays are joined to text and
floats rounded, so that they can be compared with SQL.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators import (
    anomaly,
    dedup,
    drift,
    errors,
    evaluate,
    features,
    health,
    impute,
    listfields,
    normalize,
    profile,
    quality,
    rules,
    schema,
    suspicious,
    textquality,
)
from plumbline.plans import cleaning, full, validation
from plumbline.session import compiled_methods, ensure_checkpoint_dir, settle
from plumbline.sources import files
from plumbline.sources.derived import host_profiles, listings, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = "row_id"
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PROFILE_FEATURES = ["balance", "orders_count", "mean_price", "top_price"]
PROFILE_NUMBERS = [*PROFILE_FEATURES, "nation"]


def query(run: Query) -> Query:
    @functools.wraps(run)
    def prepared(spark: SparkSession, sf: str) -> DataFrame:
        compiled_methods(spark)
        return run(spark, sf)

    QUERIES[run.__name__] = prepared
    return prepared


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Files


@query
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A table written as gzip CSV with header texts to the shared folder, staged by a pinned schema and numbered by place."""
    rows = table(spark, sf, "customer")
    titles = [c.replace("_", " ").title() for c in rows.columns]
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    files.write_csv(rows.orderBy("c_custkey").toDF(*titles), path, "gzip")
    schema = T.StructType([T.StructField(t, f.dataType) for t, f in zip(titles, rows.schema.fields, strict=True)])
    good, bad = files.stage_csv(spark, path, schema)
    return files.standardize_column_names(good).withColumn("corrupt_lines", bad.agg(F.count("*")).scalar())


# Profiles


@query
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.dataset_summary(listings(spark, sf), KEY)


@query
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_profile(table(spark, sf, "orders"))


@query
def column_profile_listings(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_profile(listings(spark, sf), KEY)


@query
def column_profile_approx(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_profile(table(spark, sf, "lineitem"), approx=True)


@query
def distribution_stats(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distribution_stats(table(spark, sf, "lineitem"), LINE_NUMBERS, digits=4)


@query
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return profile.correlation_matrix(table(spark, sf, "lineitem"), LINE_NUMBERS)


@query
def correlation_triangle(spark: SparkSession, sf: str) -> DataFrame:
    return profile.correlation_triangle(listings(spark, sf))


@query
def missing_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return profile.missing_matrix(listings(spark, sf), KEY)


@query
def boxplot_stats(spark: SparkSession, sf: str) -> DataFrame:
    return profile.boxplot_stats(listings(spark, sf), ["minimum_nights", "availability_365"])


@query
def boxplot_fliers(spark: SparkSession, sf: str) -> DataFrame:
    return profile.boxplot_fliers(listings(spark, sf), KEY, "minimum_nights")


@query
def metadata_report(spark: SparkSession, sf: str) -> DataFrame:
    return profile.metadata_report(listings(spark, sf), KEY)


@query
def inferred_schema(spark: SparkSession, sf: str) -> DataFrame:
    spec = schema.infer_schema(listings(spark, sf), KEY)
    return spec.withColumn("allowed_values", F.array_join("allowed_values", "|"))


@query
def observed_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return schema.observed_bounds(listings(spark, sf), KEY)


# Suspicious columns and rows


@query
def pii_profile(spark: SparkSession, sf: str) -> DataFrame:
    return suspicious.pii_profile(listings(spark, sf), KEY)


@query
def pii_scan(spark: SparkSession, sf: str) -> DataFrame:
    return suspicious.pii_scan(table(spark, sf, "documents"), ["text"])


@query
def format_classes(spark: SparkSession, sf: str) -> DataFrame:
    return suspicious.format_classes(listings(spark, sf))


@query
def format_samples(spark: SparkSession, sf: str) -> DataFrame:
    return suspicious.format_samples(listings(spark, sf), KEY)


@query
def suspicious_rows(spark: SparkSession, sf: str) -> DataFrame:
    return suspicious.suspicious_rows(listings(spark, sf))


@query
def suspicious_samples(spark: SparkSession, sf: str) -> DataFrame:
    return suspicious.suspicious_samples(listings(spark, sf), KEY)


# Duplicates


@query
def exact_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.exact_duplicates(listings(spark, sf), KEY)


@query
def exact_duplicates_events(spark: SparkSession, sf: str) -> DataFrame:
    """Copies among events that agree in user, kind and the minute's start or in the full time."""
    events = table(spark, sf, "events")
    return dedup.exact_duplicates(events, "event_id", ["ts", "user_id", "event_type"]).unionByName(
        dedup.exact_duplicates(events.withColumn("ts", F.date_trunc("minute", "ts")), "event_id", ["ts", "event_type"])
    )


@query
def key_first(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.keep_first(listings(spark, sf), KEY, ["id"]).select(KEY, "id")


@query
def block_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.block_summary(listings(spark, sf))


@query
def duplicates_by_id_or_name(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.duplicate_log(listings(spark, sf), KEY, method="exact").drop("similarity")


@query
def duplicates_by_edit_distance(spark: SparkSession, sf: str) -> DataFrame:
    log = dedup.duplicate_log(listings(spark, sf), KEY, threshold=0.9, method="levenshtein")
    return log.select("removed_key", "retained_key", "kind")


@query
def duplicates_by_ratio(spark: SparkSession, sf: str) -> DataFrame:
    log = dedup.duplicate_log(listings(spark, sf), KEY, threshold=0.85)
    return _rounded(log, "similarity")


@query
def duplicates_by_terms(spark: SparkSession, sf: str) -> DataFrame:
    log = dedup.duplicate_log(listings(spark, sf), KEY, threshold=0.8, method="tfidf")
    return _rounded(log, "similarity")


@query
def duplicate_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = listings(spark, sf)
    return dedup.duplicate_counts(dedup.duplicate_log(rows, KEY, method="exact"), rows)


@query
def deduplicated_rows(spark: SparkSession, sf: str) -> DataFrame:
    kept, _ = dedup.deduplicate(listings(spark, sf), KEY, method="exact")
    return kept.select(KEY, "id")


@query
def cleaning_log(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and columns before and after the cleaning job."""
    params = cleaning.CleanParams(similarity="exact", imputation="median")
    return cleaning.run_cleaning(listings(spark, sf), KEY, params).log


# Missing cells


@query
def impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    filled = impute.impute_mode(listings(spark, sf), "neighbourhood_group_cleansed", "neighbourhood_cleansed")
    return filled.select(KEY, "neighbourhood_group_cleansed")


@query
def impute_group_median(spark: SparkSession, sf: str) -> DataFrame:
    filled = impute.impute_group_median(listings(spark, sf), "review_scores_rating", "room_type")
    return _rounded(filled.select(KEY, "review_scores_rating_stat_imputed"), "review_scores_rating_stat_imputed")


@query
def impute_median(spark: SparkSession, sf: str) -> DataFrame:
    filled = impute.impute_constants(listings(spark, sf), ["price", "beds", "bedrooms"], "median")
    return _rounded(filled.select(KEY, "price", "beds", "bedrooms"), "price", "beds", "bedrooms")


@query
def impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    filled = impute.impute_constants(listings(spark, sf), ["price", "beds", "bedrooms"], "mean")
    return _rounded(filled.select(KEY, "price", "beds", "bedrooms"), "price", "beds", "bedrooms")


@query
def enforce_non_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = listings(spark, sf)
    filled = impute.enforce_non_null(rows, schema.infer_schema(rows, KEY))
    return filled.select(KEY, "price", "minimum_nights", "room_type", "latitude", "review_scores_rating")


@query
def missing_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = listings(spark, sf)
    return impute.missing_summary(rows, impute.impute_constants(rows, ["price", "beds", "bedrooms"]), KEY)


@query
def impute_knn(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(impute.knn_fills(host_profiles(spark, sf), "host_id", PROFILE_NUMBERS), "fill")


@query
def impute_knn_listings(spark: SparkSession, sf: str) -> DataFrame:
    filled = impute.impute_knn(listings(spark, sf), KEY)
    return _rounded(filled.select(KEY, "bedrooms", "beds", "review_scores_rating", "price"), "price")


@query
def impute_iterative(spark: SparkSession, sf: str) -> DataFrame:
    filled = impute.impute_iterative(listings(spark, sf))
    return _rounded(filled.select(KEY, "bedrooms", "beds", "review_scores_rating", "price"), "price")


# Formats and features


@query
def normalize_price(spark: SparkSession, sf: str) -> DataFrame:
    rows = listings(spark, sf)
    return normalize.normalize_price(rows, rows, KEY).select(KEY, "price")


@query
def parse_quantity_text(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.parse_quantity_text(listings(spark, sf)).select(KEY, "bathrooms", "bathroom_type")


@query
def standardize_places(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.standardize_places(listings(spark, sf)).select(KEY, "neighbourhood", "neighbourhood_cleansed")


@query
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.parse_dates(listings(spark, sf)).select(KEY, "last_scraped", "host_since")


@query
def encode_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return features.encode_fixed(listings(spark, sf)).select(KEY, "room_type_encoded")


@query
def encode_labels(spark: SparkSession, sf: str) -> DataFrame:
    coded = features.encode_labels(listings(spark, sf), "neighbourhood_group_cleansed")
    return coded.select(KEY, "neighbourhood_group_cleansed_encoded")


@query
def tenure_days(spark: SparkSession, sf: str) -> DataFrame:
    return features.tenure_days(normalize.parse_dates(listings(spark, sf))).select(KEY, "host_tenure_days")


@query
def unit_price(spark: SparkSession, sf: str) -> DataFrame:
    rows = listings(spark, sf)
    return features.unit_price(normalize.normalize_price(rows, rows, KEY)).select(KEY, "price_per_bedroom")


@query
def clean_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = listings(spark, sf)
    cleaned = cleaning.clean_table(rows, rows, KEY)
    return cleaned.select(
        KEY,
        "id",
        "price",
        "bathrooms",
        "bathroom_type",
        "neighbourhood",
        "neighbourhood_cleansed",
        "last_scraped",
        "host_since",
        "room_type_encoded",
        "neighbourhood_group_cleansed_encoded",
        "host_tenure_days",
        "price_per_bedroom",
    )


# Quality score


@query
def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_score(listings(spark, sf), KEY)


@query
def missing_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing_gaps(listings(spark, sf), KEY)


@query
def quality_delta(spark: SparkSession, sf: str) -> DataFrame:
    rows = listings(spark, sf)
    after = cleaning.clean_table(rows, rows, KEY)
    return quality.quality_delta(quality.quality_score(rows, KEY), quality.quality_score(after, KEY))


# Rules and errors


@query
def rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    log = rules.rule_violations(listings(spark, sf), KEY)
    return log.select(KEY, "listing_id", "rule_id", "rule_name", "severity", "column", "value")


@query
def rule_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = listings(spark, sf)
    checks = [*rules.standard_rules(rows), rules.response_rate_rule(rows)]
    return rules.rule_summary(rows, checks).drop("description")


@query
def custom_rules(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    checks = [
        rules.expression_rule("C1", "discount_small", "numeric_range", "HIGH", "l_discount", "l_discount <= 0.05"),
        rules.expression_rule("C2", "tax_below_discount", "cross_field", "LOW", "l_tax", "l_tax < l_discount"),
        rules.expression_rule("C3", "flag_known", "categorical", "HIGH", "l_returnflag", "l_returnflag IN ('A', 'N')"),
    ]
    return rules.rule_summary(lines, checks).drop("description")


@query
def unknown_members(spark: SparkSession, sf: str) -> DataFrame:
    known = listings(spark, sf).select("neighbourhood_cleansed")
    found = rules.unknown_members(
        listings(spark, sf), "neighbourhood_group_cleansed", known, "neighbourhood_cleansed"
    )
    return found.select(KEY, "neighbourhood_group_cleansed")


@query
def statistical_errors(spark: SparkSession, sf: str) -> DataFrame:
    log = errors.statistical_errors(listings(spark, sf), KEY)
    return log.select(KEY, "listing_id", "error_type", "severity", "column", F.col("value").cast("double").alias("value"))


@query
def error_summary(spark: SparkSession, sf: str) -> DataFrame:
    return errors.error_summary(listings(spark, sf))


@query
def zscore_outliers(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return errors.zscore_outliers(lines, ["l_extendedprice", "l_discount"], ["l_orderkey", "l_linenumber"], 1.5)


@query
def iqr_outliers(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    found = errors.iqr_outliers(lines, ["l_extendedprice", "l_quantity"], ["l_orderkey", "l_linenumber"], 0.3)
    return _rounded(found, "fence")


# Drift


@query
def drift_orders(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_by_date(table(spark, sf, "orders"), "o_orderdate", ["o_totalprice", "o_custkey"])


@query
def drift_listings(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_by_date(listings(spark, sf), "host_since")


@query
def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_report(table(spark, sf, "orders"), "o_orderdate", ["o_totalprice", "o_custkey"])


@query
def drift_raw_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    rows = listings(spark, sf)
    return drift.drift_between_tables(rows, normalize.normalize_price(rows, rows, KEY))


# Anomalies


@query
def lof_scores(spark: SparkSession, sf: str) -> DataFrame:
    scaled = settle(anomaly.scaled_features(host_profiles(spark, sf), "host_id", PROFILE_FEATURES))
    scored = anomaly.lof_scores(scaled, [f"z_{f}" for f in PROFILE_FEATURES])
    return _rounded(scored, "lof")


@query
def isolation_forest(spark: SparkSession, sf: str) -> DataFrame:
    scaled = settle(anomaly.scaled_features(listings(spark, sf), KEY))
    scored = anomaly.isolation_scores(scaled, [f"z_{f}" for f in anomaly.FEATURES])
    return _rounded(scored, "if_score")


@query
def pca_reconstruction(spark: SparkSession, sf: str) -> DataFrame:
    scaled = settle(anomaly.scaled_features(listings(spark, sf), KEY))
    scored = anomaly.reconstruction_errors(scaled, [f"z_{f}" for f in anomaly.FEATURES])
    return _rounded(scored, "mse")


@query
def network_reconstruction(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with an error, and whether the network's total error is at most the projection's, of which it is a start."""
    scaled = settle(anomaly.scaled_features(listings(spark, sf), KEY))
    columns = [f"z_{f}" for f in anomaly.FEATURES]
    both = anomaly.network_errors(scaled, columns).withColumnRenamed("mse", "network")
    both = both.join(anomaly.reconstruction_errors(scaled, columns), "key")
    return both.agg(
        F.count("network").alias("reconstructed_rows"),
        F.min(F.col("network") >= 0).alias("all_errors_valid"),
        (F.sum("network") <= F.sum("mse") * (1 + 1e-9)).alias("at_most_projection"),
    )


def _profile_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = host_profiles(spark, sf)
    scores = {"top_price": "flag_top", "mean_price": "flag_mean", "orders_count": "flag_count"}
    return anomaly.flag_top_share(rows, scores, 0.05, inclusive=["orders_count"])


@query
def share_flags(spark: SparkSession, sf: str) -> DataFrame:
    flagged = _profile_flags(spark, sf)
    scores = [f"{f}_score" for f in ("flag_top", "flag_mean", "flag_count")]
    return _rounded(flagged.select("host_id", "flag_top", "flag_mean", "flag_count", *scores), *scores)


@query
def anomaly_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.model_overlap(_profile_flags(spark, sf), ["flag_top", "flag_mean", "flag_count"])


@query
def anomaly_reasons(spark: SparkSession, sf: str) -> DataFrame:
    reasoned = anomaly.with_reasons(host_profiles(spark, sf), ["balance", "mean_price", "top_price"])
    return reasoned.select("host_id", F.array_join("reasons", "; ").alias("reasons"))


@query
def anomaly_rows(spark: SparkSession, sf: str) -> DataFrame:
    found = anomaly.anomaly_rows(listings(spark, sf), KEY)
    return found.select(
        KEY, "listing_id", "flagged_by.*", "anomaly_consensus", F.array_join("reasons", "; ").alias("reasons")
    )


# Text and list fields


@query
def text_quality(spark: SparkSession, sf: str) -> DataFrame:
    return textquality.classify_text(table(spark, sf, "documents"), "doc_id", ["text"]).drop("text")


@query
def text_summary(spark: SparkSession, sf: str) -> DataFrame:
    return textquality.text_summary(textquality.classify_text(listings(spark, sf), KEY))


@query
def text_means(spark: SparkSession, sf: str) -> DataFrame:
    return textquality.text_means(
        textquality.classify_text(table(spark, sf, "conversations"), ["conv_id", "turn"], ["text", "role"])
    )


@query
def text_issues(spark: SparkSession, sf: str) -> DataFrame:
    return textquality.text_issues(textquality.classify_text(listings(spark, sf), KEY, ["description"]))


@query
def list_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = listfields.parse_list_field(listings(spark, sf))
    return parsed.select(
        KEY, "format_type", F.array_join("items", "|").alias("items"), F.array_join("issues", "|").alias("issues")
    )


@query
def list_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return listfields.list_metrics(listfields.parse_list_field(listings(spark, sf)), KEY)


@query
def list_top_items(spark: SparkSession, sf: str) -> DataFrame:
    return listfields.top_items(listfields.parse_list_field(listings(spark, sf)), KEY)


@query
def list_categories(spark: SparkSession, sf: str) -> DataFrame:
    return listfields.category_counts(listfields.parse_list_field(listings(spark, sf)), KEY)


@query
def list_issues(spark: SparkSession, sf: str) -> DataFrame:
    found = listfields.list_issues(listfields.parse_list_field(listings(spark, sf)), KEY)
    return found.withColumn("issues", F.array_join("issues", "|"))


# Health and evaluation


def _listing_issues(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = listings(spark, sf)
    return validation.find_issues(rows, KEY, text_columns=["description"]), rows


@query
def health_score(spark: SparkSession, sf: str) -> DataFrame:
    return health.health_score(*_listing_issues(spark, sf))


@query
def row_health(spark: SparkSession, sf: str) -> DataFrame:
    return health.row_health(*_listing_issues(spark, sf), KEY)


@query
def severity_summary(spark: SparkSession, sf: str) -> DataFrame:
    return health.severity_summary(_listing_issues(spark, sf)[0])


@query
def severity_with_lists(spark: SparkSession, sf: str) -> DataFrame:
    rows = listings(spark, sf)
    found = validation.find_issues(rows, KEY, text_columns=["description"], count_list_issues=True)
    return health.severity_summary(found)


@query
def master_log(spark: SparkSession, sf: str) -> DataFrame:
    log = health.master_log(*_listing_issues(spark, sf), KEY)
    names = [
        F.array_join(F.transform(c, lambda e: e["name"]), "|").alias(c)
        for c in ("rule_violations", "anomalies", "text_issues", "statistical_errors")
    ]
    return log.select(KEY, "listing_id", "row_health_score", *names)


@query
def validation_report(spark: SparkSession, sf: str) -> DataFrame:
    """All four issue sources together, anomalies included."""
    log = validation.run_validation(listings(spark, sf), KEY).master_log
    sizes = [
        F.size(c).alias(f"{c}_count") for c in ("rule_violations", "anomalies", "text_issues", "statistical_errors")
    ]
    return log.select(KEY, "listing_id", "row_health_score", *sizes)


def _labelled(spark: SparkSession, sf: str, sample: bool) -> DataFrame:
    issues, rows = _listing_issues(spark, sf)
    log = health.master_log(issues, rows, KEY)
    return evaluate.labelled(rows, log, KEY, evaluate.seeded_sample(rows, KEY) if sample else None)


@query
def evaluation_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_labelled(spark, sf, sample=True), "score")


@query
def evaluation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.evaluation_metrics(_labelled(spark, sf, sample=False))


@query
def evaluation_job(spark: SparkSession, sf: str) -> DataFrame:
    """All measures of the evaluation job on its seeded sample."""
    issues, rows = _listing_issues(spark, sf)
    return validation.run_evaluation(rows, health.master_log(issues, rows, KEY), KEY)


def _label_scores(spark: SparkSession, sf: str) -> DataFrame:
    classified = textquality.classify_text(table(spark, sf, "documents"), "doc_id", ["text"])
    return classified.join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id",
        F.col("quality").alias("truth"),
        (F.col("confidence") >= 0.75).cast("int").alias("predicted"),
        F.col("confidence").alias("score"),
    )


@query
def label_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.evaluation_metrics(_label_scores(spark, sf))


@query
def roc_points(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluate.roc_points(_label_scores(spark, sf)), "threshold", "fpr", "tpr")


@query
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.roc_auc(_label_scores(spark, sf))


@query
def end_to_end_summary(spark: SparkSession, sf: str) -> DataFrame:
    return full.run_all(listings(spark, sf), KEY)
