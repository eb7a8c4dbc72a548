"""A cross-section of the registered queries against their SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
NAMES = [
    "csv_round_trip",
    "column_profile_listings",
    "metadata_report",
    "boxplot_stats",
    "inferred_schema",
    "duplicates_by_edit_distance",
    "duplicates_by_terms",
    "impute_knn",
    "clean_table",
    "quality_score",
    "rule_violations",
    "statistical_errors",
    "drift_listings",
    "drift_report",
    "network_reconstruction",
    "lof_scores",
    "text_quality",
    "list_parse",
    "master_log",
    "roc_auc",
]


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, entry.queries()[name], entry.oracle_sql()[name], SF) == []


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
