"""From a gzip CSV to the reports, as a user runs it."""

import gzip

import pandas as pd
import pytest

from plumbline.plans.cleaning import CleanParams
from plumbline.plans.full import run_all
from plumbline.plans.validation import run_evaluation, run_text, run_validation
from plumbline.sources import files
from plumbline.sources.derived import listings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    rows = listings(spark, SF).limit(400).toPandas().drop(columns="row_id")
    rows.columns = [c.replace("_", " ").title() for c in rows.columns]
    with gzip.open(folder / "listings.csv.gz", "wt") as out:
        pd.concat([rows, rows.head(5)]).to_csv(out, index=False)
    read = files.standardize_column_names(files.read_csv(spark, str(folder / "listings.csv.gz")))
    return files.with_row_key(files.load_table(spark, str(folder / "listings.csv.gz"), str(folder / "cache"))), read


def test_csv_to_report(spark, loaded, tmp_path):
    table, read = loaded
    assert table.count() == read.count() == 405
    out = str(tmp_path / "report")
    summary = run_all(table, "row_id", CleanParams(threshold=0.85), output=out).first()
    assert summary.raw_rows == 405 and summary.cleaned_rows <= 400 and 0 <= summary.overall_health_score <= 100
    cleaned = spark.read.parquet(f"{out}/cleaned")
    assert cleaned.count() == summary.cleaned_rows
    log = spark.read.json(f"{out}/cleaning/log").first()
    assert (log.rows_before, log.rows_after) == (405, summary.cleaned_rows)
    copies = int(read.toPandas().duplicated().sum())
    assert copies >= 5
    assert spark.read.json(f"{out}/cleaning/duplicates").where("kind = 'exact_full_row'").count() == copies
    assert spark.read.json(f"{out}/profile/dataset_summary").first().duplicate_rows == copies


def test_text_job(loaded):
    table, _ = loaded
    parts = run_text(table)
    assert parts["classified"].count() == 810
    assert parts["summary"].agg({"rows": "sum"}).first()[0] == 810
    assert parts["list_metrics"].first().total_processed == 405
    assert parts["list_top_items"].count() <= 20 and parts["list_issues"].count() <= 405


def test_evaluation_of_a_file_table(loaded):
    table, _ = loaded
    checked = run_validation(table, "row_id", with_anomalies=False)
    measured = run_evaluation(table, checked.master_log, "row_id", 200).first()
    assert measured.sample_size == 200 and measured.tp + measured.fp + measured.fn + measured.tn == 200
    assert 0.5 <= measured.roc_auc <= 1.0
