"""Staged CSV files and copies that follow their source."""

import gzip
import os

from plumbline.sources import files


def test_lines_that_do_not_fit_are_kept_apart(spark, tmp_path):
    path = tmp_path / "rows.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write('Key,Some Name,Price\n1,"a, b",2.5\nx,broken,1\n2,"say ""hi""",\n3,more,1.0,2\n')
    good, bad = files.stage_csv(spark, str(path), "Key int, `Some Name` string, Price double")
    assert [tuple(r) for r in files.standardize_column_names(good).orderBy("key").collect()] == [(1, "a, b", 2.5, 0), (2, 'say "hi"', None, 2)]
    assert sorted(tuple(r) for r in bad.collect()) == [(1, "x,broken,1"), (3, "3,more,1.0,2")] and bad.count() == 2


def test_copy_follows_its_source(spark, tmp_path):
    source, copy = tmp_path / "rows.csv", str(tmp_path / "copy")
    source.write_text("Key,Name\n1,a\n")
    assert files.cached_table(spark, str(source), copy, "Key int, Name string").count() == 1
    first = os.stat(copy).st_mtime_ns
    assert files.cached_table(spark, str(source), copy, "Key int, Name string").columns == ["key", "name"]
    assert os.stat(copy).st_mtime_ns == first  # not built again
    source.write_text("Key,Name\n1,a\n2,b\n")
    assert files.cached_table(spark, str(source), copy, "Key int, Name string").count() == 2
    assert files.cached_table(spark, str(source), copy, "Key string, Name string").dtypes == [("key", "string"), ("name", "string")]
    half = files.fingerprint(spark, str(source), "Key int, Name string")
    assert half != files.fingerprint(spark, str(source), "Key string, Name string") and len(half) == 64


def test_a_copy_that_was_not_finished_is_built_again(spark, tmp_path):
    source, copy = tmp_path / "rows.csv", str(tmp_path / "copy")
    source.write_text("Key\n1\n2\n")
    files.write_json(spark.range(0).selectExpr("'' AS fingerprint"), f"{copy}.manifest")
    files.write_parquet(spark.range(1).selectExpr("CAST(id AS int) AS key"), copy)
    assert files.cached_table(spark, str(source), copy, "Key int").count() == 2
