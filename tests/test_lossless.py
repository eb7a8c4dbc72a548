"""Cases in which a value must not lose a digit, a file its order or a column its null."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from plumbline.functions.running import numbered, running_totals
from plumbline.operators import dedup, evaluate, features, impute, normalize, profile, schema, suspicious
from plumbline.sources import files


def test_rows_a_microsecond_apart_are_no_copies(spark):
    times = [dt.datetime(2024, 1, 1, 0, 0, 0, m) for m in (1, 999, 1)]
    rows = spark.createDataFrame([(i, t, [t]) for i, t in enumerate(times)], "row_id int, at timestamp, all array<timestamp>")
    assert [tuple(r) for r in dedup.exact_duplicates(rows, "row_id").collect()] == [(2, 0)]
    assert profile.dataset_summary(rows, "row_id").first().duplicate_rows == 1


def test_zero_has_one_sign_and_null_is_no_text(spark):
    rows = spark.createDataFrame([(1, 0.0, None), (2, -0.0, None), (3, None, "null"), (4, None, None)], "row_id int, x double, y string")
    assert [tuple(r) for r in dedup.exact_duplicates(rows, "row_id").collect()] == [(2, 1)]


BIG = 2**60


@pytest.mark.parametrize("rounds", [2, 16, 256])
def test_large_ids_beside_a_null_stay_apart(spark, monkeypatch, rounds):
    monkeypatch.setattr(dedup, "ROUND_ROWS", rounds)
    ids = [BIG, BIG + 10, None, BIG + 1, BIG + 2, BIG + 10]
    rows = [(i, k, f"name {chr(97 + i)}", 7, 1.0, 2.0) for i, k in enumerate(ids)]
    df = spark.createDataFrame(rows, "row_id bigint, id bigint, name string, host_id bigint, latitude double, longitude double")
    log = dedup.duplicate_log(df, "row_id", method="exact").collect()
    assert [(r.removed_key, r.retained_key, r.kind) for r in log] == [(5, 1, "exact")]


def test_dedup_by_other_columns_with_text_ids(spark):
    rows = [(1, "A-1", "x", "h", 1.0, 2.0), (2, "A-2", "x", "h", 1.0, 2.0), (3, None, "y", "h", 1.0, 2.0), (4, "A-1", "z", "h", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "k int, code string, title string, owner string, y double, x double")
    columns = dedup.Columns("code", "title", "owner", "y", "x")
    kept, log = dedup.deduplicate(df, "k", method="exact", columns=columns)
    assert sorted(r.k for r in kept.collect()) == [1, 3]
    described = dedup.describe_log(log, df, "k", columns).collect()
    assert sorted((r.removed_id, r.retained_id, r.owner) for r in described) == [("A-1", "A-1", "h"), ("A-2", "A-1", "h")]


def test_area_of_close_scores(spark):
    rows = spark.createDataFrame([(1, 0.00014), (1, 0.00013), (0, 0.00011), (0, 0.00012)], "truth int, score double")
    assert evaluate.roc_auc(rows).first().roc_auc == 1.0
    assert evaluate.roc_points(rows).count() == 4


def test_area_equals_pairs(spark):
    draw = random.Random(3)
    rows = [(int(draw.random() < 0.3), draw.choice([0.1, 0.2, 0.25, draw.random()])) for _ in range(400)]
    pos, neg = [s for t, s in rows if t], [s for t, s in rows if not t]
    pairs = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "truth int, score double")
    assert evaluate.roc_auc(df).first().roc_auc == pytest.approx(pairs, abs=5e-5)
    points = sorted(evaluate.roc_points(df).collect(), key=lambda r: -r.threshold)
    assert points[-1].fpr == points[-1].tpr == 1.0
    assert [p.tpr for p in points] == sorted(p.tpr for p in points)
    assert evaluate.roc_auc(df.where("truth = 1")).first().roc_auc is None


def test_running_totals_of_groups_and_nulls(spark):
    draw = random.Random(5)
    rows = [(draw.choice(["a", "b", None]), float(v), draw.randrange(9)) for v in draw.sample(range(5000), 900)]
    df = spark.createDataFrame(rows, "g string, v double, m int")
    for r in running_totals(df, "g", "v", ["m"]).collect():
        own = sorted((v, m) for g, v, m in rows if g == r.g)
        assert r.cum_m == sum(m for v, m in own if v <= r.v)
        assert r.next_value == min((v for v, _ in own if v > r.v), default=None)


def test_labels_are_ranked_over_ranges(spark):
    df = spark.range(150_001).selectExpr("lpad(id, 6, '0') AS label")
    wrong = numbered(df, "label", "code").where(F.col("label").cast("int") != F.col("code"))
    assert wrong.count() == 0
    rows = spark.createDataFrame([("b",), ("second ward",), (None,), ("b",)], "w string")
    assert [r.w_encoded for r in features.encode_labels(rows, "w").orderBy("w").collect()] == [0, 0, 0, 2]


def test_chained_regressions_of_many_columns(spark):
    draw = random.Random(7)
    names = [f"c{i}" for i in range(20)]
    rows = [[draw.gauss(0, 1)] for _ in range(300)]
    rows = [[None if draw.random() < 0.05 else r[0] * (i + 1) + draw.gauss(0, 0.01) for i in range(20)] for r in rows]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    filled = impute.impute_iterative(df, names, [])
    assert filled.where(" OR ".join(f"{n} IS NULL" for n in names)).count() == 0


@pytest.mark.parametrize(
    "text,day",
    [("2024-03-05", 5), ("05-03-2024", 5), ("2024-03-05 10:11", 5), ("2024-03-05T10:11:12.5", 5), ("2024-03-05T10:11:12Z", 5),
     ("2024-03-05 10:11:12.123456", 5), ("2024/03/05", 5), ("05/03/2024", 5), ("5 March 2024", 5), ("Mar 5, 2024", 5), ("20240305", 5), ("2024-03-05x", None), ("", None)],
)
def test_dates_are_read_whole(spark, text, day):
    df = spark.createDataFrame([(text,)], "d string")
    got = df.select(normalize.parse_date(df, "d", day_first=True).alias("d")).first().d
    assert got == (day and dt.date(2024, 3, day))


def test_row_keys_of_files(spark, tmp_path):
    for name, rows in (("b", range(5, 9)), ("a", range(5))):
        (tmp_path / f"{name}.csv").write_text("n,t\n" + "".join(f'{i},"two\nlines"\n' for i in rows))
    read = files.with_row_key(files.read_csv(spark, str(tmp_path)))
    assert read.schema["row_id"].dataType.simpleString() == "bigint"
    assert sorted((r.row_id, r.n) for r in read.collect()) == [(i, i) for i in range(9)]
    spark.range(100_000).repartition(3).sortWithinPartitions("id").write.parquet(str(tmp_path / "p"))
    keyed = files.with_row_key(spark.read.parquet(str(tmp_path / "p")))
    assert keyed.agg(F.countDistinct("row_id"), F.min("row_id"), F.max("row_id")).first()[:] == (100_000, 0, 99_999)


def test_files_round_trip(spark, tmp_path):
    rows = [(1, 'quote " and, comma', 1.5), (2, "two\nlines", None), (3, None, -0.25)]
    df = spark.createDataFrame(rows, "n int, t string, x double")
    files.write_csv(df.coalesce(1), str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), "n int, t string, x double")
    assert sorted(tuple(r) for r in back.collect()) == rows
    files.write_parquet(df, str(tmp_path / "parquet"))
    assert sorted(tuple(r) for r in files.read_parquet(spark, str(tmp_path / "parquet")).collect()) == rows
    files.write_report({"part": df}, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report/part")).count() == 3
    cached = str(tmp_path / "cache")
    assert files.parquet_or(spark, cached, lambda: df).count() == 3
    assert files.parquet_or(spark, cached, lambda: df.limit(0)).count() == 3
    assert files.read_spec(spark, str(tmp_path / "none.json")).count() == 0


def test_an_unreadable_cache_is_not_overwritten(spark, tmp_path):
    (tmp_path / "cache").mkdir()
    (tmp_path / "cache" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception) as caught:
        files.parquet_or(spark, str(tmp_path / "cache"), lambda: spark.range(1)).count()
    assert not isinstance(caught.value, AnalysisException) or not files.is_absent(caught.value)
    assert (tmp_path / "cache" / "part-0.parquet").read_text() == "no parquet"


def test_published_classes_read_all_blanks(spark):
    rows = spark.createDataFrame([(1, "1\u00a0bath"), (2, "2 baths"), (3, "x")], "row_id int, bathrooms_text string")
    got = {r["class"]: r.row_count for r in suspicious.format_classes(rows).collect()}
    assert got["standard_numeric_bath"] == 2 and got["other_unclassified"] == 1


def test_spec_round_trip_with_version(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n bigint, t string")
    spec = schema.infer_schema(rows)
    files.write_spec(spec, str(tmp_path / "spec"), "2.1", {"n": "a number"})
    document = spark.read.json(str(tmp_path / "spec")).first()
    assert document.version == "2.1" and document["columns"]["n"]["description"] == "a number"
    assert sorted(r.column for r in files.read_spec(spark, str(tmp_path / "spec")).collect()) == ["n", "t"]
