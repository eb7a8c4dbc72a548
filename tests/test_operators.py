"""Hand-made micro tables per operator."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import quantiles
from plumbline.operators import drift, evaluate, features, health, impute, listfields, normalize, profile, quality, rules
from plumbline.operators import schema, textquality
from plumbline.session import compiled_methods
from plumbline.sources import files


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Host Name ", "Price ($)", "__A--B"])
    assert files.standardize_column_names(df).columns == ["host_name", "price", "a_b"]
    with pytest.raises(ValueError):
        files.standardize_column_names(spark.createDataFrame([(1, 2)], ["a b", "a_b"]))


def test_duplicate_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert rows(profile.dataset_summary(df)) == [(3, 2, 1, 33.3333)]


def test_distribution_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([(5.0, None)], "a double, b double")
    got = {r[0]: r[1:] for r in rows(profile.distribution_stats(df))}
    assert got["a"] == (1, 5.0, 0.0, 5.0, 5.0, 5.0, 5.0, 5.0)
    assert got["b"] == (0, None, None, None, None, None, None, None)


@pytest.mark.parametrize("few,parts", [(10_000, 4096), (500, 16), (1, 2)])
def test_quantiles_by_narrowing_are_exact(spark, few, parts):
    # Few values per bucket and few parts force several passes.
    df = spark.range(20_001).select(((F.col("id") * 7919) % 20_011).cast("double").alias("x"))
    df = df.unionByName(spark.range(10_000).select(F.lit(5000.0).alias("x")))
    want = df.agg(*[F.percentile("x", p) for p in (0.05, 0.25, 0.5, 0.95)]).first()
    probabilities = {"a": 0.05, "b": 0.25, "c": 0.5, "d": 0.95}
    got = quantiles.quantile_table(df, ["x"], probabilities, few=few, parts=parts).first()
    assert [got[p] for p in probabilities] == pytest.approx(list(want))


@pytest.mark.parametrize("few,parts", [(10_000, 4096), (3, 4)])
def test_quantiles_of_groups_of_odd_values(spark, few, parts):
    draw = random.Random(few)
    odd = [0.0, -0.0, 1e-310, -1e300, 1e300, float("nan"), None, 5.0, 5.0]
    values = [(draw.choice(["a", "b", None]), draw.choice([*odd, draw.gauss(0, 1), draw.gauss(1e6, 1)])) for _ in range(2000)]
    values += [("c", float("inf")), ("c", float("-inf")), ("c", 2.0), ("d", 1.0), ("e", None)]
    df = spark.createDataFrame(values, "g string, x double")
    probabilities = {"low": 0.05, "half": 0.5, "most": 0.93, "all": 1.0}
    got = {r.g: r for r in quantiles.quantile_table(df, ["x"], probabilities, by=["g"], few=few, parts=parts).collect()}
    assert set(got) == {"a", "b", "c", "d", None}
    for group in ("a", "b", "d", None):
        x = sorted(v for g, v in values if g == group and v is not None and v == v)
        assert got[group].n == len(x)
        for name, p in probabilities.items():
            at = (len(x) - 1) * p
            below, part = x[int(at)], at - int(at)
            assert got[group][name] == (below if part == 0 else below + (x[int(at) + 1] - below) * part)
    assert got["c"].half == 2.0 and got["c"]["all"] == float("inf")


def test_semantic_types_of_named_columns(spark):
    df = spark.createDataFrame([(1, 7, "https://a", "$5", "2020-01-02")], "row_id int, host_id int, link string, price string, day string")
    got = {r["column"]: (r["semantic_type"], r["is_mixed_type"]) for r in profile.metadata_report(df, "row_id").collect()}
    assert got == {"host_id": ("ID", False), "link": ("URL", False), "price": ("numeric", True), "day": ("date", False)}


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), (None,)], "g string")
    assert impute.impute_mode(df, "g").where("g = 'a'").count() == 3


def test_group_median_falls_back_to_the_global_one(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("x", None), ("y", None)], "g string, v double")
    got = rows(impute.impute_group_median(df, "v", "g", "out").select("g", "out"))
    assert sorted(got) == [("x", 1.0), ("x", 2.0), ("x", 3.0), ("y", 2.0)]


def test_iterative_imputation_recovers_a_linear_column(spark):
    df = spark.range(400).select(
        (F.col("id") % 37).cast("double").alias("accommodates"),
        (F.col("id") % 11).cast("double").alias("bathrooms"),
        F.when(F.col("id") % 9 != 0, 2.0 * (F.col("id") % 37) - (F.col("id") % 11) + 3).alias("beds"),
        "id",
    )
    out = impute.impute_iterative(df, targets=["beds"])
    error = out.agg(F.max(F.abs(F.col("beds") - (2.0 * (F.col("id") % 37) - (F.col("id") % 11) + 3)))).first()[0]
    assert error <= 0.11


def test_price_from_raw_then_median(spark):
    df = spark.createDataFrame([(1, 1, "$1,234.50"), (2, 2, "$0.00"), (3, 3, None)], "row_id long, id long, price string")
    raw = spark.createDataFrame([(1, 2, "$80")], "row_id long, id long, price string")
    got = dict(rows(normalize.normalize_price(df, raw).select("id", "price")))
    assert got == {1: 1234.5, 2: 80.0, 3: 1234.5}


def plan_text(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_price_text_is_parsed_once_for_each_side(spark):
    data = [(1, 10, "$1.50"), (2, 10, "$2.00"), (3, 11, None), (4, None, "$0"), (5, 12, "$1,000")]
    df = spark.createDataFrame(data, "row_id long, id long, price string").repartition(1)
    got = normalize.normalize_price(df, df, "row_id")
    assert got.columns == df.columns and plan_text(got).count("regexp_replace") <= 2
    assert {r.row_id: r.price for r in got.collect()} == {1: 1.5, 2: 2.0, 3: 2.0, 4: 2.0, 5: 1000.0}


def test_price_lookup_deals_unique_rows_once(spark):
    data = [(1, 10, "$1.50"), (2, 11, "$0"), (3, 11, "$7"), (4, None, "$0"), (5, None, "$3"), (6, 12, None), (7, 10, "$9")]
    df = spark.createDataFrame(data, "row_id long, id long, price string").repartition(3)
    raw = spark.createDataFrame([(1, 10, "$8"), (3, 11, "$7"), (4, 11, "$5"), (5, 12, "$0")], df.schema)
    unique = normalize.keep_first(df, "row_id", ["id"])
    got = normalize.normalize_price(unique, raw, one_per_id=True)
    plan = got._jdf.queryExecution().executedPlan().toString()  # not run yet
    assert got.columns == df.columns and plan.count("Exchange hashpartitioning") == 2
    assert sorted(rows(got)) == sorted(rows(normalize.normalize_price(unique, raw)))
    assert dict(rows(got.select("row_id", "price"))) == {1: 1.5, 2: 7.0, 4: 1.5, 6: 1.5}


def test_raw_median_counts_only_without_valid_prices(spark):
    df = spark.createDataFrame([(1, 1, None)], "row_id long, id long, price string")
    raw = spark.createDataFrame([(1, 2, "$4"), (2, 3, "$6")], df.schema)
    assert rows(normalize.normalize_price(df, raw).select("price")) == [(5.0,)]
    assert rows(normalize.normalize_price(df, df).select("price")) == [(100.0,)]


def test_fills_are_worked_out_for_columns_with_missing_cells_only(spark, monkeypatch):
    df = spark.createDataFrame([(1, 2.0, "a", None), (None, 3.0, "a", "x"), (3, 4.0, "b", "x")], "n int, m double, s string, t string")
    asked, row, mode = [], impute.quantile_row, impute.modes
    monkeypatch.setattr(impute, "quantile_row", lambda df, value, p: asked.extend(value) or row(df, value, p))
    monkeypatch.setattr(impute, "modes", lambda df, columns: asked.extend(columns) or mode(df, columns))
    kinds = [("n", "integer"), ("m", "float"), ("s", "string"), ("t", "string")]
    spec = spark.createDataFrame([(c, k, False) for c, k in kinds], "column string, expected_dtype string, is_nullable boolean")
    got = impute.enforce_non_null(df, spec)
    assert asked == ["n", "t"] and got.columns == df.columns
    assert sorted(rows(got)) == [(1.0, 2.0, "a", "x"), (2.0, 3.0, "a", "x"), (3.0, 4.0, "b", "x")]


def test_wide_steps_stay_compiled(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    was = spark.conf.get(limit)
    try:
        for given, kept in (("65535", "8000"), ("100", "100")):
            spark.conf.set(limit, given)
            compiled_methods(spark)
            assert spark.conf.get(limit) == kept
    finally:
        spark.conf.set(limit, was)


def test_columns_with_few_values(spark):
    df = spark.range(40).selectExpr("CAST(id % 9 AS STRING) AS a", "CAST(id % 10 AS STRING) AS b", "CAST(NULL AS STRING) AS c")
    assert profile.has_few_values(df, ["a", "b", "c"], 10) == {"a", "c"}
    assert schema.infer_schema(df.limit(0)).count() == 0


def test_scrape_date_is_parsed_once(spark):
    data = [("bad date", None, None), ("03-02-2020", None, "01-02-2019"), (None, "2019-06-05", "x"), (" 2020/02/03 ", "5 May 2019", None)]
    df = spark.createDataFrame(data, "last_scraped string, host_since string, first_review string").repartition(1)
    got = normalize.parse_dates(df)
    # Once for the scrape date, once for the first review, once for the start of hosting.
    assert got.columns == df.columns and plan_text(got).count("yyyy/MM/dd") <= 3
    expected = {("2026-06-16", "2025-06-16"), ("2020-02-03", "2019-02-01"), ("2026-06-16", "2019-06-05"), ("2020-02-03", "2019-05-05")}
    assert {tuple(r)[:2] for r in got.collect()} == expected


def test_bathroom_text(spark):
    data = [("1.5 baths", None), ("Half-bath", None), ("Shared half-bath", None), ("2 shared baths", None), (None, 2.0), (None, None)]
    df = spark.createDataFrame(data, "bathrooms_text string, bathrooms double")
    got = rows(normalize.parse_quantity_text(df).select("bathrooms", "bathroom_type"))
    assert got == [(1.5, "standard"), (0.5, "half"), (0.5, "shared_half"), (2.0, "shared"), (2.0, "standard"), (1.0, "standard")]


def test_title_case_and_dates(spark):
    df = spark.createDataFrame(
        [(" o'brien hill ", None, None, 2.0, 6.0)],
        "neighbourhood_cleansed string, last_scraped string, host_since string, "
        "hosts_time_as_host_years double, hosts_time_as_host_months double",
    )
    out = normalize.parse_dates(normalize.standardize_places(df))
    got = rows(out.select("neighbourhood", "neighbourhood_cleansed", "last_scraped", "host_since"))
    assert got == [("O'Brien Hill", "O'BRIEN HILL", "2026-06-16", "2023-12-16")]


def test_unit_price(spark):
    df = spark.createDataFrame([(100.0, 0.0), (100.0, None), (100.0, 3.0)], "price double, bedrooms double")
    assert rows(features.unit_price(df).select("price_per_bedroom")) == [(100.0,), (100.0,), (33.33,)]


def test_null_maximum_is_a_violation_but_no_score_loss(spark):
    df = spark.createDataFrame([(1, 5, None), (2, 2, 9)], "id long, minimum_nights long, maximum_nights long")
    broken = {r["rule_id"] for r in rules.rule_violations(df, "id").where("id = 1").collect()}
    assert "R007" in broken
    assert quality.quality_row(df).first()["min_max_nights_logic_pct"] == 100.0


def test_drift_of_shifted_values(spark):
    values = [(1, float(v)) for v in (1, 2, 3) * 2] + [(2, float(v)) for v in (2, 3, 4) * 2]
    df = spark.createDataFrame(values, "cohort int, v double")
    got = drift.drift_between(df, ["v"]).first()
    assert (got["ks_statistic"], got["wasserstein_distance"]) == (0.3333, 1.0)


def test_text_classes(spark):
    texts = [None, "N/A", "Apartment", "Cozy", "Great please safe neighborhood", " ".join(["word"] * 26)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = textquality.classify_text(df, "k", ["t"]).orderBy("k")
    assert [(r["category"], r["confidence"]) for r in got.collect()] == [
        (textquality.MISSING, 0.0),
        (textquality.PLACEHOLDER, 0.05),
        (textquality.PLACEHOLDER, 0.05),
        (textquality.PLACEHOLDER, 0.10),
        (textquality.NEAR_EMPTY, 0.35),
        (textquality.GENUINE, 0.63),
    ]


def test_list_forms(spark):
    cells = ['["a","b"]', "['a']", "a, b", "[]", None, '["a","b","a"]', '["<b>x</b>", "café ﬁ"]']
    df = spark.createDataFrame(list(enumerate(cells)), "k int, amenities string")
    got = [(r["format_type"], r["items"], r["issues"]) for r in listfields.parse_list_field(df).orderBy("k").collect()]
    assert got[0] == ("JSON", ["a", "b"], [])
    assert got[1] == ("PYTHON_LITERAL", ["a"], [])
    assert got[2] == ("PLAIN_TEXT_COMMA", ["a", "b"], [listfields.FALLBACK_ISSUE])
    assert got[3][0] == "EMPTY" and got[4][0] == "MISSING"
    assert got[5] == ("JSON", ["a", "b"], [listfields.DUPLICATE_ISSUE])
    assert got[6] == ("JSON", ["x", "café fi"], [listfields.ARTIFACT_ISSUE])


def test_row_health(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    issues = spark.createDataFrame(
        [(1, "rule", "CRITICAL", 15.0), (2, "rule", "CRITICAL", 15.0), (2, "rule", "HIGH", 10.0), (2, "error", "HIGH", 10.0)],
        "row_key long, source string, severity string, weight double",
    )
    got = rows(health.row_health(issues, base, "k").select("k", "row_health_score").orderBy("k"))
    assert got == [(1, 55.0), (2, 0.0), (3, 100.0)]


def test_confusion_figures(spark):
    cells = [(1, 1)] * 15 + [(0, 1)] * 9 + [(0, 0)] * 176
    got = evaluate.evaluation_metrics(spark.createDataFrame(cells, "truth int, predicted int")).first()
    assert (got["precision"], got["recall"], got["accuracy"]) == (0.625, 1.0, 0.955)


def test_spec_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 3), (2, None)], "id long, minimum_nights long")
    spec = schema.infer_schema(df)
    files.write_spec(spec, str(tmp_path / "spec"))
    back = files.read_spec(spark, str(tmp_path / "spec")).select(*spec.columns)
    assert sorted(map(str, rows(back))) == sorted(map(str, rows(spec)))
    assert files.read_spec(spark, str(tmp_path / "none")).count() == 0


def test_gzip_csv(spark, tmp_path):
    import gzip

    path = tmp_path / "raw.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write('Host Name,Price\n"a ""b""\nc","$1,000.00"\n')
    df = files.load_table(spark, str(path), str(tmp_path / "cache"))
    assert [tuple(r) for r in df.collect()] == [('a "b"\nc', "$1,000.00")] or df.columns == ["host_name", "price"]


def test_rules_on_a_stream(spark, tmp_path):
    from plumbline.operators.rules import rule_violations

    df = spark.createDataFrame([(1, 400), (2, 3)], "id long, minimum_nights long")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = rule_violations(stream, "id").writeStream.format("memory").queryName("violations")
    query = out.option("checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    query.stop()
    got = spark.sql("SELECT id FROM violations WHERE rule_id = 'R002'").collect()
    assert [r["id"] for r in got] == [1]


@pytest.mark.parametrize("n1,n2", [(4, 5), (6, 6), (5, 7), (3, 8), (6, 4)])
def test_exact_p_values_of_small_samples(n1, n2):
    orders = [set(c) for c in itertools.combinations(range(n1 + n2), n1)]

    def distance(first):  # of |n2 * i - n1 * j| along the order
        i = most = 0
        for k in range(n1 + n2):
            i += k in first
            most = max(most, abs(n2 * i - n1 * (k + 1 - i)))
        return most

    distances = [distance(o) for o in orders]
    for d in sorted(set(distances)):
        assert drift.lattice_p(d / (n1 * n2), n1, n2) == pytest.approx(sum(x >= d for x in distances) / len(distances))


def test_exact_p_value_of_large_samples_nears_the_series(spark):
    for n1, n2, d in ((7_400, 7_600, 0.0125), (10_000, 9_000, 0.02), (5_000, 10_000, 0.3)):
        scale = d * math.sqrt(n1 * n2 / (n1 + n2))
        series = sum((-1) ** (j - 1) * 2 * math.exp(-2 * j * j * scale * scale) for j in range(1, 101))
        assert drift.lattice_p(d, n1, n2) == pytest.approx(series, abs=0.02)
    p = drift.exact_p(F.lit(0.01), F.col("n"), F.col("n"))
    got = spark.createDataFrame([(10_000,), (10_001,)], "n bigint").select(p.alias("p")).collect()
    assert got[0].p is not None and got[1].p is None


def test_chained_regressions_end_when_fills_settle(spark):
    draw = random.Random(4)
    data = []
    for i in range(300):
        x = draw.gauss(0, 1)
        y, z = 2 * x + draw.gauss(0, 0.1), x - draw.gauss(0, 0.1)
        data.append((i, x if i % 3 else None, y if i % 4 else None, z if i % 5 else None))
    df = spark.createDataFrame(data, "row_id int, beds double, bedrooms double, price double")
    patterns, grams = [], []
    for mask in {tuple(v is None for v in r[1:]) for r in data}:
        own = [[1.0] + [v or 0.0 for v in r[1:]] for r in data if tuple(v is None for v in r[1:]) == mask]
        patterns.append(mask)
        grams.append(sum((np.outer(o, o) for o in own), np.zeros((4, 4))))
    patterns, grams = np.array(patterns), np.array(grams)
    whole, rounds = impute.chain_regressions(patterns, grams, 20)
    early, fewer = impute.chain_regressions(patterns, grams, 20, 1e-3)
    assert rounds == 20 and fewer < 20 and np.abs(whole - early).max() < 0.02
    assert impute.chain_regressions(patterns, grams, fewer)[0] == pytest.approx(early)
    filled = impute.impute_iterative(df, ["beds", "bedrooms"], ["price"]).orderBy("row_id").collect()
    assert all(r.beds is not None and r.bedrooms is not None for r in filled)
    assert np.mean([abs(r.beds - round(d[2] / 2, 1)) for r, d in zip(filled, data, strict=True) if d[1] is None and d[2] is not None]) < 0.2
