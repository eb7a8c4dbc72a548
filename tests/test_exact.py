"""Operators without SQL equivalents against brute force on small fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions import neighbours
from plumbline.operators import anomaly, dedup


def all_neighbours(pdf, names, k, targets):
    pdf = pdf.sort_values("key").reset_index(drop=True)
    x, keys = pdf[names].to_numpy(), pdf["key"].to_numpy()
    d = neighbours.distances(np.repeat(x, len(x), axis=0), np.tile(x, (len(x), 1))).reshape(len(x), len(x))
    np.fill_diagonal(d, np.inf)
    found = set()
    for t in targets or [""]:
        have = ~np.isnan(pdf[t].to_numpy()) if t else np.ones(len(pdf), dtype=bool)
        for i in np.flatnonzero(~have) if t else range(len(pdf)):
            reach = np.where(have, d[i], np.inf)
            for j in np.argsort(reach, kind="stable")[:k]:
                found.add((int(keys[i]), t, int(keys[j])))
    return found


@pytest.mark.parametrize("targets", [None, ["a", "b"]])
def test_nearest_equals_brute_force(spark, monkeypatch, targets):
    monkeypatch.setattr(neighbours, "TILE_ROWS", 150)
    monkeypatch.setattr(neighbours, "VISITOR_ROWS", 50)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 40)
    draw = np.random.default_rng(3)
    pdf = pd.DataFrame(draw.integers(0, 25, (900, 3)).astype(float), columns=["a", "b", "c"])
    pdf["a"] *= 40
    if targets:
        for c in ("a", "b"):
            pdf.loc[draw.random(len(pdf)) < 0.2, c] = np.nan
    pdf.insert(0, "key", draw.permutation(len(pdf)))
    df = spark.createDataFrame(pdf).select("key", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abc"])
    got = neighbours.nearest(df, "key", ["a", "b", "c"], 4, targets, box_rows=200)
    assert {(r["key"], r["target"], r["neighbour"]) for r in got.collect()} == all_neighbours(
        pdf, ["a", "b", "c"], 4, targets
    )


def test_rows_without_the_widest_column_search_a_view_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE_ROWS", 60)
    draw = np.random.default_rng(8)
    x = draw.random((4_000, 3)) * np.array([10_000.0, 300.0, 200.0])
    x[draw.random(len(x)) < 0.2, 0] = np.nan
    views = neighbours.seeker_views(x, 100)
    lacking = x[np.isnan(x[:, 0])]
    radius = np.full(len(lacking), 10.0)
    visits = [len(tree.touched(lacking, radius)[0]) / len(lacking) for _, tree in views]
    assert [hidden for hidden, _ in views] == [[], [0]] and visits[0] > 50 and visits[1] < 5
    assert set(neighbours.view_of(lacking, [[], [0]])) == {1} and not neighbours.view_of(x[~np.isnan(x[:, 0])], [[], [0]]).any()

    pdf = pd.DataFrame(np.floor(x[:1_200] / 5), columns=["a", "b", "c"])
    pdf.loc[draw.random(len(pdf)) < 0.2, "b"] = np.nan
    pdf.insert(0, "key", draw.permutation(len(pdf)))
    assert len(neighbours.seeker_views(pdf[["a", "b", "c"]].to_numpy(), 1_200 // 25)) > 2
    df = spark.createDataFrame(pdf).select("key", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abc"])
    got = neighbours.nearest(df, "key", ["a", "b", "c"], 4, ["a", "b"], box_rows=25)
    assert {(r["key"], r["target"], r["neighbour"]) for r in got.collect()} == all_neighbours(pdf, ["a", "b", "c"], 4, ["a", "b"])


def test_a_repeated_key_still_gets_k_neighbours(spark):
    data = [(i, float(i % 10), float(i // 10)) for i in range(100)]
    df = spark.createDataFrame(data + data[:20], "key long, x double, y double")
    found = neighbours.nearest(df, "key", ["x", "y"], 3).groupBy("key").count().collect()
    assert {(r["key"], r["count"]) for r in found} == {(i, 3) for i in range(100)}


def test_a_visitor_with_a_loose_radius_measures_few_pairs(monkeypatch):
    sizes, inner = [], neighbours._near
    monkeypatch.setattr(neighbours, "_near", lambda q, i, *rest: sizes.append(len(i)) or inner(q, i, *rest))
    draw = np.random.default_rng(9)
    x, q = draw.random((5_000, 3)), draw.random((200, 3))
    want, loose = np.ones((len(q), 1), dtype=bool), np.full(len(q), 0.5)
    offer = np.ones((len(x), 1), dtype=bool)
    names, keys = np.arange(len(q)) + 10_000, np.arange(len(x))
    found = {}
    for crowd in (None, 1_024):
        del sizes[:]
        hits = [(who, near, rank) for who, _, near, _, rank in neighbours.search(q, names, want, loose, x, keys, offer, 3, crowd=crowd)]
        found[crowd] = sorted((w, r, p) for who, near, rank in hits for w, p, r in zip(who, near, rank, strict=True)), sum(sizes)
    assert found[None][0] == found[1_024][0] and found[1_024][1] < found[None][1] / 5


def test_repeated_rows_share_their_outlier_factor(spark):
    # One vector holds half of the rows; its later copies only look their factor up.
    same = [(i, 0.0, 0.0) for i in range(60)]
    other = [(100 + i, float(i % 8), float(i // 8)) for i in range(60)]
    scaled = spark.createDataFrame(same + other, "key long, x double, y double")
    got = {r["key"]: r["lof"] for r in anomaly.lof_scores(scaled, ["x", "y"], k=5).collect()}
    assert len(got) == 120
    assert all(got[i] == pytest.approx(1.0) for i in range(60))


def test_removed_rows_remove_nothing(spark):
    # a ~ b and b ~ c, but not a ~ c: a and c stay.
    names = ["aaaa bbbb", "aaaa bbbb cccc", "bbbb cccc dddd"]
    data = [(i + 1, i + 1, 1, 42.0, -73.0, name) for i, name in enumerate(names)]
    df = spark.createDataFrame(data, "row_id long, id long, host_id long, latitude double, longitude double, name string")
    kept, _ = dedup.deduplicate(df, "row_id", threshold=0.65)
    assert sorted(r["row_id"] for r in kept.collect()) == [1, 3]


def counted_pairs(monkeypatch, x, want, offer, k):
    """Pairs measured by one search of a tile, after a check against brute force."""
    measured, inner = [], neighbours._near
    monkeypatch.setattr(neighbours, "_near", lambda q, i, *rest: measured.append(len(i)) or inner(q, i, *rest))
    keys, asking = np.arange(len(x)), np.flatnonzero(want.any(axis=1))
    endless = np.full(len(asking), np.inf)
    got = {}
    for who, t, point, _, rank in neighbours.search(x[asking], keys[asking], want[asking], endless, x, keys, offer, k, tighten=True):
        got.update({(asking[w], t, r): p for w, p, r in zip(who, point, rank, strict=True)})
    for q in asking[:20]:
        for t in np.flatnonzero(want[q]):
            d = neighbours.distances(np.repeat(x[q : q + 1], len(x), axis=0), x)
            d[(keys == q) | ~offer[:, t]] = np.inf
            assert [got[q, t, r] for r in range(k)] == list(np.lexsort((keys, d))[:k])
    return sum(measured) / len(asking)


def test_a_search_measures_a_small_part_of_the_tile(monkeypatch):
    x = np.random.default_rng(5).random((10_000, 4))
    everything = np.ones((len(x), 1), dtype=bool)
    assert counted_pairs(monkeypatch, x, everything, everything, 20) < len(x) / 5


def test_a_search_without_the_widest_column_measures_a_small_part(monkeypatch):
    draw = np.random.default_rng(6)
    x = draw.random((20_000, 3)) * np.array([1_000.0, 300.0, 200.0])
    x[draw.random(len(x)) < 0.05, 0] = np.nan
    want = np.isnan(x[:, :1])
    assert counted_pairs(monkeypatch, x, want, ~want, 5) < len(x) / 3


def test_a_search_holds_a_bounded_number_of_pairs(monkeypatch):
    sizes, inner = [], neighbours._near
    monkeypatch.setattr(neighbours, "_near", lambda q, i, *rest: sizes.append(len(i)) or inner(q, i, *rest))
    x, all_ = np.random.default_rng(7).random((2_000, 3)), np.ones((2_000, 1), dtype=bool)
    keys, endless = np.arange(len(x)), np.full(len(x), np.inf)
    found = sum(len(who) for who, *_ in neighbours.search(x, keys, all_, endless, x, keys, all_, 3))
    assert found == 3 * len(x) and sum(sizes) == len(x) ** 2
    assert max(sizes) <= neighbours.PAIRS + len(x)


def test_hits_are_dealt_by_key_before_they_are_ranked(spark):
    points = spark.range(300).selectExpr("id AS key", "CAST(id % 17 AS double) AS a", "CAST(id % 23 AS double) AS b")
    plan = neighbours.nearest(points, "key", ["a", "b"], 3)._jdf.queryExecution().executedPlan().toString()
    ranked, dealt = plan.index("Window"), plan.index("Exchange hashpartitioning(key")
    assert ranked < dealt and "Window" not in plan[dealt:], plan


def test_points_are_put_into_blocks_without_a_column_that_the_queries_lack(monkeypatch):
    draw = np.random.default_rng(10)
    x = draw.random((20_000, 3)) * np.array([1_000.0, 300.0, 200.0])
    x[draw.random(len(x)) < 0.05, 0] = np.nan
    want = np.isnan(x[:, :1])
    assert counted_pairs(monkeypatch, x, want, ~want, 5) < len(x) / 20


def test_products_of_blocks_find_the_same_rows_among_odd_numbers():
    draw = np.random.default_rng(11)
    for odd in (1e9, 1e200, np.inf):
        x = draw.integers(0, 9, (600, 4)).astype(float)
        x[draw.random(x.shape) < 0.1] = np.nan
        x[:5, 1], x[5:9, 2] = odd, -odd
        all_, keys = np.ones((600, 1), dtype=bool), draw.permutation(600)
        got = {}
        for who, _, point, _, rank in neighbours.search(x, keys, all_, np.full(600, np.inf), x, keys, all_, 4, tighten=True):
            got.update({(w, r): q for w, q, r in zip(who, point, rank, strict=True)})
        for i in range(600):
            d = neighbours.distances(np.repeat(x[i : i + 1], 600, axis=0), x)
            d[i] = np.inf
            best = [j for j in np.lexsort((keys, d))[:4] if d[j] < np.inf]
            assert [got[i, r] for r in range(len(best))] == best


def test_outlier_factors_of_tiles_equal_those_of_joins(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE_ROWS", 150)
    monkeypatch.setattr(neighbours, "VISITOR_ROWS", 50)
    draw = np.random.default_rng(12)
    pdf = pd.DataFrame(draw.integers(0, 25, (900, 3)).astype(float), columns=["x", "y", "z"])
    pdf.insert(0, "key", draw.permutation(len(pdf)))
    scaled = spark.createDataFrame(pdf)
    near, joined = [], anomaly._joined_factors
    monkeypatch.setattr(anomaly, "_joined_factors", lambda *a, **e: near.append(a) or joined(*a, **e))
    got = {r["key"]: r["lof"] for r in anomaly.lof_scores(scaled, ["x", "y", "z"], k=6, box_rows=200).collect()}
    assert not near  # no row of a neighbour and its distance is shuffled
    want = {r["key"]: r["lof"] for r in joined(scaled, ["x", "y", "z"], 6, box_rows=200).collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)
    twice = anomaly.lof_scores(scaled.unionByName(scaled.limit(50)), ["x", "y", "z"], k=6, box_rows=200)
    assert twice.select("key").distinct().count() == 900 and len(near) == 1


def test_outlier_factors_of_few_rows(spark):
    few = [(i, float(i), float(i * i)) for i in range(4)]
    for n in (0, 1, 2, 4):
        scaled = spark.createDataFrame(few[:n], "key long, x double, y double")
        got = {r["key"]: r["lof"] for r in anomaly.lof_scores(scaled, ["x", "y"], k=5).collect()}
        assert set(got) == (set(range(n)) if n > 1 else set())
