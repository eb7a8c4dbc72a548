"""The relu network: gradients, start, progress and repeatability."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import anomaly, network
from plumbline.session import settle

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(3)
    t = draw.uniform(-2, 2, 600)
    x = np.column_stack([t, np.abs(t), t**2, np.where(t > 0, t, -0.3)]) + draw.normal(0, 0.05, (600, 4))
    x -= x.mean(axis=0)
    data = [(i, *map(float, r)) for i, r in enumerate(x)]
    return settle(spark.createDataFrame(data, "key bigint, a double, b double, c double, d double").repartition(5))


def test_gradient_equals_differences():
    draw = np.random.default_rng(1)
    sizes = network.shapes(4)
    flat, x = draw.normal(0, 0.7, sum(a * b + b for a, b in sizes)), draw.normal(0, 1, (20, 4))
    _, gradient = network.loss_and_gradient(x, network.layers_of(flat, sizes))
    for k in range(len(flat)):
        step = np.zeros(len(flat))
        step[k] = 1e-6
        up, down = (network.loss_and_gradient(x, network.layers_of(flat + s * step, sizes))[0] for s in (1, -1))
        assert gradient[k] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-4)


def test_start_is_the_projection(rows):
    axes = anomaly.principal_axes(rows, COLUMNS)
    x = np.array(rows.select(*COLUMNS).collect())
    layers = network.from_axes(axes, np.full(2, 50.0))
    loss, _ = network.loss_and_gradient(x, layers)
    assert loss == pytest.approx(((x - x @ axes @ axes.T) ** 2).sum())


def test_errors_are_below_the_projection_and_repeat(rows):
    first = {r.key: r.mse for r in anomaly.network_errors(rows, COLUMNS).collect()}
    again = {r.key: r.mse for r in anomaly.network_errors(rows, COLUMNS).collect()}
    linear = {r.key: r.mse for r in anomaly.reconstruction_errors(rows, COLUMNS).collect()}
    assert set(first) == set(linear) and first == pytest.approx(again, rel=1e-6)
    assert sum(first.values()) < 0.9 * sum(linear.values())


def test_errors_of_expressions_equal_numpy(rows):
    layers = network.train(rows, COLUMNS, anomaly.principal_axes(rows, COLUMNS), evaluations=5)
    got = {r.key: r.mse for r in network.squared_error(rows, COLUMNS, layers).collect()}
    for r in rows.orderBy("key").limit(30).collect():
        x = np.array([[r.a, r.b, r.c, r.d]])
        assert got[r.key] == pytest.approx(network.loss_and_gradient(x, layers)[0] / 4)


def test_equal_rows_and_no_rows(spark, rows):
    same = settle(rows.select("key", *[F.lit(0.0).alias(c) for c in COLUMNS]))
    assert {round(r.mse, 12) for r in anomaly.network_errors(same, COLUMNS).collect()} == {0.0}
    assert anomaly.network_errors(rows.limit(0), COLUMNS).count() == 0


def test_passes_read_blocks_of_rows(spark):
    rows = spark.range(120_000).selectExpr("id AS key", "id / 2.0 AS a", "-id AS b").coalesce(1)
    blocks = network.packed(rows, ["a", "b"])
    assert blocks.count() == 3
    held = np.concatenate([np.frombuffer(r["block"]).reshape(-1, 2) for r in blocks.collect()])
    assert (held == np.column_stack([np.arange(120_000) / 2, -np.arange(120_000)])).all()
