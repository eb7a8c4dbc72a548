import random

import numpy as np
import pytest

from plumbline.llm import vectors


def by_hand(rows, threshold=0.98):
    def sound(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links = [set() for _ in rows]
    for a in range(n):
        for b in range(a + 1, n):
            (_, u, k), (_, v, m) = rows[a], rows[b]
            if sound(u, k) and sound(v, m) and k == m and len(u) == len(v):
                x, y = np.array(u, dtype=np.float32).astype(float), np.array(v, dtype=np.float32).astype(float)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for a in range(n):
        seen, stack = {a}, [a]
        while stack:
            for b in links[stack.pop()] - seen:
                seen.add(b)
                stack.append(b)
        ids = [rows[i][0] for i in seen if rows[i][0] is not None]
        out.append((rows[a][0], len(links[a]), min(ids, default=None), rows[a][0] is not None and rows[a][0] == min(ids)))
    return out


def cases(seed=4):
    draw = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            base = draw.normal(size=16)
            for _ in range(int(draw.integers(1, 9))):
                rows.append((base * draw.uniform(0.1, 9) + draw.normal(size=16) * draw.choice([0.02, 0.12, 0.3]), label))
    rows += [(rows[0][0], 0)] * 30 + [(rows[0][0], 1)] + [(np.ones(8), 0), (np.ones(8) * 1.001, 0), (np.ones(16), 0)]
    rows = [([float(x) for x in v], k) for v, k in rows]
    rows += [(None, 0), ([0.0] * 16, 0), ([0.0] * 16, 0), ([float("nan")] * 16, 0), ([float("inf")] + [1.0] * 15, 0), ([None] + [1.0] * 15, 0), ([], 0), ([-0.0] * 15 + [1.0], 0), ([0.0] * 15 + [1.0], 0)]
    random.Random(seed).shuffle(rows)
    return [(None if i == 5 else i + 50, v, k) for i, (v, k) in enumerate(rows)]


@pytest.mark.parametrize("tile_rows", [2048, 7])
def test_equals_brute_force(spark, tile_rows):
    rows = cases()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id int, embedding array<float>, label int, n_links int, LABEL string")
    got = [tuple(r) for r in vectors.near_duplicates(table, tile_rows=tile_rows).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(by_hand(rows), key=key)


def test_bound_holds():
    draw = np.random.default_rng(1)
    for scale in (1, 1e-20, 1e20):
        a = (draw.normal(size=(200, 40)) * scale * draw.exponential(size=40)).astype(np.float32)
        q = vectors.Quantised(a)
        exact = vectors.cosine(np.repeat(a, 200, 0), np.tile(a, (200, 1))).reshape(200, 200)
        product = (q.numbers.astype(float) @ q.numbers.T.astype(float)) * np.outer(q.step, q.step)
        bound = np.outer(q.lost, q.length + q.lost) + np.outer(q.length, q.lost)
        assert (np.abs(exact - product) <= bound + 1e-12).all()
        i, j = vectors.links(q, q, 0.9)
        assert set(zip(i, j, strict=True)) == set(zip(*np.nonzero(exact >= 0.9), strict=True))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert vectors.near_duplicates(empty).count() == 0
