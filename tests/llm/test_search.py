import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import search

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def by_hand(docs, items, k):
    held = [(i, words(t)) for i, t in docs]
    n, total = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    terms = {}
    for item, text in items:
        terms.setdefault(item, set()).update(words(text))
    out = []
    for item, own in terms.items():
        found = []
        for doc, w in held:
            if w:
                tf, m = Counter(w), 50 + 50 * len(w) * n // total
                score = sum(
                    math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
                    for t in own
                    if t in tf
                )
                if score > 0:
                    found.append((-score, doc is None, doc or 0, doc))
        found.sort()
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def got(spark, docs, items, k, **more):
    left = spark.createDataFrame(docs, "doc_id bigint, text string")
    right = spark.createDataFrame(items, "item_id bigint, text string")
    found = search.search(left.repartition(5), right, k, **more)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("seed,block_terms", [(1, 200_000), (2, 60)])
def test_ranking_equals_brute_force(spark, monkeypatch, seed, block_terms):
    monkeypatch.setattr(search, "BLOCK_CELLS", 2000)
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(90)] + ["Ünï", "it's", "a_b", "x-Y", "42"]
    common = [min(len(vocabulary) - 1, int(draw.expovariate(0.08))) for _ in range(20_000)]

    def text(n):
        return " ".join(vocabulary[draw.choice(common)] for _ in range(n))

    docs = [(i, text(draw.choice([0, 1, 5, 60, 400]))) for i in range(220)]
    docs += [(500 + i, docs[3][1] + " w1") for i in range(60)] + [(None, docs[3][1] + " w1")] * 2 + [(7, docs[7][1]), (900, None)]
    items = [(i, text(draw.choice([1, 4, 70]))) for i in range(9)] + [(20, ""), (21, None), (22, "nowhere"), (3, "W1 w2 w2"), (None, "w5 ünï")]
    assert got(spark, docs, items, 50, block_terms=block_terms) == by_hand(docs, items, 50)


def test_edges(spark):
    docs = [(1, "Apple pie"), (2, None), (3, "..."), (4, "apple " * 200_000 + "pear")]
    assert got(spark, docs, [], 5) == []
    assert got(spark, [], [(1, "apple")], 5) == []
    assert got(spark, docs[1:3], [(1, "apple")], 5) == []
    assert got(spark, docs, [(1, "APPLE apple"), (1, "apple")], 5) == by_hand(docs, [(1, "apple")], 5)
    clash = spark.createDataFrame([(1, "apple", "x", 3)], "doc_id bigint, text string, TEXT string, score int")
    items = spark.createDataFrame([("i", "apple", 2)], "item_id string, text string, rank int")
    assert [tuple(r)[:3] for r in search.search(clash, items).collect()] == [("i", 1, 1)]


def test_groups_of_equal_masks():
    draw = np.random.default_rng(5)
    for terms in (1, 9, 64, 65, 200):
        present = draw.random((terms, 300)) < 0.02
        first, group = search.masks(present)
        assert len(first) == len({c.tobytes() for c in present.T})
        assert all((present[:, first[g]] == present[:, i]).all() for i, g in enumerate(group))


def test_evaluation_stops_before_groups_that_cannot_come_in():
    draw = np.random.default_rng(6)
    present = draw.random((12, 5000)) < 0.2
    factors = np.where(present, draw.integers(900, 1000, present.shape), 0)
    weights = draw.integers(1, 6000, 12)
    best = search.Best(10)
    scored = search.evaluate(best, weights, present, factors, np.arange(5000), np.zeros(5000, dtype=bool))
    scores = weights @ factors
    want = np.lexsort((np.arange(5000), -scores))[:10]
    assert best.doc.tolist() == want.tolist() and best.score.tolist() == scores[want].tolist()
    assert scored < 1000
