import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from plumbline.llm import divergence

WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def by_hand(docs, least, best):
    rows = [(lang or "", source or "", WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))) for t, lang, source in docs]
    df = defaultdict(Counter)
    for lang, _, w in rows:
        df[lang].update(set(w))
    out = []
    for lang in {r[0] for r in rows}:
        kept = [t for t, n in df[lang].items() if n >= least]
        counts = defaultdict(Counter)
        for own, source, w in rows:
            if own == lang:
                counts[source].update(t for t in w if t in set(kept))
                counts[source][None] = 0

        def share(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (n + 2 * len(kept)) for t in kept}

        whole = share(sum((Counter(c) for c in counts.values()), Counter()))
        p = {s: share(c) for s, c in counts.items()}
        for source in counts:
            pairs = [(sum((p[source][t] - p[o][t]) ** 2 // (p[source][t] + p[o][t]) for t in kept), o) for o in counts if o != source]
            terms = [
                ((p[source][t] - whole[t]) ** 2 // (p[source][t] + whole[t]), t)
                for t in kept
                if counts[source][t] and p[source][t] > whole[t]
            ]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, v, r) for r, (v, item) in enumerate(found, 1) if part == "pair" or r <= best]
    return sorted(out)


def got(spark, docs, least=10, best=10, **more):
    df = spark.createDataFrame(docs, "text string, lang string, source string").repartition(5)
    found = divergence.audit(df, least, best, **more)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"] + ["Ünï", "ñ", "B7c", "O'x"]
    docs = []
    for i in range(500):
        source = draw.choice(["s1", "s1", "s1", "s2", "S3", None, ""])
        lean = {"s1": 0.1, "s2": 0.03}.get(source, 0.06)
        own = [vocabulary[min(len(vocabulary) - 1, int(draw.expovariate(lean)))] for _ in range(draw.choice([0, 3, 30]))]
        docs.append((" ".join(own), draw.choice(["en", "en", "de", None]), source))
    return docs + [("ak al am", "xx", "s1"), (None, "xx", "s2"), ("", "xx", None), (None, "en", "silent"), ("ak " * 100_000, "de", "s2")]


@pytest.mark.parametrize("seed,more", [(1, {}), (2, {"cells": 5}), (3, {"cells": 400, "round_bytes": 300})])
def test_audit_equals_brute_force(spark, monkeypatch, seed, more):
    if more:
        monkeypatch.setattr(divergence, "LEAST_KEYS", 1)
        monkeypatch.setattr(divergence, "ENTRIES", 20)
        monkeypatch.setattr(divergence, "SLOTS", 30)
    docs = corpus(seed)
    assert got(spark, docs, **more) == by_hand(docs, 10, 10)


def test_edges(spark):
    assert got(spark, []) == []
    assert got(spark, [("a b", "en", "x")] * 9) == []
    assert got(spark, [("a b", "en", "x")] * 10) == []
    docs = [("a a b", "en", "x")] * 10 + [("b", "en", "y")] * 10
    assert got(spark, docs) == by_hand(docs, 10, 10)
    clash = spark.createDataFrame([(t, la, s, "q", 1) for t, la, s in docs], "text string, lang string, source string, LANG string, value int")
    assert sorted(tuple(r) for r in divergence.audit(clash).collect()) == by_hand(docs, 10, 10)


def test_perfect_hash_gives_every_key_its_own_slot():
    for n in (0, 1, 2, 1000, 30_000):
        keys = [f"k{i}".encode() for i in range(n)]
        table = divergence.PerfectHash(*divergence.PerfectHash.parts(keys, divergence.hashes(keys)))
        slots = table.slots(keys, divergence.hashes(keys))
        assert sorted(slots) == list(range(n)) == list(range(len(table)))
        strangers = [f"x{i}".encode() for i in range(5000)]
        assert (table.slots(strangers, divergence.hashes(strangers)) == -1).all()


def test_keys_of_equal_hashes_are_told_apart():
    keys = [b"a", b"b", b"c", b"d"]
    same = np.array([5, 5, 9, 5], dtype=np.uint64)
    table = divergence.PerfectHash(*divergence.PerfectHash.parts(keys, same))
    assert sorted(table.slots(keys, same)) == [0, 1, 2, 3]
    assert table.slots([b"z", b"y"], np.array([5, 9], dtype=np.uint64)).tolist() == [-1, -1]


def test_counts_beyond_64_bits():
    counts = np.array([[10**13, 0]])
    p = divergence.shares(counts, np.array([10**13]), 2)
    assert p.tolist() == [[1 + 10**9 * (10**13 + 2) // (10**13 + 4), 1 + 2 * 10**9 // (10**13 + 4)]]
