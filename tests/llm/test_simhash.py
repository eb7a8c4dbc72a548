import random

import numpy as np
import pytest
import xxhash

from plumbline.llm import components, simhash


def by_hand(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(ids, prints, links=2):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    distinct = sorted(set(prints))
    for a in distinct:
        for b in distinct:
            if a < b and (a ^ b).bit_count() <= links:
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for i, p in zip(ids, prints, strict=True):
        least[find(p)] = min(least.get(find(p), i), i)
    return [least[find(p)] for p in prints]


TEXTS = [None, "", " \t\n", "One", "one two", "ONE two three", "a b c d " * 3000, "É é A", "x\xa0y z\x1cw v", "a\x0bb\x0cc\rd"]


def test_fingerprints_by_hand():
    for text in TEXTS:
        assert simhash.fingerprint(text) == by_hand(text)


@pytest.mark.parametrize("cell_rows", [2000, 5])
def test_components_equal_brute_force(spark, cell_rows):
    draw = random.Random(2)
    texts = list(TEXTS)
    for _ in range(25):
        words = [draw.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(draw.randrange(40)) for _ in range(300)]
        for _ in range(draw.randrange(1, 9)):
            changed = list(words)
            for _ in range(draw.randrange(3)):
                changed[draw.randrange(300)] = "other"
            texts.append(" ".join(changed))
    texts += ["same text in many rows"] * 40
    ids = list(range(100, 100 + len(texts)))
    draw.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in zip(ids, texts, strict=True)], "doc_id bigint, text string, fp string, Text int")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.digest(simhash.near_duplicates(docs, cell_rows=cell_rows)).collect()}
    prints = [by_hand(t) for t in texts]
    want = closure(ids, prints)
    assert got == {i: (f"{p:016x}", c) for i, p, c in zip(ids, prints, want, strict=True)}
    assert len(set(want)) < len(set(prints))


def test_no_link_is_lost_by_cells():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2) + draw.integers(0, 2, 4000, dtype=np.uint64)
    flips = np.uint64(1) << draw.integers(0, 64, (2, 4000), dtype=np.uint64)
    near = base ^ flips[0] ^ flips[1]
    cell_a, index_a = simhash.deal(base)
    cell_b, index_b = simhash.deal(near)
    held = [set() for _ in base]
    for c, i in zip(cell_a, index_a, strict=True):
        held[i].add(c)
    met = set()
    for c, i in zip(cell_b, index_b, strict=True):
        if c in held[i]:
            met.add(i)
    assert len(met) == len(base)
    i, j = simhash.linked(base, near)
    assert set(range(4000)) <= {a for a, b in zip(i, j, strict=True) if a == b}


def test_empty_table_and_repeated_ids(spark):
    schema = "doc_id bigint, text string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, None)], schema)
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(docs).collect())
    assert got == [(0, 0), (0, 3), (3, 3), (3, 3)]


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
