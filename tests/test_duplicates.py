"""Duplicate resolution in blocks against the row-by-row procedure."""

import math
import random
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pytest

from plumbline.operators import dedup

SCHEMA = "row_id bigint, id bigint, host_id bigint, latitude double, longitude double, name string"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def term_weights(names):
    terms = {n: Counter(n.split()) for n in set(names)}
    df = Counter(t for c in terms.values() for t in c)
    out = {}
    for name, counts in terms.items():
        w = {t: c * (math.log((1 + len(terms)) / (1 + df[t])) + 1) for t, c in counts.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out[name] = {t: x / norm for t, x in w.items()}
    return out


def by_hand(rows, threshold, method):
    """(removed, kept, kind, similarity) of the row-by-row procedure."""
    names = {r[0]: r[5].lower().strip() for r in rows}
    weights = term_weights(names.values())
    kept, out = {}, set()
    for row in sorted(rows):
        block = kept.setdefault(row[2:5], [])
        b = names[row[0]]
        for other in block:
            a, kind, score = names[other[0]], None, None
            if a == b or (row[1] is not None and row[1] == other[1]):
                kind = "exact"
            elif method == "ratio":
                score = SequenceMatcher(None, a, b).ratio()
            elif method == "levenshtein":
                score = 1 - edit_distance(a, b) / max(len(a), len(b), 1)
            elif method == "tfidf":
                score = sum(w * weights[b].get(t, 0.0) for t, w in sorted(weights[a].items()))
            if kind or (score is not None and score >= threshold):
                out.add((row[0], other[0], kind or "fuzzy", None if kind else round(score, 9)))
                break
        else:
            block.append(row)
    return out


def got(spark, rows, threshold, method):
    log = dedup.duplicate_log(spark.createDataFrame(rows, SCHEMA), "row_id", threshold, method).collect()
    return {
        (r.removed_key, r.retained_key, r.kind.replace("exact_full_row", "exact"), r.similarity and round(r.similarity, 9))
        for r in log
    }


def block(seed, n, words="oak elm park view loft suite cozy big old red", host=1):
    draw = random.Random(seed)
    pick = words.split()
    return [
        (host * 10_000 + i, draw.choice([None, draw.randrange(2 * n)]), host, 42.6, -73.7, " ".join(draw.choice(pick) for _ in range(3)) + f" {draw.randrange(99)}")
        for i in draw.sample(range(3 * n), n)
    ]


@pytest.mark.parametrize(
    "method,threshold,front,tile",
    [
        ("ratio", 0.5, 256, 1024),
        ("levenshtein", 0.5, 256, 1024),
        ("exact", 0.5, 256, 1024),
        ("ratio", 0.85, 12, 25),
        ("levenshtein", 0.7, 12, 25),
        ("tfidf", 0.6, 12, 25),
    ],
)
def test_log_equals_the_row_by_row_procedure(spark, monkeypatch, method, threshold, front, tile):
    monkeypatch.setattr(dedup, "ROUND_ROWS", front)
    monkeypatch.setattr(dedup, "TILE_ROWS", tile)
    rows = block(5, 110) + block(6, 30, host=2) + block(7, 3, host=3) + block(8, 1, host=4)
    assert got(spark, rows, threshold, method) == by_hand(rows, threshold, method)


def test_chains_follow_their_length(spark, monkeypatch):
    monkeypatch.setattr(dedup, "ROUND_ROWS", 2)
    monkeypatch.setattr(dedup, "TILE_ROWS", 4)
    # Each name is near the next one only: of a chain every other row stays.
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, 100 + i, 1, 42.0, -73.0, alphabet[i : i + 6]) for i in range(8)]
    assert got(spark, rows, 0.8, "ratio") == by_hand(rows, 0.8, "ratio") != set()


def test_published_figures_of_the_ratio(spark):
    rows = [(1, 1, 1, 42.0, -73.0, "Rowhouse 23 Studio"), (2, 2, 1, 42.0, -73.0, "rowhouse 18 - 1bdr park south ")]
    assert got(spark, rows, 0.5, "ratio") == {(2, 1, "fuzzy", round(SequenceMatcher(None, "rowhouse 23 studio", "rowhouse 18 - 1bdr park south").ratio(), 9))}
    assert round(SequenceMatcher(None, "rowhouse 23 studio", "rowhouse 18 - 1bdr park south").ratio(), 5) == 0.51064


def test_character_counts_bound_the_ratio_and_spare_most_pairs():
    draw = random.Random(3)
    names = [" ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3)) for _ in range(300)]
    names += [n[:-1] + "z" for n in names[:20]] + ["", ""]
    pool = dedup.Pool(0.9, True)
    found = []
    for i, name in enumerate(names):
        entry = {"ord": i, "id": None, "cname": str(i), "text": name}
        hit = pool.first(entry, 0, len(pool.ords))
        found.append(hit and hit["kept_ord"])
        if hit is None:
            pool.add(entry)
    kept, want = [], []
    for i, name in enumerate(names):
        hit = next((k for k in kept if SequenceMatcher(None, names[k], name).ratio() >= 0.9), None)
        want.append(hit)
        if hit is None:
            kept.append(i)
    assert found == want and sum(h is not None for h in found) == 21
    assert pool.computed < len(names) ** 2 / 2 / 50


def test_ratio_is_that_of_the_published_matcher():
    draw = random.Random(2)
    for n in range(3_000):
        letters = ("ab", "abc é", "abcdefghij 日🙂")[n % 3]
        a = "".join(draw.choice(letters) for _ in range(draw.randint(0, 30 if n % 100 else 300)))
        b = "".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) if n % 2 else "".join(c for c in a if draw.random() > 0.2) + "x"
        assert dedup.ratio(a, b) == SequenceMatcher(None, a, b).ratio(), (a, b)


def test_few_short_names_need_no_matcher_and_no_counts(monkeypatch):
    def refuse(*_):
        raise AssertionError("slow path")

    monkeypatch.setattr(dedup, "character_counts", refuse)
    monkeypatch.setattr(dedup, "SequenceMatcher", refuse)
    pool = dedup.Pool(0.85, True)
    entries = [{"ord": i, "id": str(i), "cname": t, "text": t} for i, t in enumerate(["suite no 1", "loft", "suite no 2", "suite no 1"])]
    assert pool.first(entries[0], 0, 0) is None
    pool.add(entries[0])
    assert pool.first(entries[1], 0, 1) is None and pool.computed == 0
    pool.add(entries[1])
    assert pool.first(entries[2], 0, 2) == {"ord": 2, "kept_ord": 0, "kind": "fuzzy", "similarity": 0.9}
    assert pool.first(entries[3], 0, 2)["kind"] == "exact"


def test_copies_are_looked_for_among_rows_that_share_an_entry_only(spark, monkeypatch):
    looked = []
    later = dedup._later_copies
    monkeypatch.setattr(dedup, "_later_copies", lambda rows, on: looked.append(rows.count()) or later(rows, on))
    rows = [(i, i, 1, 42.0, -73.0, f"{'abcdefghij'[i] * 9}") for i in range(10)]
    rows += [(20, 3, 1, 42.0, -73.0, "ddddddddd"), (21, 4, None, None, None, None), (22, 4, None, None, None, None)]
    log = dedup.duplicate_log(spark.createDataFrame(rows, SCHEMA), "row_id", 0.85)
    assert {(r.removed_key, r.retained_key, r.kind) for r in log.collect()} == {(20, 3, "exact_full_row"), (22, 21, "exact_full_row")}
    assert looked == [4]
    # Hosts that are -0.0 and 0.0 are equal in a row's signature, but not as text.
    odd = spark.createDataFrame([(1, 7, -0.0, 42.0, -73.0, "a"), (2, 7, 0.0, 42.0, -73.0, "a")], SCHEMA.replace("host_id bigint", "host_id double"))
    assert [(r.removed_key, r.retained_key, r.kind) for r in dedup.duplicate_log(odd, "row_id", 0.85).collect()] == [(2, 1, "exact_full_row")]


def test_folded_counts_are_never_below_common_characters():
    draw = random.Random(1)
    for _ in range(200):
        a, b = ("".join(draw.choice("abcé日🙂 ") for _ in range(draw.randint(0, 12))) for _ in range(2))
        common = np.minimum(dedup.character_counts(a), dedup.character_counts(b)).sum()
        assert common >= sum((Counter(a) & Counter(b)).values())


ROWS = 3_000


def test_hot_block(spark):
    # One host at one place with a third of its rows copies or near copies of a few names.
    draw = random.Random(11)
    rows = []
    for i in range(ROWS):
        name = f"flat {draw.randrange(5)} by the sea" if i % 3 == 0 else "".join(draw.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(16))
        rows.append((i, i, 1, 42.0, -73.0, name))
    log = got(spark, rows, 0.9, "ratio")
    kept = {r[0] for r in rows} - {k for k, *_ in log}
    assert all(kept_by in kept for _, kept_by, *_ in log)
    flats = [r for r in rows if r[5].startswith("flat")]
    assert len([r for r in flats if r[0] in kept]) == 1
    assert {x for x in log if rows[x[0]][5].startswith("flat")} == by_hand(flats, 0.9, "ratio")
    assert len(log) == len(flats) - 1


def test_a_partner_is_looked_for_once():
    compare = dedup.comparison("levenshtein", 0.9)
    assert str(compare.walk("e")).count("levenshtein") <= 2
    assert str(compare.scan("a", "b")).count("levenshtein") <= 2
