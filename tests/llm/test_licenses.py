import itertools
import random

from plumbline.llm import licenses


def test_increasing_is_longest():
    draw = random.Random(4)
    for _ in range(200):
        values = [draw.randrange(12) for _ in range(draw.randrange(9))]
        got = [values[i] for i in licenses.increasing(values)]
        best = max(
            (len(c) for n in range(len(values) + 1) for c in itertools.combinations(values, n) if list(c) == sorted(set(c))),
            default=0,
        )
        assert got == sorted(set(got)) and len(got) == best


def test_alignment_is_a_common_subsequence():
    draw = random.Random(6)
    for _ in range(300):
        a = [draw.choice("abcdefgh") for _ in range(draw.randrange(20))]
        b = [draw.choice("abcdefgh") for _ in range(draw.randrange(20))]
        found = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x < y and u < v for (x, u), (y, v) in itertools.pairwise(found))
    words = [f"w{i}" for i in range(50)]
    assert licenses.align(words, words) == [(i, i) for i in range(50)]
    assert len(licenses.align(words[:20] + ["x", "x"] + words[25:], words)) == 45


def test_regions_lose_no_window():
    """Every window that aligns well lies in a range that the counting keeps."""
    draw = random.Random(8)
    template = "a b c d e f g h".split()
    scanner = licenses.Scanner([("T", " ".join(template))])
    for _ in range(300):
        words = [draw.choice([*"abcdefghxyz"]) for _ in range(40)]
        if draw.random() < 0.6:
            at = draw.randrange(30)
            words[at:at] = [w for w in template if draw.random() < 0.93]
        best = max(len(licenses.align(words[i : i + 12], template)) / 8 for i in range(len(words)))
        got = scanner(" ".join(words))
        assert bool(got) == (best >= 0.8)
        if got:
            assert abs(got[0].coverage - best) < 1e-9


def test_edge_rows(spark):
    mit = licenses.TEMPLATES[0][1]
    rows = [
        (1, None), (2, ""), (3, "İ__ Released under\n the MIT-License. " * 2000), (4, f"prose {mit} prose"), (4, f"prose {mit} prose"),
        (5, mit.replace("deal in", "trade with").replace("limitation", "limits")), (6, "This license is under a work, public"),
        (7, "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3."),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id int, text string, License string")
    got = licenses.scan(docs).collect()
    best = sorted((r.doc_id, r.licenses[0].license if r.licenses else None, len(r.licenses)) for r in got)
    assert best[:2] == [(1, None, 0), (2, None, 0)]
    assert [b for b in best if b[0] in (3, 4, 5)] == [(3, "MIT", 1), (4, "MIT", 1), (4, "MIT", 1), (5, "MIT", 1)]
    assert best[-2] == (6, None, 0)
    seven = next(r.licenses for r in got if r.doc_id == 7)
    assert {"GPL-3.0", "CC-BY-NC-4.0"} <= {m.license for m in seven}
    four = next(r.licenses[0] for r in got if r.doc_id == 4)
    text = rows[3][1]
    assert text[four.start : four.end].startswith("Permission") and four.coverage == 1.0
    assert licenses.scan(docs.limit(0)).count() == 0
    assert all(not r.licenses for r in licenses.scan(docs, []).collect())


def found_in(text):
    return [m.license for m in licenses.Scanner(licenses.TEMPLATES)(text)]


def test_neighbours_are_told_apart():
    notices = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "Licensed under the GNU Lesser General Public License v2.1": "LGPL-2.1",
        "under the terms of the GNU Affero General Public License, version 3": "AGPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0",
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "Distributed under the MIT License": "MIT",
        "SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1",
    }
    for text, name in notices.items():
        assert found_in(f"some words before {text} And after.") == [name], text
    for text in ("Licensed under the BSD License", "licensed under the old License", "SPDX-License-Identifier: MIT-0", "under the GNU General Public License"):
        assert found_in(text) == [], text
    both = "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0. Released under the MIT License."
    assert sorted(found_in(both)) == ["CC-BY-4.0", "CC-BY-NC-4.0", "MIT"]


def test_full_texts_of_neighbours():
    for template in licenses.TEMPLATES:
        if not template.whole:
            words = template.text.split()
            edited = " ".join(w for i, w in enumerate(words) if i != len(words) - 2)
            assert found_in(template.text) == found_in(f"x {edited} y") == [template.license], template
    two, three = (next(t.text for t in licenses.TEMPLATES if t.license == f"BSD-{n}-Clause") for n in (2, 3))
    assert sorted(found_in(f"{three} {two}")) == ["BSD-2-Clause", "BSD-3-Clause"]


def test_a_match_inside_another_is_dropped():
    scanner = licenses.Scanner([("long", "a b c d e f g h"), ("short", "c d e f g")])
    assert [m.license for m in scanner("a b c d e f g h")] == ["long"]
    assert [m.license for m in scanner("x c d e f g x")] == ["short"]
    assert [m.license for m in licenses.Scanner([("one", "a b c d e"), ("two", "a b c d e")])("a b c d e")] == ["one", "two"]
