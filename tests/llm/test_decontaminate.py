import hashlib
import random
import re

import pytest

from plumbline.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_by_hand(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def by_hand(text, items, size=10):
    words = words_by_hand(text)
    hit, found = set(), set()
    for number, item in items:
        own = words_by_hand(item)
        for i in range(max(1, len(own) - size + 1) if own else 0):
            window = own[i : i + size]
            for k in range(len(words) - len(window) + 1):
                if words[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    found.add(None if number is None else str(number))
    return len(words), len(hit), sorted(found, key=lambda i: (i is None, i))


def cases():
    draw = random.Random(9)
    vocabulary = "the The cat 42 é日本 x_y o'clock ÜBER".split()
    prose = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, prose(draw.choice([1, 4, 10, 25]))) for i in range(8)] + [(8, None), (9, ""), (10, "?!"), (None, "only here"), (3, prose(12)), (3, prose(12))]
    docs = [None, "", "...", "x", "Only, HERE!", "é" * 50_000] + [prose(draw.choice([3, 30, 200])) for _ in range(40)]
    docs += [f"{prose(20)}\n- {items[i][1]} -\t{prose(5)}" for i in range(8)] + [docs[8]] * 3
    return docs, items


@pytest.mark.parametrize("block_bytes", [4_000_000, 300])
def test_equals_brute_force(spark, block_bytes):
    docs, items = cases()
    table = spark.createDataFrame([(i, t, "e", 1) for i, t in enumerate(docs)], "doc_id int, text string, TEXT string, n_words int")
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    got = decontaminate.decontaminate(table, benchmark, block_bytes=block_bytes).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == {i: by_hand(t, items) for i, t in enumerate(docs)}
    for r in got:
        text = docs[r.doc_id] or ""
        assert sum(len(words_by_hand(text[s.start : s.end])) for s in r.spans) == r.n_hit


def test_spans_give_the_passage(spark):
    passage = "Which of the seven old bridges in Köln was built first?"
    docs = spark.createDataFrame([(1, f"Ümlaut first… {passage} And so on.")], "doc_id int, text string")
    items = spark.createDataFrame([(7, passage)], "item_id int, text string")
    row = decontaminate.decontaminate(docs, items).first()
    assert row.n_hit == 11 and docs.first().text[row.spans[0].start : row.spans[0].end] == passage[:-1]


def test_empty_tables_and_filter(spark):
    docs = spark.createDataFrame([(1, "a b c", "k"), (2, None, "k"), (1, "q", None)], "doc_id int, text string, text2 string")
    items = spark.createDataFrame([(1, "B c")], "item_id int, text string")
    assert sorted(r.n_hit for r in decontaminate.decontaminate(docs, items.limit(0)).collect()) == [0, 0, 0]
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns and sorted(r.text or "" for r in kept.collect()) == ["", "q"]


def test_null_item_ids_count(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id bigint, text string")
    items = spark.createDataFrame([(None, "two three"), ("b", "three"), (None, "one")], "item_id string, text string")
    rows = {r.doc_id: r for r in decontaminate.decontaminate(docs, items).collect()}
    assert rows[1]["items"] == ["b", None] and rows[1].n_hit == 3 and rows[2]["items"] == []
    counted = {r.doc_id: r for r in decontaminate.digest(decontaminate.decontaminate(docs, items)).collect()}
    assert counted[1].n_items == 2 and counted[1].items_sha256 == hashlib.sha256(b"b").hexdigest()
