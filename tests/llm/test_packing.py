import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as vocabularies
import pytest
from tokenizers import Tokenizer

from plumbline.llm import packing
from plumbline.llm.bytebpe import load_ranks

JSON, RANKS = (vocabularies.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))


@pytest.fixture(scope="module")
def encoder():
    with open(JSON, encoding="utf-8") as file:
        return packing.Encoder(file.read(), load_ranks(RANKS), vocabularies.PATTERN)


def by_library(encoder, text):
    return encoder.library.encode(text, add_special_tokens=False).ids


def test_every_character_of_the_fast_range_is_split_as_by_the_library(encoder):
    for code in range(0x250):
        c = chr(code)
        for text in (c, f"a{c}b", f" {c} ", f"1{c}1", f"{c}{c}  {c}a", f"\n{c} x", f"'{c}", f"{c}'s", f".{c}!", f" {c}{c}\n"):
            assert list(encoder.fast.encode_to_numpy(text, allowed_special="all")) == by_library(encoder, text), text


def test_ids_equal_the_library(encoder):
    draw = random.Random(4)
    alphabets = ["ab", "the in er on", "aA1 '\n\t .,!", "é ß ñ　\xa0 日本語🙂́", "     \n\n  x'll's", "=-#/ *", "ǅŁ ſ\x85\x1c\x00 "]
    texts = ["", " ", "<|endoftext|>", "a<|endoftext|> b", "<|endof", " " * 300_000, "\n" * 250_001, "x " * 250_000, "ab" * 150_000]
    for _ in range(400):
        letters = draw.choice(alphabets)
        texts.append("".join(draw.choice(letters) for _ in range(draw.choice([3, 30, 300]))))
    for text in texts:
        assert list(encoder(text)) == by_library(encoder, text), text[:60]


def test_long_texts_are_cut_where_ids_stay(encoder):
    draw = random.Random(1)
    text = "".join(draw.choice(["word", " ", "  ", "\n", "12", "!?", " <|endoftext|>", "'s", "日", "\t "]) for _ in range(4000))
    for limit in (1, 7, 100):
        parts = packing.long_parts(text, limit)
        assert "".join(parts) == text and len(parts) > 10
        assert [i for p in parts for i in encoder.part(p)] == by_library(encoder, text)


def brute_force(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_best_fit_decreasing_item_by_item(seed):
    draw = random.Random(seed)
    capacity = draw.choice([1, 5, 10, 37, 100, 1024])
    lengths = [draw.randint(1, capacity) for _ in range(draw.choice([0, 1, 50, 400]))]
    if seed % 2:
        lengths = [min(capacity, 1 + int(draw.expovariate(8 / capacity))) for _ in lengths]
    counts = Counter(lengths)
    place = packing.Places(counts, packing.plan(counts, capacity))
    held = {}
    for length, n in counts.items():
        for sequence, offset in zip(*place(np.full(n, length), np.arange(n)), strict=True):
            held.setdefault(int(sequence), []).append((int(offset), length))
    rooms = []
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
        rooms.append(capacity - at)
    assert sorted(rooms) == brute_force(lengths, capacity)


def test_plan_does_not_grow_with_the_number_of_pieces():
    draw = random.Random(9)
    small = {n: draw.randint(1, 50) for n in range(1, 1025)}
    large = {n: 10_000_000 * c + draw.randint(0, 9_999_999) for n, c in small.items()}
    blocks = packing.plan(large, 1024)
    assert len(blocks) < 60_000
    total = sum(n * c for n, c in large.items())
    sequences = max(b.sequence + -(-(b.end - b.first) // b.each) for b in blocks)
    assert sequences <= -(-total // 1024) * 11 / 9 + 1


def test_rooms_by_linear_search():
    draw = random.Random(2)
    rooms, held = packing.Rooms(100), Counter()
    for _ in range(3000):
        room, least = draw.randint(1, 100), draw.randint(1, 100)
        change = 1 if draw.random() < 0.5 or not held[room] else -1
        rooms.add(room, change)
        held[room] += change
        assert rooms.tightest(least) == min((r for r, n in held.items() if n and r >= least), default=None)


def packed(spark, docs, capacity, carry=False):
    found = packing.pieces(docs, JSON, RANKS, vocabularies.PATTERN, 2, capacity, carry=carry)
    return packing.pack(found, capacity)


EDGES = [(1, "the end", "x", 1), (None, None, None, 2), (2, "", "y", 3), (2, "", "y", 3), (3, "a b " * 30_000, None, None)]


def test_edge_rows(spark):
    docs = spark.createDataFrame(EDGES, "doc_id bigint, text string, TEXT string, piece int")
    rows = packed(spark, docs, 1024).collect()
    library = Tokenizer.from_file(JSON)
    want = Counter()
    for doc_id, text, _, _ in EDGES:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        for piece, (start, length) in enumerate(packing.cuts(len(ids), 1024)):
            crc = zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            want[doc_id, piece, start, length, crc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert packed(spark, docs.limit(0), 1024).count() == 0


def test_pieces_of_a_long_document():
    assert packing.cuts(1, 10) == [(0, 1)]
    assert packing.cuts(10, 10) == [(0, 10)]
    assert packing.cuts(23, 10) == [(0, 3), (3, 10), (13, 10)]


def test_sequences_hold_every_document_once(spark):
    draw = random.Random(3)
    texts = [" ".join(draw.choice(["one", "two", "thirteen", "ünder"]) for _ in range(draw.randint(0, 90))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(7)
    found = packed(spark, docs, 64, carry=True)
    rows = found.collect()
    lengths = [r.length for r in rows]
    rooms = Counter()
    for r in rows:
        rooms[r.sequence_id] += r.length
    assert sorted(64 - n for n in rooms.values()) == brute_force(lengths, 64)
    assert len(rooms) <= -(-sum(lengths) // 64) + 1
    library = Tokenizer.from_file(JSON)
    whole = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(whole.setdefault(r.doc_id, []))
        whole[r.doc_id] += r.ids
    assert whole == {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    for s in packing.sequences(found).collect():
        assert sum(s.lengths) == len(s.ids) <= 64 and len(s.doc_ids) == len(s.lengths)
        assert s.ids.count(2) <= len(s.doc_ids)
