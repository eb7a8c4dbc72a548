import base64
import random

import public_tokenizers as vocabularies
import pytest
import sentencepiece
import tiktoken

from plumbline.llm import bytebpe, tokencount

ALPHABETS = ["ab", "the in er on", "aA1 '\n\t .,!", "é ß ñ　\xa0▁ 日本語🙂́", "     \n\n  x'll's", "=-#/ *"]


def samples(n=400):
    draw = random.Random(5)
    out = ["", " ", "  ", "\n", "a" * 5000, "=" * 3001, " " * 700, "<s> <|endoftext|> <0x41>", "▁a", "a\x00b"]
    for _ in range(n):
        letters = draw.choice(ALPHABETS)
        out.append("".join(draw.choice(letters) for _ in range(draw.choice([3, 30, 300]))))
    words = "the thing 'tis don't we'll erthation loweischaft Über naïve 12345 x_y   z\n\n\tend".split(" ")
    return out + [" ".join(draw.choice(words) for _ in range(200)) for _ in range(20)]


@pytest.fixture(scope="module")
def scores():
    return tokencount.load_scores(vocabularies.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def ranks():
    return bytebpe.load_ranks(vocabularies.path("byte_bpe_50k.tiktoken"))


def test_counts_equal_the_library(scores):
    tokencount.check_borders(scores)
    count = tokencount.Counter(scores, tokencount.whole_tokens(scores))
    library = sentencepiece.SentencePieceProcessor(model_file=vocabularies.path("piece_bpe_32k.model"))
    for text in samples():
        assert count(text) == len(library.encode(text)), text[:80]
    assert count(None) == 0


def test_whole_tokens_encode_alone(scores):
    library = sentencepiece.SentencePieceProcessor(model_file=vocabularies.path("piece_bpe_32k.model"))
    whole = [p for p in tokencount.whole_tokens(scores) if p.startswith("▁") and p.strip("▁")]
    assert len(whole) > 10_000
    assert all(len(library.encode(p[1:].replace("▁", " "))) == 1 for p in whole[::7])


def test_a_border_inside_a_vocabulary_string_is_refused():
    with pytest.raises(ValueError):
        tokencount.check_borders({"a▁": 0.0})


@pytest.mark.parametrize("leaf,leaf_bytes", [(16_384, 48), (7, 3), (1, 1)])
def test_ids_equal_the_library(ranks, leaf, leaf_bytes):
    own = bytebpe.Codec(ranks, vocabularies.PATTERN, leaf, leaf_bytes)
    library = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in samples():
        ids = own.encode(text)
        assert list(memoryview(ids).cast("I")) == library.encode_ordinary(text), text[:80]
        assert own.decode(ids).decode() == text


def test_ranks_are_read_line_by_line(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n\n" + base64.b64encode(b"b") + b" 1\n")
    assert bytebpe.load_ranks(str(path)) == {b"a": 0, b"b": 1}


EDGES = [(1, "the end", "x", 1), (None, None, None, 2), (2, "", "y", 3), (2, "", "y", 3), (3, "a b " * 30_000, None, None)]


def test_edge_rows(spark, ranks):
    docs = spark.createDataFrame(EDGES, "doc_id bigint, text string, TEXT string, n_tokens int")
    got = tokencount.count_tokens(docs, vocabularies.path("piece_bpe_32k.model")).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got) == [
        (0, 0, False), (0, 0, False), (0, 0, False), (7, 2, False), (120_000, 60_001, True),
    ]
    path = vocabularies.path("byte_bpe_50k.tiktoken")
    trip = bytebpe.round_trip(docs, path, vocabularies.PATTERN)
    assert sorted(r.n_tokens for r in trip.collect()) == [0, 0, 0, 2, 60_001]
    ids = bytebpe.encode(docs, path, vocabularies.PATTERN)
    texts = [bytes(r.decoded).decode() for r in bytebpe.decode(ids, path, vocabularies.PATTERN).collect()]
    assert sorted(texts) == sorted(t or "" for _, t, _, _ in EDGES)
    assert tokencount.count_tokens(docs.limit(0), vocabularies.path("piece_bpe_32k.model")).count() == 0
