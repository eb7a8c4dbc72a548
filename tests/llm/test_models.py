import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from plumbline.llm import gru, langid, toxicity

SF = "/root/testdata/sf0.01"


def loss_of(e, ids, y, importance, weights):
    return gru.gradients(e, ids, y, importance, weights)[0]


def test_gradients_equal_differences():
    draw = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) for k, v in gru.new_weights(1).items()}
    e, ids = draw.normal(size=(9, 2 * gru.EMBEDDING)), draw.integers(0, 9, (5, 6))
    y, importance = np.array([1, 0, 1, 0, 1.0]), np.ones(5)
    _, g, d_e = gru.gradients(e, ids, y, importance, weights)
    for name, value in [*g.items(), ("e", d_e)]:
        own = e if name == "e" else weights[name]
        at = np.unravel_index(np.argmax(np.abs(value)), value.shape)
        kept = own[at]
        own[at] = kept + 1e-3
        up = loss_of(e, ids, y, importance, weights)
        own[at] = kept - 1e-3
        down = loss_of(e, ids, y, importance, weights)
        own[at] = kept
        assert value[at] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=1e-4)


def test_windows_begin_at_every_word():
    weights = gru.new_weights(2)
    draw = np.random.default_rng(4)
    added = gru.project(draw.normal(0, 1, (50, 2 * gru.EMBEDDING)).astype(np.float32), weights)
    texts = [draw.integers(0, 50, n) for n in (0, 1, 5, 32, 33, 256, 700)]
    found = gru.window_logits(texts, added, weights, 32)
    assert [len(f) for f in found] == [0, 1, 1, 1, 2, 225, 669]
    for text, logits in zip(texts, found, strict=True):
        if not len(text):
            continue
        for start in {0, len(logits) // 2, len(logits) - 1}:
            # The block's states by themselves, then pooled directly.
            attention, read = gru.word_values([text], added, weights)
            own = slice(start, start + 32)
            share = np.exp(attention[own])
            assert logits[start] == pytest.approx((share * read[own]).sum() / share.sum() + weights["read_bias"][0], abs=1e-5)
    # Inside one block a window with all of the text as context is what the training step sees.
    text = texts[3]
    x = np.stack([added[0][text[:, None]], added[1][text[::-1][:, None]]])
    assert found[3][0] == pytest.approx(gru.forward(x, weights, slice(None))[0][0], abs=1e-5)


def test_blocks_share_out_all_words():
    for n in (1, 255, 256, 257, 1000):
        blocks = gru.blocks_of([3, n])
        words = [w for t, first, end, _, _ in blocks for w in range(first, end) if t == 1]
        assert words == list(range(n))
        assert all(a == max(0, f - gru.CONTEXT) and b == min((3, n)[t], e + gru.CONTEXT) for t, f, e, a, b in blocks)


def test_context_takes_part_in_gradients_but_not_in_pooling():
    draw = np.random.default_rng(7)
    weights = {k: v.astype(np.float64) for k, v in gru.new_weights(1).items()}
    e, ids = draw.normal(size=(9, 2 * gru.EMBEDDING)), draw.integers(0, 9, (4, 7))
    y, importance, inner = np.array([1, 0, 1, 0.0]), np.ones(4), slice(2, 5)
    _, g, d_e = gru.gradients(e, ids, y, importance, weights, inner)
    for name, value in [*g.items(), ("e", d_e)]:
        own = e if name == "e" else weights[name]
        at = np.unravel_index(np.argmax(np.abs(value)), value.shape)
        kept = own[at]
        losses = []
        for step in (1e-3, -1e-3):
            own[at] = kept + step
            losses.append(gru.gradients(e, ids, y, importance, weights, inner)[0])
        own[at] = kept
        assert value[at] == pytest.approx((losses[0] - losses[1]) / 2e-3, rel=0.02, abs=1e-4)


def test_scores_do_not_depend_on_the_batch():
    model = toxicity.Model(gru.new_weights(3), 0.0)
    texts = ["one two", None, "word " * 500, "", "É 日本 x", "!!!", "one two"]
    alone = [toxicity.Scorer(model)([t])[0] for t in texts]
    assert toxicity.Scorer(model)(texts) == pytest.approx(alone, abs=1e-5)
    assert alone[1] == alone[3] == alone[5] == 0.0


def test_held_out_toxicity(spark):
    got = entry.queries()["op3_toxicity"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("toxic IS NOT NULL")
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9


def test_toxicity_edge_rows(spark):
    schema = "doc_id bigint, text string, score int"
    docs = spark.createDataFrame([(1, "good words"), (2, "bad nasty words"), (2, "bad nasty words"), (None, None), (4, ""), (5, "good " * 200_000)], "doc_id bigint, text string").withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (3, None), (2, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    got = [r.score for r in toxicity.score(docs, model).collect()]
    assert len(got) == 6 and got[3] == got[4] == 0.0 and all(0 <= s <= 1 for s in got)
    assert toxicity.train(docs, labels.limit(0)) is None
    assert [r.score for r in toxicity.score(docs, None).collect()] == [0.0] * 6
    assert toxicity.clean_documents(docs, None).columns == docs.columns
    assert toxicity.score(spark.createDataFrame([], schema), model).count() == 0


def test_kernel_of_presence():
    grams = langid.Grams("abc")
    flags = grams("Ab, ab")
    assert sorted(np.flatnonzero(flags)) == sorted({
        1, 2, 64 + 1, 64 + 64 + 2, 64 + 2 * 64, 64 + 4096 + 64 + 2, 64 + 4096 + 4096 + 2 * 64, 64 + 4096 + 2 * 4096 + 1,
    })
    assert grams("...") is None and grams(None) is None and grams("日") is not None


def test_held_out_language(spark):
    got = entry.queries()["op8_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert got.count() == docs.count()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_language_edge_rows(spark):
    draw = random.Random(1)
    words = {"x": "the and of thing", "y": "der die das und"}
    rows = [(i, " ".join(draw.choice(words[k].split()) for _ in range(9)), k, 1.0) for i, k in enumerate("xy" * 20)]
    rows += [(None, "the", "x", 0.0), (90, None, "x", 0.0), (91, "", "y", 0.0), (92, "1 2 !", "y", 0.0), (93, "the thing", None, 0.0), (93, "the thing", None, 0.0), (94, "das " * 30_000, None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    model = langid.train(docs)
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(docs, model).where("doc_id >= 90").collect()}
    assert got == {(90, "und"), (91, "und"), (92, "und"), (93, "x"), (94, "y")}
    assert langid.train(docs.limit(0)) is None and langid.train(docs.where("lang IS NULL")) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    kept = langid.known_language(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3


def test_a_language_of_long_texts_is_learned_too(spark):
    rows = [(i, "the thing and of " * 2, "x") for i in range(30)] + [(100 + i, "das und der die " * 2000, "y") for i in range(30)]
    rows += [(200 + i, "... 12", "y") for i in range(30)] + [(300 + i, "the " * 9000, "x") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(9)
    found = langid.sample(docs, F.lit(True), per_language=25, longest=20_000, few=3)
    assert sorted((r.lang, len(r.text) > 20_000) for r in found) == [("x", False)] * 25 + [("y", True)] * 3


def test_texts_in_no_learned_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    classify = langid.Classifier(model)
    unlearned = [
        "Это обычный текст на русском языке, который модель никогда не видела.", "これは日本語の文章です。", "Αυτό είναι ένα κείμενο στα ελληνικά",
        "Tämä on suomenkielinen teksti, jota malli ei ole koskaan nähnyt, joten se pitäisi hylätä täysin.",
        "Wczoraj poszedłem do sklepu, żeby kupić chleb, mleko i kilka jabłek na śniadanie dla całej rodziny.",
        "Bugün hava çok güzel olduğu için arkadaşlarımla birlikte parka gidip uzun bir yürüyüş yaptık.",
        "xqzk wvvjq zzkqx qqjxv kzxwq",
    ]
    assert not any(known for _, _, known in classify.judge(unlearned))
    assert all(name in model.languages and 0 <= score <= 1 for name, score in classify(unlearned))
    short = ["OK", "Quiz jazz", "Xylophone", "USA", "42 km", "Kyiv", "print(x)", "A. All rights reserved.", "The thing is on the end"]
    assert all(known and name in model.languages for name, _, known in classify.judge(short))
    rows = docs.where("lang IS NOT NULL AND length(text) BETWEEN 200 AND 5000").orderBy("doc_id").collect()
    by_language = {k: [r.text for r in rows if r.lang == k][:30] for k in {r.lang for r in rows}}
    mixed = [" ".join(parts) for parts in zip(*by_language.values(), strict=False)]
    assert len(mixed) > 10 and all(known and s >= langid.LEAST_SCORE for _, s, known in classify.judge(mixed))
    lettered = [r for r in docs.where("text IS NOT NULL").collect() if any(c.isalpha() for c in r.text)]
    assert all(known and n != "und" for n, _, known in classify.judge([r.text for r in lettered]))
    given = spark.createDataFrame([(1, "words", None), (2, "1 !", None), (3, None, None)], "doc_id int, text string, lang string")
    assert [r.doc_id for r in langid.known_language(given, langid.train(given)).collect()] == [1]
