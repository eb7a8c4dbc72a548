import hashlib

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
from plumbline.llm import bytebpe, decontaminate, langid, simhash, toxicity
from plumbline.llm.common import read_table
from tests.llm.test_decontaminate import by_hand
from tests.llm.test_simhash import closure

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    out = [read_table(spark, SF, "documents")]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_filters_keep_columns_and_take_effect(spark, stages):
    docs = stages[0]
    for before, after in zip(stages[:4], stages[1:5], strict=True):
        assert after.columns == docs.columns
        assert after.exceptAll(before).count() == 0
    labels = read_table(spark, SF, "labels")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert set(rows_of(stages[1])) == {i for i, s in scores.items() if s < 0.5}
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(stages[1], langid.train(stages[1])).collect()}
    assert set(rows_of(stages[2])) == {i for i, (n, s) in found.items() if n != "und" and s >= langid.LEAST_SCORE}


def test_one_of_each_group_stays(stages):
    before = rows_of(stages[2])
    ids = list(before)
    want = closure(ids, [simhash.fingerprint(before[i].text) for i in ids])
    assert set(rows_of(stages[3])) == set(want)


def test_no_passage_stays(spark, stages):
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    before = rows_of(stages[3])
    assert set(rows_of(stages[4])) == {i for i, r in before.items() if not by_hand(r.text, items)[1]}


def test_tokens_of_what_is_left(stages):
    ranks = bytebpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before = rows_of(stages[4])
    after = rows_of(stages[5])
    assert set(after) == set(before)
    for i, r in after.items():
        ids = library.encode_ordinary(before[i].text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(n.to_bytes(4, "little") for n in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(before[i].text.encode()).hexdigest()


def test_registered_and_edge_rows(spark):
    assert entry.queries()["pipeline"] is pipeline.run
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "the same words here now"), (3, "the same words here now"), (4, "the same words here now"), (None, "other words than these"), (None, "other words than these"), (5, "é" * 60_000)],
        "doc_id bigint, text string",
    ).select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"), F.lit(2).alias("h1"), F.lit(0).alias("score"))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, len(r.text or "")) for r in kept.collect()) == [(0, 22), (1, 0), (3, 23), (5, 60_000)]
    for name, stage in pipeline.STAGES[:4]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert pipeline.STAGES[4][1](spark, docs, SF).count() == 8
    assert decontaminate.clean_documents(docs, read_table(spark, SF, "benchmark")).count() == 8
