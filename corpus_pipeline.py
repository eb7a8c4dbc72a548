"""A training-data pipeline over ``documents``: each stage applies one operator of ``plumbline.llm``.

A stage takes what its predecessor kept, whole texts and all columns; all but the last give rows of
``documents``. A stage only removes rows for its own reason: toxic texts, texts in no known
language, near copies of a text that stays, texts with passages of the benchmark. The last one
encodes and decodes what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import bytebpe, decontaminate, langid, simhash, toxicity
from plumbline.llm.common import read_table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose most suspicious window scores below 0.5; the model is fitted on a sample of ``labels``."""
    return toxicity.clean_documents(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model, fitted on a sample of ``docs``, has learned."""
    return langid.known_language(docs, langid.train(docs))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bytebpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity_filter),
    ("language", language_filter),
    ("near_duplicates", near_duplicate_filter),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

ORACLE_SQL = None  # no stage but the fourth can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
