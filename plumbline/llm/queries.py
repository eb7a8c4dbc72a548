"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    bytebpe,
    decontaminate,
    divergence,
    langid,
    licenses,
    packing,
    search,
    sharding,
    simhash,
    tokencount,
    toxicity,
    urlfilter,
    vectors,
)
from plumbline.llm.common import crc_of_id, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op7_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.decontaminate(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    return decontaminate.digest(found)


SQL["op7_benchmark_decontamination"] = r"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), doc_windows AS (
    SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win
    FROM (
        SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size
    )
), found AS (
    SELECT doc_id, item_id, i, d.size FROM doc_windows d JOIN item_windows USING (win)
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokencount.count_tokens(read_table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op6_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bytebpe.round_trip(read_table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(read_table(spark, sf, "documents")))


@query
def op10_embedding_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf, "embeddings"))


SQL["op10_embedding_near_duplicates"] = """
WITH RECURSIVE sound AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""


URL_RULES = [  # fixed values
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


@query
def op2_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return urlfilter.judge(read_table(spark, sf, "pages"), rules)


SQL["op2_url_filter"] = """
WITH rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
), rules AS (
    SELECT *, split_part(rule, '/', 1) AS rule_host, substr(rule, instr(rule, '/')) AS rule_path
    FROM (VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')) v(rule, verdict)
), best AS (
    SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)
"""


@query
def op9_resharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text", F.col("_metadata.file_path").alias("file"))
    assigned, _ = sharding.reshard(docs, "file", 40)
    return sharding.digest(assigned)


def _remainder(divisor: int, value: int):
    return F.coalesce(crc_of_id("doc_id") % divisor == value, F.lit(False))


@query
def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    model = langid.train(docs, held_out=_remainder(3, 1))
    return langid.identify(docs, model).select("doc_id", _remainder(3, 1).alias("held_out"), "lang_pred", "score")


@query
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    model = toxicity.train(docs, read_table(spark, sf, "labels"), held_out=_remainder(5, 0))
    scored = toxicity.score(docs, model)
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", _remainder(5, 0).alias("held_out"), "score", predicted.alias("predicted"))


@query
def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.digest(licenses.scan(read_table(spark, sf, "documents")))


@query
def op11_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary, ranks = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    docs = read_table(spark, sf, "documents")
    return packing.pack(packing.pieces(docs, vocabulary, ranks, public_tokenizers.PATTERN, end_id=2))


@query
def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


SQL["op12_ranked_search"] = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), corpus AS (
    SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS terms FROM doc_words WHERE len(w) > 0
), held AS (
    SELECT doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM doc_words) JOIN (SELECT DISTINCT term FROM item_terms) USING (term)
    GROUP BY doc_id, n, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
    FROM held, corpus GROUP BY term, docs
), scores AS (
    SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
    FROM item_terms JOIN held USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""


@query
def op13_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf, "documents"))


SQL["op13_source_divergence"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), tokens AS (
    SELECT id, lang, source, unnest(w) AS term FROM docs
), kept AS (
    SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), pairs AS (
    SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT lang, source, term, count(*)::HUGEINT AS n FROM tokens JOIN kept USING (lang, term) GROUP BY lang, source, term
), grid AS (
    SELECT lang, source, term, coalesce(n, 0)::HUGEINT AS n,
        sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total, count(*) OVER (PARTITION BY lang, source) AS v
    FROM pairs JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), whole AS (
    SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total, count(*) OVER (PARTITION BY lang) AS v
    FROM grid GROUP BY lang, term
), p AS (
    SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (total + 2 * v) AS p FROM grid
), q AS (
    SELECT lang, term, 1 + (1000000000 * (n + 2)) // (total + 2 * v) AS q FROM whole
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM pairs a JOIN pairs b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10
"""
