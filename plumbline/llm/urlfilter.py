"""URL rules by a cascade of Bloom filters.

A rule is ``host/path``; it fits its host and all subdomains where the url's path starts with the
rule's. A url's candidate keys are therefore the suffixes of its host joined to the prefixes of
its path that have the length of some rule's path. The longest listed candidate decides (of equal
length the one with the longer host; in both lists: block); without one the url is allowed.

Membership without joins: level 0 of a cascade is a Bloom filter over the listed keys, level 1 one
over the keys of the corpus that pass it though unlisted, level 2 one over the listed keys that
pass level 1, and so on until nothing passes wrongly. The first level that a key fails tells: it is
listed if that level is odd. This is exact for every key of the corpus, since all of them were
tested when the levels were built.

Keys are dealt by hash into cascades of at most about ``FILTER_KEYS`` listed keys, so a filter that
is broadcast has a bounded size; a larger list only means more cascades, applied in turn.

A null url or one without ``://`` has an empty host and path and fits no rule; an empty host fits
none; repeated rules and urls change nothing; an empty list allows everything.
"""

from __future__ import annotations

import string
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import once, pick
from plumbline.session import settle

FILTER_KEYS = 5_000_000
FIRST_BITS, FIRST_HASHES = 10, 7
NEXT_BITS, NEXT_HASHES = 3, 2


class Bloom:
    """A filter as an array of 64-bit words."""

    def __init__(self, keys: int, level: int, words: np.ndarray | None = None):
        per_key, self.hashes = (FIRST_BITS, FIRST_HASHES) if level == 0 else (NEXT_BITS, NEXT_HASHES)
        self.level, self.bits = level, max(64, -(-keys * per_key // 64) * 64)
        self.words = np.zeros(self.bits // 64, dtype=np.uint64) if words is None else words

    def places(self, key: str) -> list[int]:
        h = xxhash.xxh64_intdigest(key.encode(), self.level)
        return [((h & 0xFFFFFFFF) + i * (h >> 32 | 1)) % self.bits for i in range(self.hashes)]

    def __contains__(self, key: str) -> bool:
        return all(int(self.words[p >> 6]) >> (p & 63) & 1 for p in self.places(key))


def listed(key: str, levels: list[Bloom]) -> bool:
    for i, level in enumerate(levels):
        if key not in level:
            return i % 2 == 1
    return len(levels) % 2 == 1


def build_level(keys: DataFrame, level: int) -> Bloom:
    """A filter over ``keys (key)``: bits are set where the keys are, words are or-ed in Spark."""
    empty = Bloom(keys.count(), level)

    def bits(batches):
        for batch in batches:
            words: dict[int, int] = {}
            for key in batch.column(0).to_pylist():
                for p in empty.places(key):
                    words[p >> 6] = words.get(p >> 6, 0) | 1 << (p & 63)
            masks = np.array(list(words.values()), dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.int64()), pa.array(masks)], names=["word", "mask"])

    found = keys.mapInArrow(bits, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    for row in found.toLocalIterator():  # no more words than the filter has
        empty.words[row.word] = np.int64(row.mask).view(np.uint64)
    return empty


def passing(keys: DataFrame, level: Bloom) -> DataFrame:
    name, sent = uuid.uuid4().hex, keys.sparkSession.sparkContext.broadcast(level)

    def run(batches):
        own = once(name, lambda: sent.value)
        for batch in batches:
            yield batch.filter(pa.array([k in own for k in batch.column(0).to_pylist()], pa.bool_()))

    return keys.mapInArrow(run, "key string")


def build_cascade(keys: DataFrame, universe: DataFrame) -> list[Bloom]:
    """Levels that are exact for the listed ``keys`` and every key of ``universe`` (column ``key``, distinct)."""
    levels = [build_level(keys, 0)]
    inside, outside = keys, settle(passing(universe.join(keys, "key", "left_anti"), levels[0]))
    while not outside.isEmpty():
        levels.append(build_level(outside, len(levels)))
        inside, outside = outside, settle(passing(inside, levels[-1]))
    return levels


def parts(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def candidates(host: str, path: str, lengths: list[int]) -> Column:
    """Suffixes of the host joined to prefixes of the path, none for an empty host."""
    labels = F.split(F.col(host), "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    sizes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(sizes, lambda n: F.concat(s, F.col(path).substr(F.lit(1), n)))))
    return F.when(F.col(host) != "", keys).otherwise(F.array().cast("array<string>"))


def judge(
    pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", filter_keys: int = FILTER_KEYS
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page; ``rules (rule, verdict)`` are allow or block."""
    found = pick(pages, page_id=page_id, url=url)
    host, path = parts("url")
    found = found.select("page_id", host.alias("host"), path.alias("path"))
    rules = settle(pick(rules, key="rule", verdict="verdict").distinct())
    bare = F.regexp_extract("key", "^([^/?#]*)", 1)
    lengths = [r[0] for r in rules.select(F.length("key") - F.length(bare)).distinct().collect()]
    if not lengths:
        return found.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    found = found.withColumn("keys", candidates("host", "path", sorted(lengths)))
    universe = settle(found.select(F.explode("keys").alias("key")).distinct())
    total = rules.count()
    parted = -(-total // filter_keys)
    part = F.pmod(F.xxhash64("key"), F.lit(parted))
    out = found.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit("allow"))
    for i in range(parted):
        cascades = {
            verdict: build_cascade(
                rules.where((F.col("verdict") == verdict) & (part == i)).select("key"), universe.where(part == i)
            )
            for verdict in ("block", "allow")
        }
        out = _apply(out, cascades, i, parted)
    return out.drop("keys")


def _apply(rows: DataFrame, cascades: dict[str, list[Bloom]], own: int, parted: int) -> DataFrame:
    """Replaces rule and verdict where a longer candidate is listed here; keys of other parts are unlisted here."""
    name, sent = uuid.uuid4().hex, rows.sparkSession.sparkContext.broadcast(cascades)
    if parted > 1:
        mine = F.filter("keys", lambda k: F.pmod(F.xxhash64(k), F.lit(parted)) == own)
    else:
        mine = F.col("keys")
    order = rows.columns
    given = rows.withColumn("mine", mine)

    def longest(keys, rule, verdict, held):
        rank = lambda k: (len(k), (k + "/").index("/"))
        for key in sorted(keys, key=rank, reverse=True):
            if rule is not None and rank(rule) >= rank(key):
                break
            for kind, levels in held.items():
                if listed(key, levels):
                    return key, kind
        return rule, verdict

    def run(batches):
        held = once(name, lambda: sent.value)
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            lists = (columns[c].to_pylist() for c in ("mine", "rule", "verdict"))
            new = [longest(*x, held) for x in zip(*lists, strict=True)]
            columns["rule"] = pa.array([r for r, _ in new], pa.string())
            columns["verdict"] = pa.array([v for _, v in new], pa.string())
            yield pa.RecordBatch.from_arrays([columns[c] for c in order], names=order)

    return given.mapInArrow(run, rows.schema)
