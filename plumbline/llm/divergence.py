"""How far the sources of a language drift apart in their words, recounted over perfect hashes.

1. A first pass over the texts counts documents by (language, term), exactly; terms in at least
   ``least`` documents are kept. Tasks hand on partial counts, from tables of bounded size.
2. The kept terms of a language are dealt by hash into shards, and a task builds the minimal perfect
   hash of a shard: every key gets its own slot from 0 to n - 1. Keys are stored in slot order, so a term that was not
   kept is told from a key by comparing it with the key in its slot.
3. Shards are broadcast and a second pass counts every occurrence in dense slots per group (language,
   source) and shard. Slots are handed on when they reach a bounded number. If the shards are more than
   ``ROUND_BYTES``, they are broadcast in as many rounds, each a pass over the texts.
4. Counts are summed, and a task per shard compares all groups of its language over its own slots: a
   matrix of at most about ``CELLS`` numbers. Sums over shards give the divergence of each pair, the best terms of
   shards those of a group.

With smoothed shares ``p = 1 + floor(SHARE * (count + 2) / (N + 2 * V))`` the divergence of two shares is
``floor((p - q)^2 / (p + q))``. All arithmetic is in integers, of any size where 64 bits do not hold it.

Null texts, languages and sources count as empty strings, so nulls and empty strings are one group. Groups without terms
take part; a language without kept terms has pairs of value 0 and no term rows. Repeated rows
count as often as they occur; equal values are ranked by the bytes of the item. An empty table gives no
rows. Very long texts are read whole. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.skew import lookup_groups
from plumbline.llm.common import LOWER, Batches, once, pick, slices
from plumbline.session import settle, spread

SHARE = 1_000_000_000
ENTRIES = 300_000  # (language, term) or (group, term) entries a task gathers before it hands them on
SLOTS = 8_000_000  # dense slots a task holds
CELLS = 250_000  # groups times slots that a shard aims at
LEAST_KEYS = 256  # keys of a shard, however many groups there are
ROUND_BYTES = 32_000_000  # of keys broadcast at once
LEVELS = 48
SPARE = 1.5  # bits of a level for each key
_SAFE = SHARE * 9  # counts up to this stay within 64 bits when multiplied by SHARE
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in LOWER)


def letters(text: bytes | None) -> list[bytes]:
    """Maximal runs of letters and characters beyond ASCII; A-Z lower-cased."""
    return (text or b"").translate(_LETTERS).split()


def hashes(terms: Sequence[bytes]) -> np.ndarray:
    """XXH64 with seed 42, as ``F.xxhash64`` of a binary column."""
    return np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms))


def _mixed(hashed: np.ndarray, level: int) -> np.ndarray:
    x = hashed + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct keys, with the keys in slot order.

    Each level has a bit per place; a key that is alone in its place of a level sets the bit, the
    others go on to the next level. The slot is the number of bits set before. What is left after
    all levels (keys of equal hashes) is numbered behind in a table.
    """

    def __init__(self, sizes: list[int], bits: bytes, keys: list[bytes]):
        self.sizes, self.keys = sizes, b"".join(keys)
        self.ends = np.cumsum([0, *map(len, keys)])
        self.bit = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
        self.before = np.cumsum(self.bit, dtype=np.int32) - self.bit
        placed = int(self.bit.sum())
        self.rest = {k: placed + i for i, k in enumerate(keys[placed:])}

    @classmethod
    def parts(cls, keys: list[bytes], hashed: np.ndarray) -> tuple[list[int], bytes, list[bytes]]:
        """What the hash is made of: sizes of the levels, their bits, the keys in slot order."""
        left = np.arange(len(keys))
        sizes, bits, order = [], [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = int(SPARE * len(left)) + 8
            place = (_mixed(hashed[left], level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            stays = alone[place]
            order.append(left[stays][np.argsort(place[stays])])
            sizes.append(size)
            bits.append(alone)
            left = left[~stays]
        slots = np.concatenate([*order, left]) if order else left
        packed = np.packbits(np.concatenate(bits)) if bits else np.zeros(0, np.uint8)
        return sizes, packed.tobytes(), [keys[i] for i in slots]

    def __len__(self) -> int:
        return len(self.ends) - 1

    def slots(self, terms: list[bytes], hashed: np.ndarray) -> np.ndarray:
        """Slot of each term, -1 for terms that are no key."""
        out = np.full(len(terms), -1, dtype=np.int64)
        left, start = np.arange(len(terms)), 0
        for level, size in enumerate(self.sizes):
            at = start + (_mixed(hashed[left], level) % np.uint64(size)).astype(np.int64)
            hit = self.bit[at]
            out[left[hit]] = self.before[at[hit]]
            left, start = left[~hit], start + size
        if self.rest:
            for i in left:
                out[i] = self.rest.get(terms[i], -1)
        for i in np.flatnonzero(out >= 0):
            slot = out[i]
            if self.keys[self.ends[slot] : self.ends[slot + 1]] != terms[i]:
                out[i] = -1
        return out


def _plain(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    taken = pick(docs, lang=lang, source=source, text=text)
    return taken.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _rows(batches: Batches) -> Iterator[tuple[str, str, list[bytes]]]:
    for batch in batches:
        for part in slices(batch, 2):
            columns = part.column(0).to_pylist(), part.column(1).to_pylist(), pc.cast(part.column(2), pa.binary()).to_pylist()
            for lang, source, text in zip(*columns, strict=True):
                yield lang, source, letters(text)


def document_counts(docs: DataFrame) -> DataFrame:
    """``lang, term, n``: the documents of a language that hold the term. ``docs``: lang, source, text."""

    def batch(held: dict[str, Counter]) -> Batches:
        for lang, counts in held.items():
            terms = pa.array(list(counts), pa.binary())
            n = pa.array(list(counts.values()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), terms, n], names=["lang", "term", "n"])

    def run(batches: Batches) -> Batches:
        held: dict[str, Counter] = defaultdict(Counter)
        for i, (lang, _, terms) in enumerate(_rows(batches)):
            held[lang].update(set(terms))
            if i % 64 == 0 and sum(map(len, held.values())) > ENTRIES:
                yield from batch(held)
                held.clear()
        yield from batch(held)

    partial = docs.mapInArrow(run, "lang string, term binary, n bigint")
    return partial.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def perfect_hashes(kept: DataFrame) -> DataFrame:
    """``lang, shard, sizes, bits, keys``: one perfect hash per shard of ``kept (lang, shard, term)``."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = sorted(bytes(t) for t in rows["term"])
        sizes, bits, ordered = PerfectHash.parts(keys, hashes(keys))
        first = rows.iloc[0]
        return pd.DataFrame({"lang": [first["lang"]], "shard": [first["shard"]], "sizes": [sizes], "bits": [bits], "keys": [ordered]})

    grouped = spread(kept.select("lang", "shard", "term"), "lang", "shard").groupBy("lang", "shard")
    return grouped.applyInPandas(build, "lang string, shard int, sizes array<int>, bits binary, keys array<binary>")


def recount(docs: DataFrame, shards: list) -> DataFrame:
    """``lang, source, shard, slot, n``: occurrences of the keys of some ``shards``, summed."""
    by_lang: dict[str, dict[int, tuple]] = defaultdict(dict)
    for r in shards:
        by_lang[r["lang"]][r["shard"]] = (list(r["sizes"]), bytes(r["bits"]), [bytes(k) for k in r["keys"]], r["shards"])
    key, given = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(dict(by_lang))

    def tables() -> dict[str, tuple[int, dict[int, PerfectHash]]]:
        return {
            lang: (next(iter(own.values()))[3], {s: PerfectHash(*x[:3]) for s, x in own.items()})
            for lang, own in given.value.items()
        }

    def emit(dense: dict[tuple, np.ndarray]) -> pa.RecordBatch:
        some = [np.flatnonzero(counts) for counts in dense.values()]
        kinds = {"lang": pa.string(), "source": pa.string(), "shard": pa.int32()}
        columns = [
            *(pa.array([k[i] for k in dense], kind) for i, kind in enumerate(kinds.values())),
            pa.array(some, pa.list_(pa.int32())),
            pa.array([counts[s] for counts, s in zip(dense.values(), some, strict=True)], pa.list_(pa.int64())),
        ]
        dense.clear()
        return pa.RecordBatch.from_arrays(columns, names=[*kinds, "slots", "counts"])

    def run(batches: Batches) -> Batches:
        own = once(key, tables)
        dense: dict[tuple, np.ndarray] = {}
        held: dict[tuple, Counter] = defaultdict(Counter)

        def count_held() -> Batches:
            for (lang, source), counts in held.items():
                number, by_shard = own[lang]
                terms, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
                hashed = hashes(terms)
                shard_of = hashed.astype(np.int64) % number
                order = np.argsort(shard_of, kind="stable")
                cut = np.searchsorted(shard_of[order], np.arange(number + 1))
                for shard, table in by_shard.items():
                    some = order[cut[shard] : cut[shard + 1]]
                    slots = table.slots([terms[i] for i in some], hashed[some])
                    known = slots >= 0
                    if known.any():
                        counts_ = dense.setdefault((lang, source, shard), np.zeros(len(table), dtype=np.int64))
                        counts_[slots[known]] += n[some[known]]
                if sum(map(len, dense.values())) > SLOTS:
                    yield emit(dense)
            held.clear()

        for i, (lang, source, terms) in enumerate(_rows(batches)):
            if lang in own:
                held[lang, source].update(terms)
            if i % 64 == 0 and sum(map(len, held.values())) > ENTRIES:
                yield from count_held()
        yield from count_held()
        yield emit(dense)

    found = docs.mapInArrow(run, "lang string, source string, shard int, slots array<int>, counts array<bigint>")
    flat = found.select("lang", "source", "shard", F.explode(F.arrays_zip("slots", "counts")).alias("x"))
    flat = flat.select("lang", "source", "shard", F.col("x.slots").alias("slot"), F.col("x.counts").alias("n"))
    return flat.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))


def shares(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """Smoothed shares of a (groups, terms) matrix of counts; ``total``: of each group over all kept terms."""
    if counts.size and counts.max() > _SAFE:
        counts, total = counts.astype(object), total.astype(object)
    return (1 + SHARE * (counts + 2) // (total + 2 * kept)[:, None]).astype(np.int64)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def compare(groups: pd.DataFrame, keys: list[bytes], best: int) -> pd.DataFrame:
    """Pairs (first source, second source, sum of gaps) and best terms of each source over one shard.

    ``groups``: a row per source with ``source, total, lang_total, kept, slots, n``.
    """
    groups = groups.sort_values("source", ignore_index=True)
    counts = np.zeros((len(groups), len(keys)), dtype=np.int64)
    for i, (slots, n) in enumerate(zip(groups["slots"], groups["n"], strict=True)):
        if slots is not None and len(slots):
            counts[i, np.asarray(slots)] = np.asarray(n)
    kept = int(groups["kept"].iloc[0])
    p = shares(counts, groups["total"].to_numpy(), kept)
    q = shares(counts.sum(axis=0, keepdims=True), groups["lang_total"].to_numpy()[:1], kept)[0]
    sources, out = groups["source"].tolist(), []
    for i, source in enumerate(sources[:-1]):
        values = gap(p[i + 1 :], p[i]).sum(axis=1)
        out += [("pair", source, other.encode(), int(v)) for other, v in zip(sources[i + 1 :], values, strict=True)]
    for i, source in enumerate(sources):
        over = np.flatnonzero((counts[i] > 0) & (p[i] > q))
        values = gap(p[i, over], q[over])
        if len(over) > best:  # all that can tie with the last one
            some = values >= np.partition(values, len(over) - best)[len(over) - best]
            over, values = over[some], values[some]
        top = sorted(zip(-values, (keys[s] for s in over), strict=True))[:best]
        out += [("term", source, term, int(-v)) for v, term in top]
    return pd.DataFrame(out, columns=["part", "source", "item", "value"])


def audit(
    docs: DataFrame,
    least: int = 10,
    best: int = 10,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    cells: int = CELLS,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: the other sources by divergence, and the ``best`` over-represented terms."""
    rows = _plain(docs, lang, source, text)
    groups = settle(rows.select("lang", "source").distinct())
    kept = settle(document_counts(rows).where(F.col("n") >= least).select("lang", "term"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("groups"))
    langs = langs.join(kept.groupBy("lang").agg(F.count("*").alias("kept")), "lang", "left").fillna(0, ["kept"])
    keys = F.greatest(F.lit(LEAST_KEYS), F.lit(cells) / F.col("groups"))
    langs = settle(langs.select("lang", "kept", F.ceil(F.col("kept") / keys).cast("int").alias("shards")))

    dealt = lookup_groups(kept, langs.select("lang", "shards"), ["lang"])
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int"))
    tables = settle(lookup_groups(perfect_hashes(dealt), langs, ["lang"]))
    counted = _in_rounds(rows, tables, round_bytes)

    totals = groups.join(counted.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    totals = settle(totals.fillna(0, ["total"]))
    whole = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    grid = totals.join(whole, "lang").join(tables.select("lang", "shard", "kept"), "lang")
    lists = counted.groupBy("lang", "shard", "source").agg(F.collect_list("slot").alias("slots"), F.collect_list("n").alias("n"))
    framed = grid.join(lists, ["lang", "shard", "source"], "left")

    def of_shard(key: tuple, groups_: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        found = compare(groups_, [bytes(k) for k in table["keys"].iloc[0]], best)
        found.insert(0, "lang", key[0])
        return found

    schema = "lang string, part string, source string, item binary, value bigint"
    by_shard = spread(framed, "lang", "shard").groupBy("lang", "shard")
    own = tables.select(*[F.col(c).alias(c) for c in ("lang", "shard", "keys")])
    keys_of = spread(own, "lang", "shard").groupBy("lang", "shard")
    found = settle(by_shard.cogroup(keys_of).applyInPandas(of_shard, schema))

    pairs = found.where("part = 'pair'").withColumn("item", F.col("item").cast("string"))
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = groups.join(langs.where("kept = 0").select("lang"), "lang")
    second = bare.select("lang", F.col("source").alias("item"))
    bare = bare.join(second, "lang").where("source < item").select("lang", "source", "item", F.lit(0).cast("bigint").alias("value"))
    pairs = pairs.unionByName(bare)
    turned = pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    both = pairs.unionByName(turned).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = found.where("part = 'term'").select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = both.withColumn("rank", F.row_number().over(order))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return both.unionByName(terms)


def _in_rounds(rows: DataFrame, tables: DataFrame, round_bytes: int) -> DataFrame:
    """Occurrences by group and slot; as many tables are broadcast at once as ``round_bytes`` hold."""
    size = tables.agg(F.sum(F.aggregate("keys", F.lit(0).cast("bigint"), lambda a, k: a + F.length(k) + 8))).first()[0] or 0
    rounds = max(1, -(-size // round_bytes))
    number = F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds))
    parts = [settle(recount(rows, tables.where(number == i).collect())) for i in range(rounds)]
    counted = parts[0]
    for other in parts[1:]:
        counted = counted.unionByName(other)
    return counted

