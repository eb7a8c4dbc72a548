"""Exact and fuzzy duplicates, kept-first within blocks of one host and place.

Inside a block (equal host, equal rounded coordinates) a row is removed when an
earlier kept row matches it: equal id, equal cleaned name, or name similarity
at or above the threshold. A removed row removes nothing.

Copies are folded first: rows of a block with the same name and id share their
fate, so only one entry per (block, name, id) is compared, counted with a
map-side combine. The first ``ROUND_ROWS`` entries of a block are walked in order; what
the kept ones match is removed from the rest of the block, which is dealt into tiles.
Entries of large blocks that are still undecided then look, tile by tile and all at once,
for their first partner: the earliest entry that matches and is not removed. An entry
without one is kept; one whose first partner is kept is removed by it; one whose first
partner is removed looks on behind it; all others wait. Rounds therefore follow the longest chain
of partners, not the size of a block, no two entries are compared twice, a round
writes one row per entry, and the result is that of the row-by-row procedure.

Edit distance and term weights are compared by Spark expressions. The ratio needs Python; it is
computed only for pairs whose lengths allow the threshold and, where an entry meets many others, whose
character counts do.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.numeric import as_double, round_half_even
from plumbline.functions.skew import lookup_groups
from plumbline.functions.text import SPACE, strip
from plumbline.operators.normalize import keep_first
from plumbline.session import settle, spread

# Fixed values.
THRESHOLD = 0.50
COORDINATE_DIGITS = 4

SIGNATURE_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

ROUND_ROWS = 256
TILE_ROWS = 1_024
CHARACTER_BUCKETS = 64
FEW_PLACES = 8  # up to so many entries are compared without counting characters first
JUNK_LENGTH = 200  # from this length of the later text on the published matcher leaves out frequent characters


def compared_columns(df: DataFrame, key: str) -> list[str]:
    return [c for c in df.columns if c != key]


def row_signature(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the row's cells; nulls count as equal, as do 0.0 and -0.0.

    Timestamps keep their microseconds, also inside arrays and structs.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    cells = [(F.col(c) + 0.0).alias(c) if kinds[c] in ("float", "double") else F.col(c) for c in columns]
    return F.sha2(F.to_json(F.struct(*cells), SIGNATURE_FORMATS), 256)


def exact_duplicates(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Later copies of equal rows: ``(key, retained_key)``; the first copy is retained.

    Signatures are counted before anything is joined and only repeated ones
    come back.
    """
    signature = row_signature(df, columns or compared_columns(df, key))
    signed = df.select(F.col(key).alias("ord"), signature.alias("sig"))
    return _later_copies(signed, ["sig"]).withColumnRenamed("ord", key)


def _later_copies(rows: DataFrame, on: list[str]) -> DataFrame:
    groups = rows.groupBy(*on).agg(F.min("ord").alias("retained_key"), F.count("*").alias("copies"))
    found = lookup_groups(rows, groups.where(F.col("copies") > 1), on, how="inner")
    return found.where(F.col("ord") != F.col("retained_key")).select("ord", "retained_key")


def drop_exact_duplicates(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The first copy of every row."""
    signature = row_signature(df, columns or compared_columns(df, key))
    return keep_first(df.withColumn("__sig", signature), key, ["__sig"]).drop("__sig")


def clean_name(column: str = "name") -> Column:
    """Name as compared: lower case, trimmed, null as the text ``nan``."""
    return strip(F.lower(F.coalesce(F.col(column).cast("string"), F.lit("nan"))))


@dataclass(frozen=True)
class Columns:
    """The columns that are compared; ids and hosts may be numbers or text."""

    id: str = "id"
    name: str = "name"
    host: str = "host_id"
    latitude: str = "latitude"
    longitude: str = "longitude"


def block_columns(
    df: DataFrame, digits: int = COORDINATE_DIGITS, columns: Columns | None = None
) -> dict[str, Column]:
    """Block keys; a row with a null key is in no block."""
    columns = columns or Columns()
    return {
        "block_host": F.col(columns.host),
        "block_lat": round_half_even(as_double(df, columns.latitude), digits),
        "block_lon": round_half_even(as_double(df, columns.longitude), digits),
    }


BLOCK = ["block_host", "block_lat", "block_lon"]


def in_blocks(df: DataFrame, digits: int = COORDINATE_DIGITS, columns: Columns | None = None) -> DataFrame:
    blocked = df.withColumns(block_columns(df, digits, columns))
    return blocked.where(reduce(lambda a, b: a & b, [F.col(b).isNotNull() for b in BLOCK]))


def block_summary(df: DataFrame, columns: Columns | None = None) -> DataFrame:
    """Per block: rows, pairs the row-by-row procedure would look at, and distinct names.

    Pairs are counted, not written out.
    """
    name = clean_name((columns or Columns()).name)
    rows = in_blocks(df, columns=columns).groupBy(*BLOCK, name.alias("n")).agg(F.count("*").alias("c"))
    return (
        rows.groupBy(*BLOCK)
        .agg(F.sum("c").alias("block_rows"), F.count("*").alias("distinct_names"))
        .withColumn("candidate_pairs", F.expr("block_rows * (block_rows - 1) div 2"))
    )


def character_counts(text: str) -> np.ndarray:
    """Characters counted in a fixed number of buckets, so that common counts are never below the true ones."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.bincount(points % CHARACTER_BUCKETS, minlength=CHARACTER_BUCKETS)


def matched_characters(a: str, b: str) -> int:
    """Characters in the matching blocks of two texts, as Ratcliff and Obershelp take them.

    That is the longest common run (of equal ones the first in ``a``, then in ``b``) and what is matched on its left and on its right.
    """
    total, todo = 0, [(a, b)]
    while todo:
        a, b = todo.pop()
        at, size, length = 0, 0, len(a)
        for i in range(length):
            if i + size >= length:
                break
            if a[i : i + size + 1] in b:
                at, size, most = i, size + 1, length - i
                while size < most:  # a run is in ``b`` if a longer one from the same place is
                    middle = (size + most + 1) // 2
                    if a[i : i + middle] in b:
                        size = middle
                    else:
                        most = middle - 1
        if size:
            total += size
            place = b.index(a[at : at + size])
            if at and place:
                todo.append((a[:at], b[:place]))
            if at + size < length and place + size < len(b):
                todo.append((a[at + size :], b[place + size :]))
    return total


def ratio(a: str, b: str) -> float:
    """``SequenceMatcher(None, a, b).ratio()``; short texts are searched as strings instead of character by character."""
    if len(b) >= JUNK_LENGTH:
        return SequenceMatcher(None, a, b).ratio()
    return 2.0 * matched_characters(a, b) / (len(a) + len(b)) if a or b else 1.0


class Pool:
    """Entries in order, searched for the first one that an entry matches.

    Equal ids and names come from tables. The Ratcliff/Obershelp ratio of an earlier and a later text
    is twice the matched characters over all characters, at most ``2 * common / (length + length)``; it is
    computed only where that reaches the threshold. Among a few entries only the lengths bound what is common.
    """

    def __init__(self, threshold: float, fuzzy: bool):
        self.threshold, self.fuzzy, self.computed, self.counted = threshold, fuzzy, 0, 0
        self.ords: list[int] = []
        self.texts: list[str] = []
        self.by_id: dict[str, list[int]] = {}
        self.by_name: dict[str, list[int]] = {}
        self.counts = np.zeros((0, CHARACTER_BUCKETS), dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)

    def add(self, entry) -> None:
        at = len(self.ords)
        self.ords.append(entry["ord"])
        self.texts.append(entry["text"])
        if entry["id"] is not None:
            self.by_id.setdefault(entry["id"], []).append(at)
        self.by_name.setdefault(entry["cname"], []).append(at)

    def _count(self) -> None:
        """Count the characters of the entries added since the last call."""
        total = len(self.texts)
        if total > len(self.lengths):
            more = 2 * total - len(self.lengths)
            self.counts, self.lengths = (np.concatenate([x, np.zeros((more, *x.shape[1:]), x.dtype)]) for x in (self.counts, self.lengths))
        for at in range(self.counted, total):
            self.counts[at], self.lengths[at] = character_counts(self.texts[at]), len(self.texts[at])
        self.counted = total

    def _possible(self, text: str, start: int, stop: int) -> Iterable[int]:
        """Those of the entries ``start`` to ``stop`` whose ratio to ``text`` may reach the threshold."""
        if stop - start <= FEW_PLACES:
            for i in range(start, stop):
                both = len(self.texts[i]) + len(text)
                if not both or 2.0 * min(len(self.texts[i]), len(text)) / both >= self.threshold:
                    yield i
            return
        self._count()
        common = np.minimum(self.counts[start:stop], character_counts(text)).sum(axis=1)
        both = self.lengths[start:stop] + len(text)
        yield from start + np.flatnonzero((2.0 * common / np.maximum(both, 1) >= self.threshold) | (both == 0))

    def first(self, entry, start: int, stop: int) -> dict | None:
        """The first of the entries ``start`` to ``stop`` that matches."""
        equal = stop
        for places in (self.by_name.get(entry["cname"]), self.by_id.get(entry["id"]) if entry["id"] is not None else None):
            if places and (i := bisect_left(places, start)) < len(places):
                equal = min(equal, places[i])
        if self.fuzzy:
            for i in self._possible(entry["text"], start, equal):
                self.computed += 1
                if (found := ratio(self.texts[i], entry["text"])) >= self.threshold:
                    return {"ord": entry["ord"], "kept_ord": self.ords[i], "kind": "fuzzy", "similarity": found}
        return {"ord": entry["ord"], "kept_ord": self.ords[equal], "kind": "exact", "similarity": None} if equal < stop else None


VERDICT = "ord bigint, kept_ord bigint, kind string, similarity double"


def _open(entry) -> dict:
    return {"ord": entry["ord"], "kept_ord": None, "kind": None, "similarity": None}


@dataclass(frozen=True)
class Comparison:
    """How entries are compared, on arrays of entries in order.

    ``walk(entries)`` gives the verdict of the row-by-row procedure for each; ``scan(pool, entries)`` the first entry
    of the pool that each entry matches, among those before it and behind its ``after``.
    """

    walk: Callable[[str], Column]
    scan: Callable[[str, str], Column]


VERDICT_TYPE = pa.struct(
    [("ord", pa.int64()), ("kept_ord", pa.int64()), ("kind", pa.string()), ("similarity", pa.float64())]
)


def _lists(arrays: pa.ListArray) -> list[list[dict]]:
    """The entries of each array; a whole batch is taken apart column by column."""
    flat = arrays.flatten()
    names = [field.name for field in flat.type]
    # Numpy takes text and whole numbers apart faster; whole numbers beside a null would become floats there.
    cells = [c.to_pylist() if c.null_count and pa.types.is_integer(c.type) else c.to_numpy(zero_copy_only=False).tolist() for c in flat.flatten()]
    entries = [dict(zip(names, e, strict=True)) for e in zip(*cells, strict=True)]
    ends = np.cumsum([0, *arrays.value_lengths().to_pylist()]).tolist()
    return [entries[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _arrays(verdicts: list[list[dict]]) -> pa.ListArray:
    ends = np.cumsum([0, *[len(v) for v in verdicts]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([e for v in verdicts for e in v], VERDICT_TYPE))


def ratio_comparison(threshold: float, fuzzy: bool = True) -> Comparison:
    @F.arrow_udf(f"array<struct<{VERDICT}>>")
    def walk(blocks: pa.Array) -> pa.Array:
        def one(entries):
            pool, out = Pool(threshold, fuzzy), []
            for e in entries:
                found = pool.first(e, 0, len(pool.ords))
                if found is None:
                    pool.add(e)
                out.append(found or _open(e))
            return out

        return _arrays([one(entries) for entries in _lists(blocks)])

    @F.arrow_udf(f"array<struct<{VERDICT}>>")
    def scan(pools: pa.Array, tiles: pa.Array) -> pa.Array:
        def one(earlier, entries):
            pool = Pool(threshold, fuzzy)
            for e in earlier:
                pool.add(e)
            return [
                pool.first(e, bisect_right(pool.ords, e["after"]), bisect_left(pool.ords, e["ord"])) or _open(e) for e in entries
            ]

        return _arrays([one(a, b) for a, b in zip(_lists(pools), _lists(tiles), strict=True)])

    return Comparison(walk, scan)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def expression_comparison(similarity: Callable[[Column, Column], Column], threshold: float) -> Comparison:
    """Comparison by Spark expressions; ``similarity`` of an earlier and a later text."""

    def matches(k: Column, e: Column) -> Column:
        equal = (k["cname"] == e["cname"]) | F.coalesce(k["id"] == e["id"], F.lit(False))
        return equal | (similarity(k["text"], e["text"]) >= threshold)

    def verdict(k: Column, e: Column) -> Column:
        equal = (k["cname"] == e["cname"]) | F.coalesce(k["id"] == e["id"], F.lit(False))
        return F.struct(
            e["ord"].alias("ord"),
            k["ord"].alias("kept_ord"),
            F.when(k["ord"].isNotNull(), F.when(equal, F.lit("exact")).otherwise(F.lit("fuzzy"))).alias("kind"),
            F.when(~equal, similarity(k["text"], e["text"])).alias("similarity"),
        )

    def walk(entries: str) -> Column:
        def step(state: Column, e: Column) -> Column:
            return _once(
                F.get(F.filter(state["kept"], lambda k: matches(k, e)), F.lit(0)),
                lambda found: F.struct(
                    F.when(found.isNull(), F.array_append(state["kept"], e)).otherwise(state["kept"]).alias("kept"),
                    F.array_append(state["found"], verdict(found, e)).alias("found"),
                ),
            )

        start = F.struct(F.slice(entries, 1, 0).alias("kept"), F.array().cast(f"array<struct<{VERDICT}>>").alias("found"))
        return F.aggregate(entries, start, step, lambda state: state["found"])

    def scan(pool: str, entries: str) -> Column:
        def first(e: Column) -> Column:
            inside = F.filter(pool, lambda k: (k["ord"] < e["ord"]) & (k["ord"] > e["after"]) & matches(k, e))
            return _once(F.get(inside, F.lit(0)), lambda k: verdict(k, e))

        return F.transform(entries, first)

    return Comparison(walk, scan)


def edit_similarity(a: Column, b: Column) -> Column:
    """``1 - edit distance / longer length``."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Dot product of unit-length term weights, each an array of (term, w)."""

    def other(term: Column) -> Column:
        return F.coalesce(F.get(F.filter(b, lambda t: t["term"] == term), F.lit(0))["w"], F.lit(0.0))

    return F.aggregate(a, F.lit(0.0), lambda total, t: total + t["w"] * other(t["term"]))


def comparison(method: str, threshold: float) -> Comparison:
    """``ratio``, ``levenshtein``, ``tfidf``, or ``exact`` for equal ids and names only."""
    if method == "levenshtein":
        return expression_comparison(edit_similarity, threshold)
    if method == "tfidf":
        return expression_comparison(cosine_similarity, threshold)
    if method == "exact":
        return expression_comparison(lambda a, b: F.lit(-1.0), 0.0)
    if method == "ratio":
        return ratio_comparison(threshold)
    raise ValueError(f"unknown method {method!r}")


def name_weights(df: DataFrame, name: Column) -> DataFrame:
    """Unit-length TF-IDF weights per distinct name: ``(cname, weights)``.

    Smoothed inverse document frequency over the distinct names; terms are
    counted and joined by key, nothing is collected.
    """
    names = df.select(name.alias("cname")).distinct()
    total = names.agg(F.count("*")).scalar()
    terms = (
        names.select("cname", F.explode(F.split("cname", f"{SPACE}+")).alias("term"))
        .groupBy("cname", "term")
        .agg(F.count("*").alias("tf"))
    )
    idf = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = idf.select("term", (F.log((1 + total) / (1 + F.col("df"))) + 1).alias("idf"))
    weighted = lookup_groups(terms, idf, ["term"], how="inner")
    weighted = weighted.withColumn("w", F.col("tf") * F.col("idf"))
    # One name's own terms only.
    packed = weighted.groupBy("cname").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.collect_list(F.struct("term", "w")).alias("t")
    )
    unit = F.transform("t", lambda e: F.struct(e["term"].alias("term"), (e["w"] / F.col("norm")).alias("w")))
    return packed.select("cname", F.sort_array(unit).alias("weights"))


# Ids and hosts travel as text: exact in pandas, also beside nulls.
BASE = [*BLOCK, "ord", "id", "cname", "text"]
BEFORE_ALL = -(1 << 63)


def _tiles(entries: DataFrame, sizes: DataFrame, name: str, tiles: str, counted: int, *more: str) -> DataFrame:
    """Entries of a block as ``tiles`` arrays in order, numbered ``name``; about ``TILE_ROWS`` entries in each."""
    dealt = lookup_groups(entries, sizes.select(*BLOCK, tiles), BLOCK, "inner", counted)
    dealt = dealt.withColumn(name, F.pmod(F.xxhash64("ord"), F.col(tiles)).cast("int"))
    rows = F.sort_array(F.collect_list(F.struct("ord", "id", "cname", "text", *more)))
    return dealt.groupBy(*BLOCK, name).agg(rows.alias(f"{name}_rows"))


def _scanned(pool: DataFrame, entries: DataFrame, compare: Comparison) -> DataFrame:
    """First match of each entry in the pool of its block: ``*BLOCK, ord, kept_ord, kind, similarity``, entries without one left out.

    Pool and entries are dealt into tiles; every two tiles of a block meet in a row of their own, so a large block is spread
    over all tasks and a row holds two tiles at most.
    """
    count = F.ceil(F.count("*") / TILE_ROWS).cast("int")
    sizes = entries.groupBy(*BLOCK).agg(count.alias("tiles_b"))
    sizes = settle(sizes.join(pool.groupBy(*BLOCK).agg(count.alias("tiles_a")), BLOCK))
    counted = sizes.count()
    spans = {side: sizes.select(*BLOCK, side) for side in ("tiles_a", "tiles_b")}
    left = lookup_groups(_tiles(pool, sizes, "a", "tiles_a", counted), spans["tiles_b"], BLOCK, "inner", counted)
    left = left.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("tiles_b") - 1)))
    right = lookup_groups(_tiles(entries, sizes, "b", "tiles_b", counted, "after"), spans["tiles_a"], BLOCK, "inner", counted)
    right = right.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("tiles_a") - 1)))
    met = spread(left.select(*BLOCK, "a", "b", "a_rows"), *BLOCK, "a", "b").join(
        spread(right.select(*BLOCK, "a", "b", "b_rows"), *BLOCK, "a", "b"), [*BLOCK, "a", "b"]
    )
    found = met.select(*BLOCK, F.inline(compare.scan("a_rows", "b_rows"))).where("kept_ord IS NOT NULL")
    best = F.min(F.struct("kept_ord", "kind", "similarity")).alias("best")
    return found.groupBy(*BLOCK, "ord").agg(best).select(*BLOCK, "ord", "best.*")


def _settled(state: DataFrame) -> DataFrame:
    """Settled by way of the cache, whose sizes are measured: estimates of joins in a loop multiply without end."""
    cached = state.persist()
    cached.count()
    out = settle(cached)
    cached.unpersist()
    return out


def _states(state: DataFrame) -> dict[str, int]:
    return {"open": 0, "behind": 0} | {r["state"]: r["count"] for r in state.groupBy("state").count().collect()}


def _by_partners(undecided: DataFrame, compare: Comparison) -> DataFrame:
    """Verdicts of entries among themselves: ``*BLOCK, ord, kept_ord, kind, similarity`` of the removed ones."""
    pending = undecided.withColumn("after", F.lit(BEFORE_ALL))
    waiting, alive = None, undecided
    while True:
        found = pending.select(*BASE).join(_scanned(alive, pending, compare), [*BLOCK, "ord"], "left")
        found = found.withColumn("state", F.when(F.col("kept_ord").isNull(), F.lit("kept")).otherwise(F.lit("open")))
        state = _settled(found if waiting is None else waiting.unionByName(found))
        counts = _states(state)
        while counts["open"]:
            partner = state.select(*[F.col(b).alias(f"p_{b}") for b in BLOCK], F.col("ord").alias("p_ord"), F.col("state").alias("p_state"))
            same = reduce(lambda a, b: a & b, [F.col(b) == F.col(f"p_{b}") for b in BLOCK])
            joined = state.join(partner, same & (F.col("kept_ord") == F.col("p_ord")) & (F.col("state") == "open"), "left")
            turned = F.when(F.col("p_state") == "kept", "removed").when(F.col("p_state") == "removed", "behind")
            state = _settled(joined.withColumn("state", F.coalesce(turned, "state")).select(*state.columns))
            before, counts = counts, _states(state)
            if counts["open"] == before["open"]:
                break  # what is open waits for entries that look on
        if not counts["behind"]:
            return state.where("state = 'removed'").select(*BLOCK, "ord", "kept_ord", "kind", "similarity")
        waiting = state.where("state <> 'behind'")
        pending = state.where("state = 'behind'").select(*BASE, F.col("kept_ord").alias("after"))
        alive = state.where("state <> 'removed'").select(*BASE)


def resolve_entries(entries: DataFrame, threshold: float, method: str = "ratio") -> DataFrame:
    """The removed entries: by which kept entry, exact or fuzzy, with which similarity.

    ``entries`` has the :data:`BASE` columns; ``text`` is what the similarity compares. One row per (block, name, id).
    """
    compare = comparison(method, threshold)
    entries = entries.select(*BASE)
    # The rank filter becomes a group limit in every task before the shuffle, so a block is at most ROUND_ROWS
    # entries here; a block with a single entry has nothing to compare.
    first = Window.partitionBy(*BLOCK).orderBy("ord")
    front = entries.withColumn("__rn", F.row_number().over(first)).where(F.col("__rn") <= ROUND_ROWS)
    blocks = front.groupBy(*BLOCK).agg(F.sort_array(F.collect_list(F.struct("ord", "id", "cname", "text"))).alias("e"))
    walked = spread(blocks.where(F.size("e") > 1), *BLOCK).withColumn("v", compare.walk("e"))
    pairs = walked.select(*BLOCK, F.size("e").alias("entries"), F.inline(F.arrays_zip("e", "v")))
    settled = settle(pairs.select(*BLOCK, "entries", "e.*", "v.kept_ord", "v.kind", "v.similarity"))
    verdict = ["ord", "kept_ord", "kind", "similarity"]
    removed = [settled.where("kept_ord IS NOT NULL").select(*verdict)]
    # The last entry of a full front tells where the rest of its block begins.
    full = settled.where(F.col("entries") == ROUND_ROWS).groupBy(*BLOCK).agg(F.max("ord").alias("__last"))
    large = full.count()
    if large:
        rest = lookup_groups(entries, full, BLOCK, "inner", large)
        rest = settle(rest.where(F.col("ord") > F.col("__last")).select(*BASE))
        leaders = settled.where((F.col("entries") == ROUND_ROWS) & F.col("kept_ord").isNull()).select(*BASE)
        swept = settle(_scanned(leaders, rest.withColumn("after", F.lit(BEFORE_ALL)), compare))
        removed.append(swept.select(*verdict))
        undecided = settle(rest.join(swept.select(*BLOCK, "ord"), [*BLOCK, "ord"], "left_anti"))
        if not undecided.isEmpty():
            removed.append(_by_partners(undecided, compare).select(*verdict))
    return reduce(DataFrame.unionByName, removed)


def _signature_holds_entry(df: DataFrame, key: str, columns: Columns) -> bool:
    """Whether rows of equal signature share block, id and name.

    Not so where the key is one of these columns, which no signature holds, nor where -0.0, equal to 0.0 there, becomes text.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    named = [columns.id, columns.name, columns.host]
    return key not in [*named, columns.latitude, columns.longitude] and not any(kinds[c] in ("float", "double") for c in named)


def duplicate_log(
    df: DataFrame,
    key: str,
    threshold: float = THRESHOLD,
    method: str = "ratio",
    digits: int = COORDINATE_DIGITS,
    columns: Columns | None = None,
) -> DataFrame:
    """One row per removed row: how, by which row, with which similarity.

    ``method`` is ``ratio`` (default), ``levenshtein``, ``tfidf``, or ``exact``
    for equal ids and names only. The wide rows are read once, into a slim
    table of signature, block, id and name.
    """
    columns = columns or Columns()
    slim = settle(
        df.select(
            F.col(key).cast("bigint").alias("ord"),
            F.unhex(row_signature(df, compared_columns(df, key))).alias("sig"),
            *[
                c.cast(t).alias(b)
                for (b, c), t in zip(block_columns(df, digits, columns).items(), ("string", "double", "double"), strict=True)
            ],
            F.col(columns.id).cast("string").alias("id"),
            clean_name(columns.name).alias("cname"),
        )
    )
    same = [*BLOCK, "id", "cname"]
    in_block = reduce(lambda a, b: a & b, [F.col(b).isNotNull() for b in BLOCK])
    # Rows of a block with the same name and id share an entry, whose key is the smallest; nulls count as equal here.
    shared = settle(slim.groupBy(*same).agg(F.min("ord").alias("ord"), F.count("*").alias("rows")))
    entries = shared.where(in_block).select(*same, "ord")
    if method == "tfidf":
        weights = name_weights(entries.select("cname"), F.col("cname"))
        entries = entries.join(weights.withColumnRenamed("weights", "text"), "cname")
    else:
        entries = entries.withColumn("text", F.col("cname"))
    gone = resolve_entries(entries, threshold, method)

    # Only rows that share their entry can be copies of each other, or be folded behind another one.
    several = shared.where("rows > 1").select(*same, F.col("ord").alias("entry"))
    crowded = settle(lookup_groups(slim, several, same, "inner"))
    # Rows folded behind an entry fall to the entry itself when it is kept,
    # else to whatever removed the entry. Copies of a row are folded once, with the first of them.
    unique = crowded.where(in_block).groupBy("sig", *same, "entry").agg(F.min("ord").alias("ord"))
    behind = unique.where(F.col("ord") != F.col("entry")).select("ord", "entry")
    fate = gone.withColumnRenamed("ord", "__entry")
    folded = behind.join(fate, F.col("entry") == F.col("__entry"), "left").select(
        F.col("ord").alias("removed_key"),
        F.coalesce("kept_ord", "entry").alias("retained_key"),
        F.coalesce("kind", F.lit("exact")).alias("kind"),
        "similarity",
    )
    signed = crowded if _signature_holds_entry(df, key, columns) else slim
    copies = _later_copies(signed.select("ord", "sig"), ["sig"]).select(
        F.col("ord").alias("removed_key"),
        "retained_key",
        F.lit("exact_full_row").alias("kind"),
        F.lit(1.0).alias("similarity"),
    )
    direct = gone.select(F.col("ord").alias("removed_key"), F.col("kept_ord").alias("retained_key"), "kind", "similarity")
    return copies.unionByName(direct).unionByName(folded)


def deduplicate(
    df: DataFrame, key: str, threshold: float = THRESHOLD, method: str = "ratio", columns: Columns | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that stay, and the log of the removed ones."""
    log = settle(duplicate_log(df, key, threshold, method, columns=columns))
    removed = log.select(F.col("removed_key").alias(key))
    return df.join(removed, key, "left_anti"), log


def describe_log(log: DataFrame, df: DataFrame, key: str, columns: Columns | None = None) -> DataFrame:
    """The log with ids, names and place of both rows; joined by unique keys."""
    columns = columns or Columns()
    removed = df.select(
        F.col(key).alias("__k"),
        F.col(columns.id).alias("removed_id"),
        F.col(columns.name).alias("removed_name"),
        columns.host,
        columns.latitude,
        columns.longitude,
    )
    retained = df.select(
        F.col(key).alias("__r"), F.col(columns.id).alias("retained_id"), F.col(columns.name).alias("retained_name")
    )
    return (
        log.join(removed, F.col("removed_key") == F.col("__k"))
        .join(retained, F.col("retained_key") == F.col("__r"))
        .drop("__k", "__r")
    )


def duplicate_counts(log: DataFrame, before: DataFrame) -> DataFrame:
    """One row: rows before and after, exact and fuzzy removals."""
    counts = log.agg(
        F.count_if(F.col("kind") != "fuzzy").alias("exact_duplicates"),
        F.count_if(F.col("kind") == "fuzzy").alias("fuzzy_duplicates"),
        F.count("*").alias("total_removed"),
    )
    rows = before.agg(F.count("*")).scalar()
    return counts.select(
        rows.alias("rows_before"),
        (rows - F.col("total_removed")).alias("rows_after"),
        "exact_duplicates",
        "fuzzy_duplicates",
        "total_removed",
    )
