"""Ranked lexical search: the best documents for every item, by groups of equal presence masks.

Scores are integers. A term's weight falls with the share of documents that hold it; a term adds
its weight times a factor that rises with its occurrences and falls with the document's length (see
``Scale``). Each item ranks all documents.

Pass 1 reads the texts once. A task leaves a posting row per document with any term of the items
(term numbers and occurrences), and one row of its own counts: documents, terms, documents by term.

Pass 2 reads the postings. A block of documents becomes a bitmap per term. For each item the bitmaps
of its terms, packed across, give every document its presence mask; documents of one mask
form a group. A group's maximum score is the sum of its terms' largest contributions in the block. Groups
are evaluated from the highest maximum down, until the item's k-th best score so far in the task
is above the next maximum: no document left can come in, nor tie. A task hands on k rows per item at
most, which are then ranked in two steps, so no task sees more than its share of them.

Items are dealt into blocks of about ``TERMS`` (item, term) pairs, each with both passes of its own, so
what is broadcast and kept per task is bounded however many items there are.

Null and empty texts have no terms and appear in no result; an item without terms has no rows, and an
empty table gives none. Rows that repeat an item id are one item with the terms of all of them (null is
an id like any other). Documents that repeat an id are ranked one by one; equal scores go by ascending id, null
ids last. Very long texts are read whole. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from plumbline.llm.common import LOWER, Batches, pick, slices
from plumbline.session import settle

TERMS = 200_000  # (item, term) pairs of a block of items
BLOCK_CELLS = 4_000_000  # terms times documents held as bitmaps and factors at once
SALTS = 64
_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in LOWER)


def words(text: bytes | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII; A-Z lower-cased."""
    return (text or b"").translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Scale:
    """Corpus counts that scores depend on."""

    documents: int  # with a term at least
    terms: int  # of all documents, with repeats

    def weight(self, holding: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * holding + 1)))

    def length(self, n: np.ndarray) -> np.ndarray:
        """A document's length against the mean, 100 for the mean one; ``n``: its terms."""
        return 50 + 50 * n * self.documents // self.terms

    @staticmethod
    def factor(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 20 * length)


@dataclass(frozen=True)
class Wanted:
    """A block of items: ids, and the numbers of each item's terms with their weights."""

    items: list
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    vocabulary: int


class Best:
    """The k best documents of an item so far: by score, then by id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, dtype=np.int64)
        self.doc = np.zeros(0, dtype=np.int64)
        self.null = np.zeros(0, dtype=bool)

    @property
    def floor(self) -> int:
        """What a score must reach to come in."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = (np.concatenate(x) for x in ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[: self.k]
        order = order[score[order] > 0]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


def masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of equal columns of a (terms, documents) bitmap: one document of each, and every document's group."""
    packed = np.packbits(present, axis=0)
    wide = np.zeros((present.shape[1], -(-len(packed) // 8) * 8), dtype=np.uint8)
    wide[:, : len(packed)] = packed.T
    keys = wide.view(np.uint64)
    if keys.shape[1] == 1:
        _, first, group = np.unique(keys[:, 0], return_index=True, return_inverse=True)
    else:
        _, first, group = np.unique(keys.view(f"V{8 * keys.shape[1]}")[:, 0], return_index=True, return_inverse=True)
    return first, group


def evaluate(best: Best, weights: np.ndarray, present: np.ndarray, factors: np.ndarray, doc: np.ndarray, null: np.ndarray) -> int:
    """Adds the documents of a block to ``best``; gives the number of documents that were scored."""
    first, group = masks(present)
    most = (weights * factors.max(axis=1, initial=0)) @ present[:, first]
    order = np.argsort(-most, kind="stable")
    members = np.argsort(group, kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=len(first)))
    at, scored = 0, 0
    while at < len(order) and most[order[at]] >= best.floor:
        some, held = [], 0
        while at < len(order) and held < best.k and most[order[at]] >= best.floor:
            g = order[at]
            some.append(members[ends[g - 1] if g else 0 : ends[g]])
            held += len(some[-1])
            at += 1
        rows = np.concatenate(some)
        scored += held
        best.add(weights @ factors[:, rows], doc[rows], null[rows])
    return scored


def _postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of documents with any wanted term, and one row of counts per task."""
    given = docs.sparkSession.sparkContext.broadcast(numbers)
    known = docs.schema["doc_id"].dataType.simpleString()
    names = ["counts", "doc_id", "docs", "n", "terms", "tfs"]

    def rows(counts: bool, ids: pa.Array, docs_: list[int], n: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(t) for t, _ in found], dtype=np.int64)]), pa.int32())
        lists = [
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0), *x]).astype(kind)))
            for x, kind in (([t for t, _ in found], np.int32), ([f for _, f in found], np.int64))
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([counts] * len(found), pa.bool_()), ids, pa.array(docs_, pa.int64()), pa.array(n, pa.int64()), *lists], names=names
        )

    def run(batches: Batches) -> Batches:
        number, kind = given.value, pa.null()
        holding = np.zeros(len(number), dtype=np.int64)
        documents = terms = 0
        for batch in batches:
            kind = batch.column(0).type
            for part in slices(batch, 1):
                who, sizes, found = [], [], []
                for i, text in enumerate(pc.cast(part.column(1), pa.binary()).to_pylist()):
                    all_words = words(text)
                    documents += bool(all_words)
                    terms += len(all_words)
                    tf = Counter(all_words)
                    if wanted := tf.keys() & number.keys():
                        own = np.fromiter((number[w] for w in wanted), np.int64, len(wanted))
                        holding[own] += 1
                        who.append(i)
                        sizes.append(len(all_words))
                        found.append((own, np.fromiter((tf[w] for w in wanted), np.int64, len(wanted))))
                yield rows(False, part.column(0).take(pa.array(who, pa.int64())), [1] * len(who), sizes, found)
        if documents:
            own = np.flatnonzero(holding)
            yield rows(True, pa.nulls(1, kind), [documents], [terms], [(own, holding[own])])

    return docs.mapInArrow(run, f"counts boolean, doc_id {known}, docs bigint, n bigint, terms array<int>, tfs array<bigint>")


def _candidates(postings: DataFrame, wanted: Wanted, scale: Scale, k: int, item_type: str, item_arrow: pa.DataType) -> DataFrame:
    """Per task the k best documents of every item: ``item_id, doc_id, score``."""
    given = postings.sparkSession.sparkContext.broadcast(wanted)
    block = max(16, min(8192, BLOCK_CELLS // max(1, wanted.vocabulary)))

    def run(batches: Batches) -> Batches:
        want = given.value
        best = [Best(k) for _ in want.items]
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                null = part.column(0).is_null().to_numpy(zero_copy_only=False)
                doc = pc.fill_null(pc.cast(part.column(0), pa.int64()), 0).to_numpy(zero_copy_only=False)
                length = scale.length(part.column(1).to_numpy(zero_copy_only=False))
                term, tf = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                at = np.repeat(np.arange(len(doc)), pc.list_value_length(part.column(2)).to_numpy())
                present = np.zeros((want.vocabulary, len(doc)), dtype=bool)
                factors = np.zeros((want.vocabulary, len(doc)), dtype=np.int64)
                present[term, at] = True
                factors[term, at] = scale.factor(tf, length[at])
                for own, terms, weights in zip(best, want.terms, want.weights, strict=True):
                    evaluate(own, weights, present[terms], factors[terms], doc, null)
        for item, own in zip(want.items, best, strict=True):
            if len(own.score):
                ids = pa.array(own.doc, mask=own.null)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(ids), item_arrow), ids, pa.array(own.score)], names=["item_id", "doc_id", "score"]
                )

    return postings.select("doc_id", "n", "terms", "tfs").mapInArrow(run, f"item_id {item_type}, doc_id bigint, score bigint")


def _blocks(terms: DataFrame, limit: int) -> Iterator[list]:
    """(item_id, term) rows, one block of items after the other."""
    blocks = max(1, -(-terms.count() // limit))
    for b in range(blocks):
        yield terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct ``item_id, term`` (binary)."""
    taken = pick(items, item_id=item_id, text=text)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [sorted(set(words(t))) for t in pc.cast(batch.column(1), pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    lists = taken.mapInArrow(run, f"item_id {taken.schema['item_id'].dataType.simpleString()}, terms array<binary>")
    return lists.select("item_id", F.explode("terms").alias("term")).distinct()


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item, all if fewer score above 0."""
    taken = pick(docs, doc_id=doc_id, text=text)
    wanted_terms = settle(item_terms(items, item_id, item_text))
    item_type = wanted_terms.schema["item_id"].dataType.simpleString()
    parts = [
        _of_block(taken, rows, k, item_type, _arrow_type(items, item_id)) for rows in _blocks(wanted_terms, block_terms)
    ]
    best = parts[0]
    for other in parts[1:]:
        best = best.unionByName(other)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    near = Window.partitionBy("item_id", "salt").orderBy(*order)
    best = best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    best = best.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k).drop("rank", "salt")
    last = Window.partitionBy("item_id").orderBy(*order)
    return best.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _of_block(docs: DataFrame, rows: Sequence, k: int, item_type: str, item_arrow: pa.DataType) -> DataFrame:
    numbers = {term: i for i, term in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    by_item: dict = {}
    for r in rows:
        by_item.setdefault(r["item_id"], []).append(numbers[bytes(r["term"])])
    found = settle(_postings(docs, numbers))
    counts = found.where("counts")
    total = counts.agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).first()
    scale = Scale(total["docs"] or 0, total["n"] or 0)
    pairs = counts.select(F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("x.*")
    holding = {r["terms"]: r["n"] for r in pairs.groupBy("terms").agg(F.sum("tfs").alias("n")).collect()}  # one row per term
    terms = [np.array(t, dtype=np.int64) for t in by_item.values()]
    weights = [np.array([scale.weight(holding.get(int(i), 0)) for i in t], dtype=np.int64) for t in terms]
    wanted = Wanted(list(by_item), terms, weights, len(numbers))
    return _candidates(found.where("NOT counts"), wanted, scale, k, item_type, item_arrow)


def _arrow_type(items: DataFrame, item_id: str) -> pa.DataType:
    return to_arrow_type(pick(items, item_id=item_id).schema["item_id"].dataType)
