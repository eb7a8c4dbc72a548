"""Best-fit decreasing packing of token sequences, exact over any number of documents.

A document's ids and an end id make one piece, or several of at most ``capacity`` tokens: only
longer documents are cut, the first piece takes the remainder. Pieces are placed longest first,
each into the open sequence with the least room that still holds it; a segment tree over the
remaining capacities finds it in logarithmic time. No sequence is opened while an open one fits.

Pieces of one length are alike, and best fit puts a piece into the sequence that it has just used as
long as there is room. So the whole run over all pieces follows from how many there are of each
length (at most ``capacity`` numbers): the driver places runs of equal pieces into runs of equal
sequences, whatever their number. The plan is a list of blocks; a piece finds its own by its rank among the
pieces of its length. Ranks are running numbers inside a task plus an offset per (task, length), so
no length is ranked in one place and no text or id moves.

Where ids come from: texts of characters below U+0250 are encoded by tiktoken with the ranks of the
same vocabulary, which is several times faster; these characters are split alike by both libraries (tested one
by one). All other texts go through tokenizers itself. Special strings inside texts get their ids, as is
the default of tokenizers.

Null and empty texts have no ids and one piece of the end id alone. Null ids are kept as they are;
repeated rows are packed as often as they occur. An empty table gives no pieces. Very long texts are
encoded in parts, cut before a space behind another character, where no match of the pattern
can cross. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import defaultdict, deque
from collections.abc import Mapping
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm.bytebpe import load_ranks
from plumbline.llm.common import Batches, once, pick, slices
from plumbline.session import settle

LONG_TEXT = 200_000  # characters encoded at once
_ALIKE = re.compile("[\\x00-ɏ]*")
_CUT = re.compile(r"\S ")


class Encoder:
    """Ids of a text as ``tokenizers`` gives them without added special tokens."""

    def __init__(self, vocabulary: str, ranks: Mapping[bytes, int], pattern: str):
        self.library = Tokenizer.from_str(vocabulary)
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=dict(ranks), special_tokens=special)

    def __call__(self, text: str | None) -> np.ndarray:
        parts = [self.part(p) for p in long_parts(text or "")]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def part(self, text: str) -> np.ndarray:
        if _ALIKE.fullmatch(text):
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # its pattern engine gives up on blanks by the hundred thousand
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def long_parts(text: str, limit: int = LONG_TEXT) -> list[str]:
    """``text`` in parts of about ``limit`` characters whose ids do not depend on each other."""
    parts, start = [], 0
    while len(text) - start > limit and (cut := _CUT.search(text, start + limit)):
        parts.append(text[start : cut.start() + 1])
        start = cut.start() + 1
    return [*parts, text[start:]]


def cuts(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: the first holds the remainder, all others are full."""
    first = (tokens - 1) % capacity + 1
    return [(0, first), *((start, capacity) for start in range(first, tokens, capacity))]


class Rooms:
    """Segment tree over remaining capacities: how many open sequences have each."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.bins = [0] * (2 * self.leaves)

    def add(self, room: int, bins: int) -> None:
        node = self.leaves + room
        while node:
            self.bins[node] += bins
            node >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of an open sequence that is at least ``least``."""
        node = self.leaves + least
        while not self.bins[node]:
            while node % 2:  # a right child: what lies right of it hangs on an ancestor
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node + (not self.bins[2 * node])
        return node - self.leaves


@dataclass(frozen=True)
class Block:
    """Pieces of one length, ``first`` to ``end`` (exclusive) by rank: ``each`` of them side by side in every sequence from ``sequence`` on."""

    length: int
    first: int
    end: int
    each: int
    sequence: int
    offset: int


def plan(counts: Mapping[int, int], capacity: int) -> list[Block]:
    """Best-fit decreasing over ``counts[length]`` pieces of each length."""
    tree, runs = Rooms(capacity), defaultdict(deque)  # by room: (first sequence, how many)
    blocks: list[Block] = []
    opened = 0

    def leave(room: int, sequence: int, bins: int) -> None:
        if room and bins:
            runs[room].append((sequence, bins))
            tree.add(room, bins)

    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                sequence, bins = opened, -(-(total - done) // (room // length))
                opened += bins
            else:
                sequence, bins = runs[room].popleft()
                tree.add(room, -bins)
            each, offset = room // length, capacity - room
            full = min(bins, (total - done) // each)
            if full:
                blocks.append(Block(length, done, done + full * each, each, sequence, offset))
                leave(room - each * length, sequence, full)
                done += full * each
            if full < bins and (rest := total - done):  # fewer than fill one more sequence
                blocks.append(Block(length, done, total, rest, sequence + full, offset))
                leave(room - rest * length, sequence + full, 1)
                full, done = full + 1, total
            leave(room, sequence + full, bins - full)
    return blocks


class Places:
    """Looks up sequence and offset of pieces by length and rank."""

    def __init__(self, counts: Mapping[int, int], blocks: list[Block]):
        lengths = sorted(counts)
        self.base = np.zeros(max(lengths, default=0) + 1, dtype=np.int64)
        self.base[lengths] = [0, *accumulate(counts[n] for n in lengths[:-1])]
        ordered = sorted(blocks, key=lambda b: (b.length, b.first))
        fields = ("length", "first", "each", "sequence", "offset")
        self.length, self.first, self.each, self.sequence, self.offset = (
            np.array([getattr(b, f) for b in ordered], dtype=np.int64) for f in fields
        )
        self.start = self.base[self.length] + self.first

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.start, self.base[length] + rank, side="right") - 1
        sequence, place = np.divmod(rank - self.first[at], self.each[at])
        return self.sequence[at] + sequence, self.offset[at] + place * length


def pieces(
    docs: DataFrame,
    vocabulary_path: str,
    ranks_path: str,
    pattern: str,
    end_id: int,
    capacity: int = 1024,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, part, nth`` and with ``carry`` the ``ids`` of every piece.

    ``nth`` numbers the pieces of a length inside the task ``part``. The numbers hold only for one
    computation of a task, so the result is settled before anything is built on it.
    """
    taken = pick(docs, doc_id=doc_id, text=text)
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    given = docs.sparkSession.sparkContext.broadcast((vocabulary, load_ranks(ranks_path), pattern))
    key = uuid.uuid4().hex
    kind = taken.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"

    def run(batches: Batches) -> Batches:
        encode, part = once(key, lambda: Encoder(*given.value)), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            for rows in slices(batch, 1):
                number, columns = [], [[] for _ in range(6)]
                for i, value in enumerate(rows.column(1).to_pylist()):
                    ids = np.append(encode(value), np.uint32(end_id)).astype("<u4", copy=False)
                    for n, (start, length) in enumerate(cuts(len(ids), capacity)):
                        own = ids[start : start + length]
                        number.append(i)
                        new = (n, start, length, zlib.crc32(own.tobytes()), seen[length], own if carry else None)
                        for column, x in zip(columns, new, strict=True):
                            column.append(x)
                        seen[length] += 1
                piece, start, length, crc, nth, own = columns
                arrays = [
                    rows.column(0).take(pa.array(number, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(c, pa.int64()) for c in (start, length, crc)),
                    pa.array([part] * len(piece), pa.int32()),
                    pa.array(nth, pa.int64()),
                ]
                if carry:
                    arrays.append(pa.array(own, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in wanted.split(", ")])

    wanted = schema + ", ids array<int>" * carry
    return settle(taken.mapInArrow(run, wanted))


def pack(found: DataFrame, capacity: int = 1024) -> DataFrame:
    """``sequence_id`` and ``offset`` of every row of ``pieces``, by best-fit decreasing over all of them."""
    counts = found.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = found.sparkSession.sparkContext.broadcast(Places(totals, plan(totals, capacity)))
    others = [c for c in found.columns if c not in ("part", "nth")]
    ranked = found.join(offsets, ["part", "length"]).select(*others, (F.col("nth") + F.col("before")).alias("rank"))
    at, last = others.index("length"), len(others)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in (at, last))
            new = [pa.array(x, pa.int64()) for x in places.value(length, rank)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], *new], names=[*others, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in others)
    return ranked.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, lengths``: what a model is trained on; needs pieces with ``carry``."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    grouped = packed.groupBy("sequence_id").agg(rows.alias("rows"))  # at most ``capacity`` tokens each
    return grouped.select(
        "sequence_id",
        F.flatten(F.col("rows.ids")).alias("ids"),
        F.col("rows.doc_id").alias("doc_ids"),
        F.transform("rows.ids", F.size).alias("lengths"),
    )
