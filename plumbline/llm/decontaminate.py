"""Benchmark decontamination with one Aho-Corasick automaton over the windows of all items.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. An item's windows are
its runs of ``window`` consecutive words (an item of fewer words, but not none, is one window). The
automaton holds the windows as space-joined words with a space at both ends, so that a match
begins and ends at word borders. A text is normalised the same way and scanned once; matches are
mapped back to word numbers and to character offsets of the original text.

Null and empty texts have no words; repeated windows, items and documents count as they are; an
empty benchmark hits nothing; null item ids count as one item, a null at the end
of the list, which the digest's text of ids leaves out.
"""

from __future__ import annotations

import bisect
import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import LOWER, filtered, once, per_text, pick

WINDOW = 10
#: Bytes of windows in one automaton (about 60 bytes of memory each). A larger benchmark is scanned in blocks.
BLOCK_BYTES = 4_000_000

#: Word bytes are 0-9, a-z after lower-casing and everything outside ASCII; all else separates.
WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in LOWER)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORDS).split()


def _windows(batches, size):
    for batch in batches:
        numbers, windows = [], []
        for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            for i in range(max(1, len(words) - size + 1) if words else 0):
                numbers.append(number)
                windows.append(b" ".join(words[i : i + size]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.string()), pa.array(windows, pa.binary())], names=["item_id", "window"]
        )


def window_blocks(
    items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> list[dict[bytes, tuple]]:
    """The distinct windows of ``items`` with the ids of their items, in blocks of bounded size.

    The block number is a hash of the window, over as many blocks as the total size needs, so
    each block that the driver holds and broadcasts is about ``block_bytes`` whatever the items.
    """
    rows = pick(items, item_id=item_id, text=text).select(F.col("item_id").cast("string"), "text")
    rows = rows.mapInArrow(lambda b: _windows(b, window), "item_id string, window binary")
    found = rows.groupBy("window").agg(F.collect_set(F.struct("item_id")).alias("items"))  # a set drops bare nulls
    size = found.agg(F.sum(F.length("window") + 24 * F.size("items"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    out = []
    for block in range(blocks):
        part = found.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        out.append({bytes(r.window): tuple(i["item_id"] for i in r["items"]) for r in part.toLocalIterator()})
    return out


def automaton(windows: dict[bytes, tuple]) -> ahocorasick.Automaton:
    """Bytes are given as Latin-1 characters, one each."""
    found = ahocorasick.Automaton()
    for window, items in windows.items():
        found.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, items))
    if windows:
        found.make_automaton()
    return found


def scan(text: str | None, machine: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged runs of hit words (first, end) and the items found."""
    words = words_of(text)
    joined = f" {b' '.join(words).decode('latin-1')} "
    if not words or not len(machine):
        return len(words), [], set()
    runs: list[tuple[int, int]] = []
    items: set = set()
    ends = None
    for end, (n, own) in machine.iter(joined):
        if ends is None:
            ends = np.cumsum([1 + len(w) for w in words]).tolist()  # place of the space behind each word
        last = bisect.bisect_left(ends, end) + 1
        items.update(own)
        runs.append((last - n, last))
    return len(words), merged(runs), items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def spans(text: str | None, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of runs of words."""
    if not runs:
        return []
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.translate(LOWER))]
    at = lambda byte: len(raw[:byte].decode())  # noqa: E731  words begin and end at whole characters
    return [(at(places[first][0]), at(places[end - 1][1])) for first, end in runs]


class Scanner:
    """Scans with the automata of all blocks in turn; each is built once per worker."""

    def __init__(self, spark, blocks: list[dict[bytes, tuple]]):
        self.parts = [(uuid.uuid4().hex, spark.sparkContext.broadcast(b)) for b in blocks]

    def __call__(self, texts: list[str | None]) -> list[tuple[int, list, set]]:
        if not self.parts:
            return [(len(words_of(t)), [], set()) for t in texts]
        total = None
        for key, part in self.parts:
            machine = once(key, lambda part=part: automaton(part.value))
            found = [scan(t, machine) for t in texts]
            total = found if total is None else [
                (n, merged(a + b), x | y) for (n, a, x), (_, b, y) in zip(total, found, strict=True)
            ]
        return total


def decontaminate(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_text: str = "text",
    item_id: str = "item_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, items`` (sorted strings), ``spans`` (array of start and end).

    Documents are scanned where they are read; the benchmark goes to them.
    """
    scanner = Scanner(docs.sparkSession, window_blocks(items, item_id, item_text, window, block_bytes))

    def derive(texts):
        found = scanner(texts)
        return [
            pa.array([n for n, _, _ in found], pa.int64()),
            pa.array([sum(e - f for f, e in runs) for _, runs, _ in found], pa.int64()),
            pa.array([sorted(own, key=lambda i: (i is None, i)) for _, _, own in found], pa.list_(pa.string())),
            pa.array(
                [[{"start": a, "end": b} for a, b in spans(t, runs)] for t, (_, runs, _) in zip(texts, found, strict=True)],
                pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
            ),
        ]

    return per_text(
        pick(docs, doc_id=doc_id, text=text),
        "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:int,end:int>>", derive,
    )


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Documents without a hit word, with all their columns."""
    scanner = Scanner(docs.sparkSession, window_blocks(items))
    return filtered(docs, text, lambda texts: [not runs for _, runs, _ in scanner(texts)])


def digest(found: DataFrame) -> DataFrame:
    joined = F.array_join("items", ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(joined, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )

