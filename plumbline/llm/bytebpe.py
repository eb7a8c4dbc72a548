"""Byte-level BPE encoding and decoding as a tree reduction.

``encode`` halves a text until the parts are small, encodes them and joins neighbours; what a
join needs is re-encoded in a window at the border, which grows until the tokens outside it
provably stay. This happens on two levels:

* Pre-tokens (matches of the pattern): the pattern looks ahead but never back, so all matches
  from a place on depend only on the text from there on. A match of the left part that ends
  ``LOOK`` characters before the part's end was decided inside it and stays. From the first other
  match on the text is matched again, until a match that was decided inside the window ends
  where a match of the right part begins; from there on the right part's matches stay.
* Tokens of a long pre-token: a sequence of tokens is the encoding of its bytes exactly if each
  two neighbours are the encoding of theirs. So a window of the last tokens of the left and the
  first of the right is encoded anew, and grows until its first and its last token come out as
  they were; then every pair of neighbours was found by encoding it.

Joins are associative, with the empty text as the neutral element. Decoding joins the bytes of
halves. Null counts as the empty text: no ids, and the digest of nothing.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
from array import array
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from plumbline.llm.common import Remembered, once, per_text, pick

LEAF = 16_384  # characters of a text that are matched at once
LOOK = 4  # no match depends on more characters behind its end
LEAF_BYTES = 48  # bytes of a pre-token that are merged at once
SHORT = 128  # bytes whose pairs are searched in a list; beyond, in a heap
NEVER = 1 << 60


def load_ranks(path: str, open_file=open) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank in each line."""
    with open_file(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of ``word``: the adjacent pair of the lowest rank merges first, the leftmost of equals."""
    if len(word) <= SHORT:
        parts = [word[i : i + 1] for i in range(len(word))]
        rank = ranks.get
        pairs = [rank(word[i : i + 2], NEVER) for i in range(len(word) - 1)]
        while pairs and (best := min(pairs)) != NEVER:
            i = pairs.index(best)
            joined = parts[i] = parts[i] + parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + joined, NEVER)
            if i < len(pairs):
                pairs[i] = rank(joined + parts[i + 1], NEVER)
        return [ranks[p] for p in parts]
    n = len(word)
    end = list(range(1, n + 1))  # by start: where the part ends; 0 if it has been taken in
    start = list(range(-1, n))  # by end: where the part that ends here begins, at index end
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= j or end[middle] != j:
            continue  # one of the two has merged meanwhile
        end[i], end[middle], start[j] = j, 0, i
        if i and (r := ranks.get(word[start[i] : j])) is not None:
            heapq.heappush(heap, (r, start[i], j))
        if j < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Codec:
    """Encodes and decodes texts; pre-tokens that were merged are remembered in bounded memory."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, leaf_bytes: int = LEAF_BYTES):
        self.ranks, self.leaf, self.leaf_bytes = ranks, leaf, leaf_bytes
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.matches = regex.compile(pattern).findall
        self.known = Remembered(lambda match: array("I", self.word_ids(match.encode())).tobytes())

    # Pre-tokens

    def pretokens(self, text: str) -> list[str]:
        """Matches of the pattern, by halves."""
        if len(text) <= self.leaf:
            return self.matches(text)
        half = len(text) // 2
        return self.join_pretokens(self.pretokens(text[:half]), self.pretokens(text[half:]))

    def join_pretokens(self, left: list[str], right: list[str]) -> list[str]:
        keep, tail = len(left), 0  # tail: characters behind the kept matches
        while keep and tail < LOOK:
            keep -= 1
            tail += len(left[keep])
        # the last kept match ends `tail` >= LOOK characters before the border
        open_text = "".join(left[keep:])
        size = 64
        while True:
            used, length = 0, 0
            while used < len(right) and length < size:
                length += len(right[used])
                used += 1
            window = open_text + "".join(right[:used])
            found = self.matches(window)
            if used == len(right):
                return left[:keep] + found
            own = {tail + x: i for i, x in enumerate(accumulate(map(len, right[:used]), initial=0))}
            at = 0
            for i, match in enumerate(found):
                at += len(match)
                if at + LOOK > len(window):
                    break
                if at in own:
                    return left[:keep] + found[: i + 1] + right[own[at] :]
            size *= 2

    # Tokens of a pre-token

    def word_ids(self, word: bytes) -> list[int]:
        if (whole := self.ranks.get(word)) is not None:
            return [whole]
        return self.halves(word)

    def halves(self, word: bytes) -> list[int]:
        if len(word) <= self.leaf_bytes:
            return merge(word, self.ranks)
        half = len(word) // 2
        return self.join_ids(self.halves(word[:half]), self.halves(word[half:]))

    def join_ids(self, left: list[int], right: list[int]) -> list[int]:
        size = 2
        while True:
            a, b = left[-size:], right[:size]
            window = merge(b"".join(map(self.bytes_of.__getitem__, a + b)), self.ranks)
            if (len(a) == len(left) or window[0] == a[0]) and (len(b) == len(right) or window[-1] == b[-1]):
                return left[: len(left) - len(a)] + window + right[len(b) :]
            size *= 2

    # Texts

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.pretokens(text or "")))

    def decode(self, ids: bytes) -> bytes:
        if len(ids) <= 4 * self.leaf:
            return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _codec(docs: DataFrame, ranks_path: str, pattern: str):
    key, given = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))
    return lambda: once(key, lambda: Codec(given.value, pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) of every document."""
    codec = _codec(docs, ranks_path, pattern)

    def derive(texts):
        found = [codec().encode(t) for t in texts]
        offsets = [0, *accumulate(len(i) // 4 for i in found)]
        values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(found))])
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)]

    return per_text(pick(docs, doc_id=doc_id, text=text), "ids array<int>", derive)


def decode(rows: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, decoded`` (binary): the bytes that the ids stand for; null ids give no bytes."""
    codec = _codec(rows, ranks_path, pattern)

    def run(batches):
        for batch in batches:
            lists = batch.column(1).to_pylist()
            out = [codec().decode(array("I", i or []).tobytes()) for i in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    taken = pick(rows, doc_id=doc_id, ids=ids)
    return taken.mapInArrow(run, f"doc_id {taken.schema['doc_id'].dataType.simpleString()}, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes every text, decodes the ids and gives the digests of both, where the text is read."""
    codec = _codec(docs, ranks_path, pattern)

    def derive(texts):
        own = codec()
        numbers, of_ids, of_bytes = [], [], []
        for text_ in texts:
            ids = own.encode(text_)
            numbers.append(len(ids) // 4)
            of_ids.append(hashlib.sha256(ids).hexdigest())
            of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
        return [pa.array(numbers, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]

    taken = pick(docs, doc_id=doc_id, text=text)
    return per_text(taken, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", derive)
