"""Token counts under a sentence-piece BPE vocabulary, with a whole-token shortcut.

Text is read as the library reads it: blanks become ``▁`` and one more stands in front (not for an
empty text); then the adjacent pair of symbols whose joined string has the best score merges, the
leftmost of equals first, until no pair is in the vocabulary. A character outside it counts one
token for each UTF-8 byte.

No vocabulary string holds a line end beside another character, or a ``▁`` behind another one, so
no merge crosses these places. A text therefore falls into pre-tokens that count on their own.
Beforehand it is proved for every vocabulary string, by merging it alone, whether it comes out as
one token: these pre-tokens count one each without merging, only the others are merged.

A null text counts as an empty one: no bytes, no tokens.
"""

from __future__ import annotations

import heapq
import re
import uuid

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Remembered, once, per_text, pick

BLANK = "▁"
SHORT = 128
NEVER = float("-inf")
_PRE_TOKENS = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")


def load_scores(path: str) -> dict[str, float]:
    """Score by vocabulary string, without control, unknown and byte tokens."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }


def check_borders(scores: dict[str, float]) -> None:
    """Raises where a vocabulary string spans a border of pre-tokens."""
    for piece in scores:
        if ("\n" in piece and piece != "\n") or re.search(f"[^{BLANK}]{BLANK}", piece):
            raise ValueError(f"{piece!r} spans a border of pre-tokens")


def merge(word: str, scores: dict[str, float]) -> list[str]:
    """Symbols of ``word`` after all merges; pairs are searched in a list, of long words in a heap."""
    if len(word) <= SHORT:
        short, score = list(word), scores.get
        pairs = [score(word[i : i + 2], NEVER) for i in range(len(word) - 1)]
        while pairs and (best := max(pairs)) != NEVER:
            i = pairs.index(best)
            joined = short[i] = short[i] + short.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = score(short[i - 1] + joined, NEVER)
            if i < len(pairs):
                pairs[i] = score(joined + short[i + 1], NEVER)
        return short
    parts: list[str | None] = list(word)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    heap = [
        (-scores[pair], i, pair) for i in range(len(parts) - 1) if (pair := word[i : i + 2]) in scores
    ]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        if parts[i] is None or after[i] >= len(parts):
            continue
        j = after[i]
        if parts[i] + parts[j] != pair:
            continue  # one of the two has merged meanwhile
        parts[i], parts[j] = pair, None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < len(parts) and (pair := parts[left] + parts[right]) in scores:
                heapq.heappush(heap, (-scores[pair], left, pair))
    return [p for p in parts if p is not None]


def count_word(word: str, scores: dict[str, float]) -> int:
    return sum(1 if p in scores else len(p.encode()) for p in merge(word, scores))


def whole_tokens(scores: dict[str, float]) -> frozenset[str]:
    """Vocabulary strings that encode alone as one token."""
    return frozenset(p for p in scores if merge(p, scores) == [p])


class Counter:
    """Counts the tokens of texts; pre-tokens that were merged are remembered in bounded memory."""

    def __init__(self, scores: dict[str, float], whole: frozenset[str]):
        self.known = Remembered(lambda word: count_word(word, scores), given=dict.fromkeys(whole, 1))

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.known.__getitem__, _PRE_TOKENS.findall((BLANK + text).replace(" ", BLANK))))


def count_tokens(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document, counted where it is read.

    The vocabulary (bounded by its file) is broadcast. Texts never move between tasks.
    """
    scores = load_scores(model_path)
    check_borders(scores)
    key, given = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast((scores, whole_tokens(scores)))

    def derive(texts):
        count = once(key, lambda: Counter(*given.value))
        return [
            pa.array([len((t or "").encode()) for t in texts], pa.int64()),
            pa.array([count(t) for t in texts], pa.int64()),
        ]

    found = per_text(pick(docs, doc_id=doc_id, text=text), "n_bytes bigint, n_tokens bigint", derive)
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
