"""Toxicity: a bidirectional recurrent network over words and characters, scoring all overlapping windows.

A document's score is that of its most suspicious window (``WIDTH`` words, one begins at every word), so a
short insult in a long text counts. Labels belong to documents, so training alternates: windows of
labelled documents are chosen by the present model (at first by the log-odds of their words and
character n-grams, which also start the embeddings), then the network is fitted to them. The
threshold comes from labelled documents of the sample that no gradient saw.

Fitting sample (its bounds are parameters): the rows of smallest id hash with a 0/1 label, up to
``POSITIVES`` and ``NEGATIVES``, of at most ``LONGEST`` characters.

Null and empty texts and texts without words score 0. Without rows of both labels nothing is
learned and every score is 0. A repeated or contradictory label counts as often as it stands.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm import gru
from plumbline.llm.common import filtered, once, per_text, pick

WIDTH = 32
APART = 16  # words between the windows of a clean document that are learned from
POSITIVES = 1500
NEGATIVES = 4000
LONGEST = 20_000
ROUNDS = 3
EPOCHS = 4
BATCH = 256
RATE = 0.01
SEED = 11


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    shift: float


def log_odds(rows: Iterable[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Of the rows that a document has, shrunk where few documents have them."""
    with_row = np.zeros((2, size))
    for row, label in zip(rows, labels, strict=True):
        with_row[int(label), row] += 1
    documents = np.array([(labels == 0).sum(), (labels == 1).sum()])
    share = (with_row + 0.5) / (documents[:, None] + 1)
    total = with_row.sum(axis=0)
    return (np.clip(np.log(share[1] / share[0]), -4, 4) * total / (total + 4)).astype(np.float32)


class Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, name: str, gradient: np.ndarray, rows=slice(None)) -> None:
        m, s, w = self.mean[name], self.square[name], self.weights[name]
        m[rows] = 0.9 * m[rows] + 0.1 * gradient
        s[rows] = 0.99 * s[rows] + 0.01 * gradient**2
        fix = np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        w[rows] -= self.rate * fix * m[rows] / (np.sqrt(s[rows]) + 1e-7)


def train_windows(
    weights, adam: Adam, vocabulary: gru.Vocabulary, windows: list[tuple], labels: np.ndarray, importance: np.ndarray, draw
) -> None:
    """One epoch over windows ``(word ids with context, first, end)``; batches hold windows of one shape."""
    by_shape: dict[tuple, list[int]] = {}
    for i in draw.permutation(len(windows)):
        by_shape.setdefault((len(windows[i][0]), *windows[i][1:]), []).append(i)
    batches = [(slice(*shape[1:]), rows[k : k + BATCH]) for shape, rows in by_shape.items() for k in range(0, len(rows), BATCH)]
    for b in draw.permutation(len(batches)):
        inner, chosen = batches[b]
        words, ids = np.unique(np.stack([windows[i][0] for i in chosen]), return_inverse=True)
        e = vocabulary.embed(words, weights)
        _, g, d_e = gru.gradients(e, ids.reshape(len(chosen), -1), labels[chosen], importance[chosen] / len(chosen), weights, inner)
        adam.t += 1
        for name, value in g.items():
            adam.step(name, value)
        sizes = vocabulary.sizes[words]
        d_word, d_gram = d_e[:, : gru.EMBEDDING], d_e[:, gru.EMBEDDING :] / sizes[:, None]
        grams = vocabulary.grams_of(words)[0]
        for name, at, values in (("words", vocabulary.rows[words], d_word), ("grams", grams, np.repeat(d_gram, sizes, axis=0))):
            used, inverse = np.unique(at, return_inverse=True)
            adam.step(name, gru._sum_rows(inverse, values, len(used)), used)


def with_context(words: np.ndarray, start: int) -> tuple[np.ndarray, int, int]:
    """The window that begins at ``start`` with the words around it, and where it lies among them."""
    first, end = max(0, start - gru.CONTEXT), min(len(words), start + WIDTH)
    return words[first : end + gru.CONTEXT], start - first, end - first


def apart(suspicion: np.ndarray, most: int) -> list[int]:
    """The most suspicious windows, at least ``APART`` words from each other."""
    left, out = suspicion.copy(), []
    while len(out) < most and np.isfinite(left.max()):
        out.append(int(left.argmax()))
        left[max(0, out[-1] - APART + 1) : out[-1] + APART] = -np.inf
    return out


def fit(texts: list[str], labels: list[int], seed: int = SEED) -> Model | None:
    """A model of labelled texts; every fifth is kept back to set the threshold."""
    numbers: dict[bytes, int] = {}
    split, kept = [], []
    for text, label in zip(texts, labels, strict=True):
        if words := gru.words_of(text):
            split.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int32))
            kept.append(label)
    y = np.array(kept, dtype=np.float32)
    if len(set(kept)) < 2:
        return None
    vocabulary = gru.Vocabulary(list(numbers))
    del numbers
    draw = np.random.default_rng(seed)
    weights = gru.new_weights(seed)
    back = np.zeros(len(y), dtype=bool)
    for label in (0, 1):
        back[np.flatnonzero(y == label)[4::5]] = True
    own = np.flatnonzero(~back)

    distinct = {i: np.unique(split[i]) for i in own}
    word_odds = log_odds((np.unique(vocabulary.rows[distinct[i]]) for i in own), y[own], gru.WORD_ROWS)
    gram_odds = log_odds((np.unique(vocabulary.grams_of(distinct[i])[0]) for i in own), y[own], gru.GRAM_ROWS)
    weights["words"][:, 0] += word_odds / 2
    weights["grams"][:, 0] += gram_odds / 2

    evidence = word_odds[vocabulary.rows] + np.add.reduceat(gram_odds[vocabulary.grams], vocabulary.starts) / vocabulary.sizes
    suspicion = [
        np.lib.stride_tricks.sliding_window_view(evidence[words], min(WIDTH, len(words))).max(axis=1) for words in split
    ]
    positive = max(1, int((y[own] == 1).sum()))
    weight = {1: 0.5 / positive, 0: 0.5 / max(1, len(own) - positive)}
    adam = Adam(weights, RATE)
    for _ in range(ROUNDS):
        windows, targets, importance = [], [], []
        for i in own:
            chosen = set(apart(suspicion[i], 1 if y[i] else 3))
            if not y[i]:
                chosen.add(int(draw.integers(len(suspicion[i]))))
            for k in sorted(chosen):
                windows.append(with_context(split[i], k))
                targets.append(y[i])
                importance.append(weight[int(y[i])] / len(chosen) * len(own))
            if not y[i]:  # clean words stay clean when they repeat, as in lists and junk
                few = split[i][draw.integers(len(split[i]), size=3)]
                windows.append((few[np.arange(WIDTH) * len(few) // WIDTH], 0, WIDTH))
                targets.append(0.0)
                importance.append(weight[0] / 4 * len(own))
        for _ in range(EPOCHS):
            train_windows(weights, adam, vocabulary, windows, np.array(targets), np.array(importance), draw)
        suspicion = []
        for k in range(0, len(split), 250):
            part = split[k : k + 250]
            words, ids = np.unique(np.concatenate(part), return_inverse=True)
            added = gru.project(vocabulary.embed(words, weights), weights)
            texts_of = np.split(ids, np.cumsum([len(t) for t in part])[:-1])
            suspicion += gru.window_logits(texts_of, added, weights, WIDTH)
        adam.rate /= 2
    most = np.array([s.max() for s in suspicion])
    return Model(weights, _threshold(most[back], y[back]) if back.any() else 0.0)


def _threshold(logits: np.ndarray, y: np.ndarray) -> float:
    """In the widest gap among the cuts with the fewest mistakes, nearer to the label 1: it is the rarer one."""
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], y[order]
    mistakes = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    edges = np.concatenate([[x[0] - 2], x, [x[-1] + 2]])
    gap = np.where(mistakes == mistakes.min(), edges[1:] - edges[:-1], -1)
    best = int(gap.argmax())
    return float(0.25 * edges[best] + 0.75 * edges[best + 1])


class Scorer:
    """Scores texts: the logistic of the largest window logit, less the threshold."""

    def __init__(self, model: Model | None):
        self.model = model
        self.words = gru.Words(model.weights) if model else None

    def __call__(self, texts: list[str | None]) -> list[float]:
        if self.model is None:
            return [0.0] * len(texts)
        ids = self.words.ids([gru.words_of(t) for t in texts])
        found = gru.window_logits(ids, self.words.added, self.model.weights, WIDTH)
        return [float(1 / (1 + np.exp(-np.clip(float(x.max()) - self.model.shift, -30, 30)))) if len(x) else 0.0 for x in found]


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    held_out: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, longest: int = LONGEST,
) -> Model | None:
    """A model of labelled rows that are not ``held_out`` (a condition on doc_id).

    Ids of labels are ranked first; only their texts are read for the sample.
    """
    own = pick(labels, doc_id=doc_id, label=label).where("doc_id IS NOT NULL AND label IN (0, 1)")
    if held_out is not None:
        own = own.where(~F.coalesce(held_out, F.lit(False)))
    ranked = [
        own.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        for value, bound in ((1, positives), (0, negatives))
    ]
    chosen = ranked[0].unionByName(ranked[1]).select(F.col("doc_id").alias("id"), F.col("label").cast("int").alias("label"))
    rows = pick(docs, doc_id=doc_id, text=text).where(F.length("text") <= longest)
    found = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "label", "text")
    bound = positives + negatives
    sample = found.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "text").limit(bound).collect()
    return fit([r.text for r in sample], [r.label for r in sample]) if sample else None


class Sent:
    """A model on its way to the tasks; each worker sets it up once."""

    def __init__(self, spark, model: Model | None):
        self.key, self.model = uuid.uuid4().hex, spark.sparkContext.broadcast(model)

    def __call__(self, texts: list[str | None]) -> list[float]:
        own = once(self.key, lambda: Scorer(self.model.value))
        out: list[float] = []
        held, start = 0, 0
        for i, text in enumerate(texts):
            held += len(text or "")
            if held > 1_000_000:
                out += own(texts[start : i + 1])
                held, start = 0, i + 1
        return out + own(texts[start:])


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every document, scored where it is read."""
    scorer = Sent(docs.sparkSession, model)
    return per_text(
        pick(docs, doc_id=doc_id, text=text), "score double", lambda texts: [pa.array(scorer(texts), pa.float64())]
    )


def clean_documents(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Documents that score below 0.5, with all their columns."""
    scorer = Sent(docs.sparkSession, model)
    return filtered(docs, text, lambda texts: [s < 0.5 for s in scorer(texts)])
