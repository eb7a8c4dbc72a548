"""A small bidirectional gated recurrent network with attention pooling, in numpy.

One step per word. A step's input is the word's embedding (rows by hash) beside the mean embedding of
its character n-grams (rows by hash, word borders included). Both directions run in one batched
product; attention weighs the states of a window and a logistic unit reads their mean.

States are carried through a text in blocks, each with ``CONTEXT`` words before and behind it, so a word has one
state for all windows that hold it. What a window gives is a quotient of two sums over its words; running sums
give it for the windows that begin at every word.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import count, islice

import numpy as np

WORD_ROWS = 1 << 16
GRAM_ROWS = 1 << 15
GRAM_SIZES = (3, 4, 5)
EMBEDDING = 8
HIDDEN = 8
ATTENTION = 8
CONTEXT = 8  # words on each side that a state has seen at least, where the text has them
BLOCK = 256

#: Word bytes are 0-9, a-z and everything outside ASCII, after the text is lower-cased; all else separates.
WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(WORDS).split()


def word_rows(words: list[bytes]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) & (WORD_ROWS - 1) for w in words), np.int64, len(words))


def gram_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash rows of all character n-grams of the words, and the index of the word of each."""
    texts = [f"\x02{w.decode()}\x03" for w in words]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    rows, owners = [], []
    for n in GRAM_SIZES:
        if len(points) < n:
            continue
        inside = owner[n - 1 :] == owner[: len(owner) - n + 1]
        h = np.full(len(points) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            h = (h ^ points[i : len(points) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        rows.append((h[inside] & np.uint64(GRAM_ROWS - 1)).astype(np.int64))
        owners.append(owner[n - 1 :][inside])
    row, own = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return row[order], own[order]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_weights(seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    size = lambda *shape, scale: draw.normal(0, scale, shape).astype(np.float32)
    return {
        "words": size(WORD_ROWS, EMBEDDING, scale=0.05),
        "grams": size(GRAM_ROWS, EMBEDDING, scale=0.05),
        "input": size(2, 2 * EMBEDDING, 3 * HIDDEN, scale=0.3),
        "bias": np.zeros((2, 3 * HIDDEN), dtype=np.float32),
        "state": size(2, HIDDEN, 3 * HIDDEN, scale=0.3),
        "attend": size(2 * HIDDEN, ATTENTION, scale=0.3),
        "attend_bias": np.zeros(ATTENTION, dtype=np.float32),
        "query": size(ATTENTION, scale=0.3),
        "read": size(2 * HIDDEN, scale=0.3),
        "read_bias": np.zeros(1, dtype=np.float32),
    }


class Vocabulary:
    """The hash rows of distinct words: one per word, and those of its character n-grams in one array."""

    def __init__(self, words: list[bytes], chunk: int = 20_000):
        self.rows = word_rows(words)
        grams, sizes = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), chunk):
            part = words[k : k + chunk]
            rows, own = gram_rows(part)
            grams.append(rows.astype(np.uint16))
            sizes.append(np.bincount(own, minlength=len(part)))
        self.grams, self.sizes = np.concatenate(grams), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def grams_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gram rows of some words one after the other, and where those of each begin."""
        sizes = self.sizes[ids]
        begins = np.cumsum(sizes) - sizes
        places = np.arange(sizes.sum()) + np.repeat(self.starts[ids] - begins, sizes)
        return self.grams[places].astype(np.int64), begins

    def embed(self, ids: np.ndarray, weights: dict[str, np.ndarray]) -> np.ndarray:
        """(words, 2 * EMBEDDING)"""
        rows, begins = self.grams_of(ids)
        sums = np.add.reduceat(weights["grams"][rows], begins, axis=0)
        return np.concatenate([weights["words"][self.rows[ids]], sums / self.sizes[ids][:, None]], axis=1).astype(np.float32)


def states_of(x: np.ndarray, w: dict[str, np.ndarray], keep: list | None = None) -> np.ndarray:
    """States (2, steps, sequences, HIDDEN) for projected inputs ``x`` (2, steps, sequences, 3 * HIDDEN), each direction
    in its own order. ``keep`` gets what the backward pass needs."""
    steps, n = x.shape[1], x.shape[2]
    h = np.zeros((2, n, HIDDEN), dtype=np.float32)
    states = np.empty((2, steps, n, HIDDEN), dtype=np.float32)
    for t in range(steps):
        u = np.matmul(h, w["state"])
        gates = sigmoid(x[:, t, :, : 2 * HIDDEN] + u[..., : 2 * HIDDEN])
        r, z = gates[..., :HIDDEN], gates[..., HIDDEN:]
        new = np.tanh(x[:, t, :, 2 * HIDDEN :] + r * u[..., 2 * HIDDEN :])
        if keep is not None:
            keep.append((h, r, z, new, u[..., 2 * HIDDEN :]))
        h = new + z * (h - new)
        states[:, t] = h
    return states


def forward(x: np.ndarray, w: dict[str, np.ndarray], inner: slice, keep: list | None = None):
    """Logits of windows: the words ``inner`` of sequences of equal length, the others are their context."""
    both = states_of(x, w, keep)
    states = np.concatenate([both[0], both[1, ::-1]], axis=-1)[inner]
    looked = np.tanh(states @ w["attend"] + w["attend_bias"])
    weight = looked @ w["query"]
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tn,tnd->nd", weight, states)
    return pooled @ w["read"] + w["read_bias"][0], (states, looked, weight, pooled)


def project(e: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    """(2, words, 3 * HIDDEN): what each word adds to the gates of both directions."""
    return np.matmul(e[None], w["input"]) + w["bias"][:, None]


def gradients(
    e: np.ndarray, ids: np.ndarray, y: np.ndarray, importance: np.ndarray, w: dict[str, np.ndarray], inner: slice = slice(None)
):
    """Loss and gradients for windows ``ids`` (windows, steps) of words with embeddings ``e``; ``inner`` steps are pooled."""
    p = project(e, w)
    order = np.stack([ids.T, ids.T[::-1]])
    x = np.stack([p[0][order[0]], p[1][order[1]]])
    kept: list = []
    logits, (states, looked, weight, pooled) = forward(x, w, inner, kept)
    chance = sigmoid(logits)
    loss = -np.sum(importance * np.where(y > 0, np.log(chance + 1e-9), np.log(1 - chance + 1e-9)))
    d = ((chance - y) * importance).astype(np.float32)
    g = {"read": d @ pooled, "read_bias": np.array([d.sum()], dtype=np.float32)}
    d_pooled = d[:, None] * w["read"]
    d_weight = np.einsum("nd,tnd->tn", d_pooled, states)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["query"] = np.einsum("tn,tna->a", d_score, looked)
    d_look = d_score[..., None] * w["query"] * (1 - looked**2)
    g["attend"] = np.einsum("tnd,tna->da", states, d_look)
    g["attend_bias"] = d_look.sum(axis=(0, 1))
    steps = x.shape[1]
    d_states = np.zeros((steps, len(y), 2 * HIDDEN), dtype=np.float32)
    d_states[inner] = weight[..., None] * d_pooled + d_look @ w["attend"].T
    dh = np.zeros_like(kept[0][0])
    dx = np.empty_like(x)
    g["state"] = np.zeros_like(w["state"])
    for t in reversed(range(steps)):
        h, r, z, new, u = kept[t]
        dh = dh + np.stack([d_states[t, :, :HIDDEN], d_states[steps - 1 - t, :, HIDDEN:]])
        d_new = dh * (1 - z) * (1 - new**2)
        d_z = dh * (h - new) * z * (1 - z)
        d_r = d_new * u * r * (1 - r)
        dx[:, t] = np.concatenate([d_r, d_z, d_new], axis=-1)
        d_u = np.concatenate([d_r, d_z, d_new * r], axis=-1)
        g["state"] += np.matmul(h.transpose(0, 2, 1), d_u)
        dh = dh * z + np.matmul(d_u, w["state"].transpose(0, 2, 1))
    g["bias"] = dx.sum(axis=(1, 2))
    flat = dx.reshape(2, -1, dx.shape[-1])
    dp = np.stack([_sum_rows(order[k].ravel(), flat[k], len(e)) for k in (0, 1)])
    g["input"] = np.matmul(e.T[None], dp)
    return loss, g, np.matmul(dp, w["input"].transpose(0, 2, 1)).sum(axis=0)


def _sum_rows(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(rows, weights=values[:, k], minlength=n) for k in range(values.shape[1])], axis=1).astype(np.float32)


class Words:
    """Numbers the distinct words it meets and keeps what they add to the gates, in bounded memory."""

    def __init__(self, weights: dict[str, np.ndarray], limit: int = 100_000):
        self.weights, self.limit = weights, limit
        self.clear()

    def clear(self) -> None:
        self.index: defaultdict = defaultdict(count().__next__)
        self.added = np.empty((2, 1024, 3 * HIDDEN), dtype=np.float32)
        self.known = 0

    def ids(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if self.known > self.limit:
            self.clear()
        words = [w for t in texts for w in t]
        found = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        total = len(self.index)
        if total > self.known:
            fresh = list(islice(self.index, self.known, None))
            if total > self.added.shape[1]:
                grown = np.empty((2, max(total, 2 * self.added.shape[1]), 3 * HIDDEN), dtype=np.float32)
                grown[:, : self.known] = self.added[:, : self.known]
                self.added = grown
            embedded = Vocabulary(fresh).embed(np.arange(len(fresh)), self.weights)
            self.added[:, self.known : total] = project(embedded, self.weights)
            self.known = total
        return np.split(found, np.cumsum([len(t) for t in texts])[:-1]) if texts else []


def blocks_of(sizes: list[int], block: int = BLOCK, context: int = CONTEXT) -> np.ndarray:
    """(text, first word, end, first word with context, end with context) of the blocks of texts, one row each."""
    rows = [
        (i, first, end, max(0, first - context), min(n, end + context))
        for i, n in enumerate(sizes)
        for first in range(0, n, block)
        for end in (min(n, first + block),)
    ]
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def word_values(texts: list[np.ndarray], added: np.ndarray, w: dict[str, np.ndarray], batch: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """For the words of all texts (ids), one after the other: attention and what the last unit reads from the state."""
    sizes = [len(t) for t in texts]
    ids = np.concatenate([np.zeros(0, np.int64), *texts])
    bases = np.cumsum([0, *sizes])
    attention, read = np.zeros(len(ids)), np.zeros(len(ids))
    blocks = blocks_of(sizes)
    blocks = blocks[np.argsort(blocks[:, 4] - blocks[:, 3], kind="stable")]
    for k in range(0, len(blocks), batch):
        part = blocks[k : k + batch]
        start, length = bases[part[:, 0]] + part[:, 3], part[:, 4] - part[:, 3]
        step = np.arange(length.max())[:, None]
        inside = step < length
        forth = ids[np.where(inside, start + step, 0)]
        back = ids[np.where(inside, start + length - 1 - step, 0)]
        both = states_of(np.stack([added[0][forth], added[1][back]]), w)
        # The backward state of the word at a step stands as far from the sequence's end.
        turned = np.take_along_axis(both[1], np.maximum(length - 1 - step, 0)[..., None], axis=0)
        states = np.concatenate([both[0], turned], axis=-1)
        own = inside & (step >= part[:, 1] - part[:, 3]) & (step < part[:, 2] - part[:, 3])
        at = (start + step)[own]
        chosen = states[own]
        attention[at] = np.tanh(chosen @ w["attend"] + w["attend_bias"]) @ w["query"]
        read[at] = chosen @ w["read"]
    return attention, read


def window_logits(texts: list[np.ndarray], added: np.ndarray, w: dict[str, np.ndarray], width: int) -> list[np.ndarray]:
    """For each text (ids of its words) the logits of the windows that begin at each word; one for a shorter text, none without words."""
    attention, read = word_values(texts, added, w)
    out, base = [], 0
    for text in texts:
        n = len(text)
        own = slice(base, base + n)
        base += n
        if not n:
            out.append(np.zeros(0))
            continue
        share = np.exp(attention[own] - attention[own].max())
        sums = np.cumsum([np.append(0.0, share), np.append(0.0, share * read[own])], axis=1)
        size = min(n, width)
        whole = sums[:, size:] - sums[:, : n - size + 1]
        out.append(whole[1] / whole[0] + w["read_bias"][0])
    return out
