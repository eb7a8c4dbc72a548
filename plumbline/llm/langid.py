"""Language identification: blended-spectrum presence kernel, Nystroem landmarks, kernel ridge regression.

A text is its set G of 1-, 2- and 3-grams over lower-cased letters (runs of other characters count as
one border); letters outside the model's alphabet fold into one. The kernel of two texts is
``|G n H| / sqrt(|G| |H|)``. A bounded sample of each language gives landmarks and training texts;
with K the kernel among landmarks and k(x) that of a text to them, ``K^-1/2 k(x)`` are its features and
one ridge regression per language (+1, rest -1) is fitted on them. Batches of texts are scored by two
matrix products.

Fitting sample (its bound is a parameter): per language the ``per_language`` usable rows of smallest
id hash, and ``most`` rows overall. Usable rows have a letter and at most ``longest`` characters; only
a language without such rows is learned from ``few`` longer ones, so none is lost by its lengths. Scores are
``(f + 1) / 2`` of the best language, cut to 0..1; of equal scores the first language by name wins.
Every text with a letter gets the best language. Null texts and those without a letter are ``und`` with
score 0, as are all texts if nothing can be learned (no usable row with an id and a language).

``known_language`` keeps texts that the landmarks know well enough. The limits come from the sample: of
rows that are no landmarks, and of landmarks beside the others, the share of known n-grams and the
score that all but 1 % reach. A text is rejected below ``FAR`` of that share, or below ``NEAR`` of it with a
score below ``FAR`` of that one, or without any known n-gram. The share of a text of few n-grams says little, so both limits
are lowered by ``DOUBT`` times its standard deviation in texts of that size. Mixed texts have
known n-grams, so they stay whatever their score. Texts with letters stay where nothing was learned.
Repeated rows and other columns are kept as they are; an empty table gives an empty one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import filtered, once, per_text, pick

PER_LANGUAGE = 500
LANDMARKS = 40  # per language
MOST = 20_000
LONGEST = 20_000
FEW = 20
SALTS = 64
ALPHABET = 62
BASE = 64
RIDGE = 1e-2
UNKNOWN = "und"
#: Shares of what all but 1 % of the sample reach.
FAR, NEAR = 0.8, 0.9
DOUBT = 3.0
#: Texts of a lower score are rejected; by default none, an even mix of L languages scores about 1 / L.
LEAST_SCORE = 0.0


@dataclass
class Model:
    alphabet: str
    languages: list[str]
    grams: np.ndarray  # codes that some landmark has, ascending
    landmarks: np.ndarray  # (landmarks, grams): presence over the root of the landmark's size
    weights: np.ndarray  # (landmarks, languages)
    least_known: float  # share of known n-grams that all but 1 % of the sample reach
    least_score: float


def letter_table(alphabet: str) -> np.ndarray:
    """By code point: 0 for no letter, 1.. for the alphabet, ALPHABET + 1 for other letters."""
    table = np.fromiter((ALPHABET + 1 if chr(i).isalpha() else 0 for i in range(0x110000)), np.uint8, 0x110000)
    for i, letter in enumerate(alphabet):
        table[ord(letter)] = i + 1
    return table


class Grams:
    """Presence of n-grams of texts; one buffer serves all of them."""

    SIZE = BASE + BASE**2 + BASE**3

    def __init__(self, alphabet: str):
        self.table = letter_table(alphabet)
        self.present = np.zeros(self.SIZE, dtype=bool)

    def __call__(self, text: str | None) -> np.ndarray | None:
        """A flag for each code, valid until the next call; None without a letter."""
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = np.zeros(len(points) + 2, dtype=np.int32)
        codes[1:-1] = self.table[points]
        if not codes.any():
            return None
        codes = np.concatenate([[0], codes[1:][(codes[1:] != 0) | (codes[:-1] != 0)]])
        if codes[1] == 0:
            codes = codes[1:]
        self.present[:] = False
        pairs = codes[:-1] * BASE + codes[1:]
        self.present[codes] = True
        self.present[0] = False
        self.present[BASE + pairs] = True
        self.present[BASE + BASE**2 + pairs[:-1] * BASE + codes[2:]] = True
        return self.present


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS) -> Model | None:
    """A model of texts given in the order of their rank; the first of each language are landmarks."""
    letters: dict[str, int] = {}
    for text in texts:
        for letter in set(text.lower()):
            if letter.isalpha():
                letters[letter] = letters.get(letter, 0) + 1
    alphabet = "".join(sorted(sorted(letters, key=lambda c: (-letters[c], c))[:ALPHABET]))
    grams = Grams(alphabet)
    rows, names = [], []
    for text, name in zip(texts, languages, strict=True):
        flags = grams(text)
        if flags is not None:
            rows.append(np.flatnonzero(flags))
            names.append(name)
    if not rows:
        return None
    known = sorted(set(names))
    counts = dict.fromkeys(known, 0)
    marks = []
    for i, name in enumerate(names):
        if counts[name] < landmarks:
            marks.append(i)
        counts[name] += 1
    codes = np.unique(np.concatenate([rows[i] for i in marks]))
    present = np.zeros((len(rows), len(codes)), dtype=np.float32)
    for i, row in enumerate(rows):
        at = np.searchsorted(codes, row)
        at[at == len(codes)] = 0
        present[i, at[codes[at] == row]] = 1
    roots = np.sqrt([len(row) for row in rows])
    marked = present[marks] / roots[marks][:, None].astype(np.float32)
    kernel = (present @ marked.T).astype(np.float64) / roots[:, None]
    values, vectors = np.linalg.eigh(kernel[marks])
    sound = values > 1e-8 * values.max()
    root = vectors[:, sound] / np.sqrt(values[sound])
    features = kernel @ root
    targets = np.where(np.array(names)[:, None] == np.array(known)[None, :], 1.0, -1.0)
    balance = np.array([1 / counts[n] for n in names])[:, None]  # each language weighs the same
    square = features.T @ (features * balance) + RIDGE * np.eye(features.shape[1]) / len(marks)
    weights = root @ np.linalg.solve(square, features.T @ (targets * balance))
    is_mark = np.isin(np.arange(len(rows)), marks)
    elsewhere = present.copy()
    elsewhere[is_mark] *= present[marks].sum(axis=0) > 1  # a landmark is judged by the others
    shares = elsewhere.sum(axis=1) / roots**2
    scores = ((kernel @ weights).max(axis=1) + 1) / 2
    least = [float(np.quantile(v, 0.01, method="lower")) for v in (shares, scores)]
    return Model(alphabet, known, codes, marked, weights.astype(np.float32), *least)


class Classifier:
    def __init__(self, model: Model | None):
        self.model = model
        self.grams = Grams(model.alphabet) if model else None

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        return [(name, score) for name, score, _ in self.judge(texts)]

    def judge(self, texts: list[str | None], batch: int = 256) -> list[tuple[str, float, bool]]:
        """Best language, its score, and whether the model knows enough of the text to vouch for it."""
        if self.model is None:
            return [(UNKNOWN, 0.0, False)] * len(texts)
        out: list[tuple[str, float, bool]] = []
        for start in range(0, len(texts), batch):
            part = texts[start : start + batch]
            present = np.zeros((len(part), len(self.model.grams)), dtype=np.float32)
            sizes = np.ones(len(part))
            lettered = np.zeros(len(part), dtype=bool)
            for i, text in enumerate(part):
                flags = self.grams(text)
                if flags is not None:
                    lettered[i], sizes[i] = True, np.count_nonzero(flags)
                    present[i] = flags[self.model.grams]
            values = (present @ self.model.landmarks.T / np.sqrt(sizes)[:, None]) @ self.model.weights
            best = values.argmax(axis=1)
            score = np.clip((values.max(axis=1) + 1) / 2, 0, 1)
            known = self.known(present.sum(axis=1) / sizes, sizes, score)
            out += [
                (self.model.languages[b], float(s), bool(k)) if has else (UNKNOWN, 0.0, False)
                for b, s, k, has in zip(best, score, known, lettered, strict=True)
            ]
        return out

    def known(self, share: np.ndarray, sizes: np.ndarray, score: np.ndarray) -> np.ndarray:
        def limit(part: float) -> np.ndarray:
            least = part * self.model.least_known  # a letter is in three n-grams or more, so a third of them count as independent
            return least - DOUBT * np.sqrt(least * (1 - least) / (sizes / 3))

        return (share > 0) & (share >= limit(FAR)) & ((share >= limit(NEAR)) | (score >= FAR * self.model.least_score))


def sample(
    docs: DataFrame, usable: Column, per_language: int = PER_LANGUAGE, most: int = MOST, longest: int = LONGEST, few: int = FEW
) -> list:
    """Rows ``(lang, text)`` of the fitting sample, by rank; usable rows are ranked first, then only their texts read.

    Ranks are taken in two steps, so that no language meets in one task with all that tasks hand on.
    """
    rows = docs.where(usable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = ["long", "rank_hash", "doc_id"]
    ids = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("rank_hash"), (F.length("text") > longest).alias("long"))
    near = Window.partitionBy("lang", "salt").orderBy(*order)
    ids = ids.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    ids = ids.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= per_language).drop("rank", "salt")
    ids = ids.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ids = ids.withColumn("only_long", F.min("long").over(Window.partitionBy("lang")))
    ids = ids.where((F.col("rank") <= per_language) & (~F.col("long") | (F.col("only_long") & (F.col("rank") <= few))))
    ids = ids.orderBy("rank", "lang").limit(most)
    ids = ids.select(F.col("doc_id").alias("id"), F.col("lang").alias("of"), "rank", "only_long")
    found = rows.join(F.broadcast(ids), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("of")))
    found = found.where(F.col("only_long") | (F.length("text") <= longest)).select("lang", "text", "rank", "doc_id")
    return found.orderBy("rank", "lang", "doc_id", "text").limit(most).collect()


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", held_out: Column | None = None) -> Model | None:
    """A model of rows that are not ``held_out`` (a condition on doc_id)."""
    rows = pick(docs, doc_id=doc_id, text=text, lang=lang)
    usable = F.lit(True) if held_out is None else ~F.coalesce(held_out, F.lit(False))
    found = sample(rows, usable)
    return fit([r.text for r in found], [r.lang for r in found]) if found else None


class Sent:
    """A model on its way to the tasks; each worker sets it up once."""

    def __init__(self, spark, model: Model | None):
        self.key, self.model = uuid.uuid4().hex, spark.sparkContext.broadcast(model)

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        return once(self.key, lambda: Classifier(self.model.value)).judge(texts)


def identify(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every document, scored where it is read."""
    classify = Sent(docs.sparkSession, model)

    def derive(texts):
        found = classify(texts)
        return [pa.array([n for n, _, _ in found], pa.string()), pa.array([s for _, s, _ in found], pa.float64())]

    return per_text(pick(docs, doc_id=doc_id, text=text), "lang_pred string, score double", derive)


def known_language(docs: DataFrame, model: Model | None, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """Documents in a learned language, with all their columns; with letters, if none was learned."""
    if model is None:
        return filtered(docs, text, lambda texts: [any(c.isalpha() for c in t or "") for t in texts])
    classify = Sent(docs.sparkSession, model)
    return filtered(docs, text, lambda texts: [known and s >= least for _, s, known in classify(texts)])
