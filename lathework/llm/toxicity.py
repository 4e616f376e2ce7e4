"""Toxicity scores by a counterfactual-regularised logistic classifier over words and stems.

Features are the words of a text and the beginnings of its longer words. Besides the usual
loss and ridge, the fit penalises the squared change of a labelled text's score when an
identity term in it is swapped for another one, or when one is added to a text without
any: the mention of a group alone then moves no score. A linear score changes by the
weights times the change in features, so the penalty is a quadratic form in the weights.

Only the fit looks at labels, over a sample of at most ``sample`` labelled documents of at most
``sample_chars`` characters (those with the smallest hashes of doc_id), so the driver holds a
bounded number of texts; scoring is one pass over whole texts of any length.

Defined cases: null and empty texts score as a text without any word; a table without
labelled rows, or with one class only, gives every text the (smoothed) share of toxic labels,
one half if there are none; repeated rows are scored alike; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 8_000
SAMPLE_CHARS = 20_000
HASHES = 1 << 40
STEMS = (5, 6, 7)
LEAST_DOCUMENTS = 4
MOST_FEATURES = 4_000
LEAST_CHI_SQUARE = 20.0
RIDGE = 1e-4
COUNTERFACTUAL = 1.0
ROUNDS = 200
BIAS, LENGTH = 0, 1

#: Mentions of groups that must not move a score.
IDENTITY_TERMS = [
    "women", "men", "woman", "man", "girls", "boys", "muslim", "muslims", "christian", "christians", "jewish", "jews",
    "hindu", "buddhist", "atheist", "black", "white", "asian", "african", "european", "american", "mexican", "arab",
    "gay", "lesbian", "bisexual", "transgender", "straight", "old", "young", "disabled", "deaf", "blind", "immigrant",
    "immigrants", "refugee", "refugees",
]

WORD = re.compile(r"\w+")


@dataclass
class Model:
    """Weights of features by name; ``word:`` a whole word, ``stem:`` a beginning."""

    weights: dict[str, float]
    bias: float
    length: float


def word_features(word: str) -> list[str]:
    return ["word:" + word, *("stem:" + word[:n] for n in STEMS if len(word) >= n)]


def word_counts(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


def _features(counts: Counter) -> dict[str, float]:
    totals: Counter = Counter()
    for word, n in counts.items():
        for name in word_features(word):
            totals[name] += n
    return totals


def counterfactual(counts: Counter, seed: int, terms: list[str]) -> Counter:
    """One identity term swapped for another; added where the text has none."""
    there = [t for t in terms if counts.get(t)]
    out = Counter(counts)
    other = terms[seed % len(terms)]
    if there:
        old = there[seed % len(there)]
        if old == other:
            other = terms[(seed + 1) % len(terms)]
        out[other] += out.pop(old)
    else:
        out[other] += 1
    return out


def _associated(texts: list[str], labels: list[int]) -> list[str]:
    """Features whose presence goes with the label, by the chi-square of the 2 x 2 table, most first."""
    seen: Counter = Counter()
    toxic: Counter = Counter()
    for text, label in zip(texts, labels):
        present = {f for w in word_counts(text) for f in word_features(w)}
        seen.update(present)
        if label:
            toxic.update(present)
    n, t = len(texts), sum(labels)
    found = []
    for f, m in seen.items():
        if m >= LEAST_DOCUMENTS and m < n:
            chi = n * (toxic[f] * n - m * t) ** 2 / (m * (n - m) * t * (n - t))
            if chi >= LEAST_CHI_SQUARE:
                found.append((-chi, f))
    return [f for _, f in sorted(found)[:MOST_FEATURES]]


class _Rows:
    """A sparse matrix of rows of (feature, value), in three arrays."""

    def __init__(self, rows: list[list[tuple[int, float]]]):
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.column = np.array([c for r in rows for c, _ in r], dtype=np.int64)
        self.value = np.array([v for r in rows for _, v in r], dtype=np.float64)
        self.height = len(rows)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], minlength=self.height)

    def transposed_times(self, r: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, self.value * r[self.row], minlength=width)


def _difference(a: list[tuple[int, float]], b: list[tuple[int, float]]) -> list[tuple[int, float]]:
    out: Counter = Counter()
    for c, v in a:
        out[c] += v
    for c, v in b:
        out[c] -= v
    return [(c, v) for c, v in out.items() if v]


def fit(texts: list[str], labels: list[int], terms: list[str] = IDENTITY_TERMS, ridge: float = RIDGE,
        penalty: float = COUNTERFACTUAL, rounds: int = ROUNDS) -> Model:
    """Accelerated gradient descent with a diagonal scale; deterministic."""
    toxic = sum(labels)
    if toxic in (0, len(labels)):
        share = (toxic + 1) / (len(labels) + 2)
        return Model({}, float(np.log(share / (1 - share))), 0.0)
    wanted = sorted({f for t in terms for f in word_features(t)})
    index = {f: i + 2 for i, f in enumerate(dict.fromkeys([*_associated(texts, labels), *wanted]))}

    def row(counts: Counter) -> list[tuple[int, float]]:
        known = ((index[f], n) for f, n in _features(counts).items() if f in index)
        return [(BIAS, 1.0), (LENGTH, float(np.log1p(counts.total()))), *((i, float(np.log1p(n))) for i, n in known)]

    rows, changes = [], []
    for i, text in enumerate(texts):
        counts = word_counts(text)
        rows.append(row(counts))
        changes.append(_difference(rows[-1], row(counterfactual(counts, i, terms))))
    x, d, y = _Rows(rows), _Rows(changes), np.array(labels, dtype=np.float64)
    width, n = len(index) + 2, len(rows)
    ridges = np.full(width, ridge)
    ridges[BIAS] = 0
    curve = np.bincount(x.column, x.value**2, minlength=width) / (4 * n) + 2 * penalty * np.bincount(d.column, d.value**2, minlength=width) / n + ridges
    scale = 1 / np.sqrt(curve + 1e-6)
    w = v = np.zeros(width)
    step = 1.0

    def loss(u: np.ndarray) -> tuple[float, np.ndarray]:
        z, e = x.times(u), d.times(u)
        value = np.mean(np.logaddexp(0, z) - y * z) + penalty * np.mean(e**2) + 0.5 * np.sum(ridges * u**2)
        slope = x.transposed_times((0.5 * (1 + np.tanh(z / 2)) - y) / n, width) + d.transposed_times(2 * penalty * e / n, width) + ridges * u
        return float(value), slope

    momentum = 1.0
    for _ in range(rounds):
        value, slope = loss(v)
        move = scale * scale * slope
        while step > 1e-9:
            new = v - step * move
            if loss(new)[0] <= value - 0.5 * step * float(slope @ move):
                break
            step /= 2
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v = new + (momentum - 1) / following * (new - w)
        w, momentum, step = new, following, step * 1.1
    names = {f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-6}
    return Model(names, float(w[BIAS]), float(w[LENGTH]))


def beginnings(model: Model) -> frozenset[str]:
    """The first letters of all features' words; a word that begins otherwise has no feature."""
    return frozenset(f.split(":", 1)[1][:STEMS[0]] for f in model.weights)


def score_counts(model: Model, counts: Counter, begins: frozenset[str] | None = None) -> float:
    begins = beginnings(model) if begins is None else begins
    totals: Counter = Counter()
    for word, n in counts.items():
        if word[:STEMS[0]] in begins:
            for f in word_features(word):
                if f in model.weights:
                    totals[f] += n
    z = model.bias + model.length * np.log1p(counts.total()) + sum(model.weights[f] * np.log1p(n) for f, n in sorted(totals.items()))
    return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def held_out(doc_id: Column) -> Column:
    """Documents nothing is learnt from; a document without an id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """``text`` and ``toxic`` of at most ``sample`` labelled documents that are not held out.

    A document labelled more than once is toxic if any label says so; of several texts under
    one id the smallest is taken.
    """
    judged = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    mixed = F.pmod(F.xxhash64("doc_id"), F.lit(HASHES))
    # about twice the sample passes, so that no more than that is sorted
    few = judged.where(mixed <= F.lit(min(HASHES, (2 * sample + 1000) * HASHES // max(judged.count(), 1))))
    chosen = few.orderBy(mixed, "doc_id").limit(sample)
    short = docs.where(F.length("text") <= sample_chars).select("doc_id", "text")
    return (
        short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .orderBy("doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    )


def fit_on(docs: DataFrame, labels: DataFrame, terms: list[str] = IDENTITY_TERMS) -> Model:
    rows = labelled_sample(docs, labels).collect()  # SAMPLE rows at most
    return fit([r.text for r in rows], [r.toxic for r in rows], terms)


def scored(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the score of the whole ``text``; a column of that name is replaced."""
    kept = docs.drop(out)
    names = kept.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + f", `{out}` double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = beginnings(model)
        for batch in batches:
            scores = [score_counts(model, word_counts(t.as_py()), begins) for t in batch.column(names.index("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, out])

    return kept.mapInArrow(score, schema)
