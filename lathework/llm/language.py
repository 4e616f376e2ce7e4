"""Language identification by a byte convolutional network, trained and run in numpy.

The bytes of a lower-cased text are cut into windows of ``WINDOW`` places. Filters of widths
two, three and four read one-hot bytes, so a filter is a table of 256 weights for each of its
places; the largest answer of each filter in a window is rectified and feeds a softmax. A
text's logits are the mean over its windows, weighted by their filled places, so every byte
counts and nothing is cut off. For prediction neighbouring places share tables of byte pairs.

The fit sees at most ``per_language`` texts of each language (those with the smallest hashes
of doc_id), one stretch of ``STRETCH`` characters of each. Where the languages are so many that this passes
``MOST_ROWS`` together, they share these evenly; each keeps one text at least.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every
text if no language could be learnt; repeated rows are predicted alike; further columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTHS = (2, 3, 4)
FILTERS = 16
WINDOW = 128
AHEAD = max(WIDTHS) - 1
PER_LANGUAGE = 1_500
STRETCH = 600
BATCHES = 700
BATCH = 128
RATE = 0.02
AT_ONCE = 1024
HASHES = 1 << 40
MOST_ROWS = 1_500_000
UNKNOWN = "und"

WORD = re.compile(r"[^\W\d_]+")  # letters and numbers that are no digits


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # per width: width x 256 x FILTERS
    biases: np.ndarray  # len(WIDTHS) * FILTERS
    weights: np.ndarray  # len(WIDTHS) * FILTERS x languages
    offsets: np.ndarray


def to_bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def has_letter(text: str) -> bool:
    """Whether any character is a letter; fractions, superscripts and Roman numerals are not."""
    return any(any(map(str.isalpha, m.group())) for m in WORD.finditer(text))


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows in one row of bytes (with AHEAD more at the end), the text of each, its filled places."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], dtype=np.int64)
    out = np.zeros(int(counts.sum()) * WINDOW + AHEAD, dtype=np.uint8)
    begin = np.concatenate([[0], np.cumsum(counts)])
    filled = np.full(int(counts.sum()), WINDOW, dtype=np.float64)
    for i, t in enumerate(texts):
        at = int(begin[i]) * WINDOW
        out[at:at + len(t)] = np.frombuffer(t, dtype=np.uint8)
        if counts[i]:
            filled[begin[i + 1] - 1] = len(t) - WINDOW * (counts[i] - 1)
    return out, np.repeat(np.arange(len(texts)), counts), filled


class Reader:
    """A network with its tables joined into byte pairs, ready for long runs of windows."""

    def __init__(self, net: Network):
        self.net = net
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS).astype(np.float32)
        two, three, four = net.tables
        self.two = pair(two[0], two[1])
        self.three, self.three_last = pair(three[0], three[1]), three[2].astype(np.float32)
        self.four, self.four_last = pair(four[0], four[1]), pair(four[2], four[3])

    def pooled(self, data: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The rectified largest answer per window and filter.

        A window's last places read on into the next window of the same text, or into empty places.
        """
        n = len(owner)
        last = np.append(owner[1:] != owner[:-1], True)[:n]
        rows = np.lib.stride_tricks.sliding_window_view(data, WINDOW + AHEAD)[::WINDOW]
        out = np.empty((n, len(WIDTHS) * FILTERS), dtype=np.float32)
        for at in range(0, n, AT_ONCE):
            upto = min(n, at + AT_ONCE)
            b = rows[at:upto].astype(np.int32)
            b[last[at:upto], WINDOW:] = 0
            pairs = b[:, :-1] * 256 + b[:, 1:]
            first, later = pairs[:, :WINDOW], pairs[:, 2:]
            answers = (
                self.two[first],
                self.three[first] + self.three_last[b[:, 2:WINDOW + 2]],
                self.four[first] + self.four_last[later],
            )
            for i, a in enumerate(answers):
                out[at:upto, i * FILTERS:(i + 1) * FILTERS] = a.max(axis=1)
        return np.maximum(out + self.net.biases.astype(np.float32), 0)

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """One row per text; uniform for a text of no bytes."""
        data, owner, filled = windows(texts)
        logits = self.pooled(data, owner) @ self.net.weights + self.net.offsets
        total = np.zeros((len(texts), len(self.net.languages)))
        np.add.at(total, owner, logits * filled[:, None])
        total /= np.maximum(np.bincount(owner, filled, minlength=len(texts)), 1)[:, None]
        return softmax(total)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], languages: list[str], batches: int = BATCHES, seed: int = 7) -> Network | None:
    """Adam on windows of random places and lengths, languages drawn evenly; deterministic."""
    names = sorted(set(languages))
    by_language = [[b for t, l in zip(texts, languages) if l == name and (b := to_bytes(t))] for name in names]
    names = [n for n, own in zip(names, by_language) if own]
    by_language = [own for own in by_language if own]
    if not names:
        return None
    rng = np.random.default_rng(seed)
    wide = len(WIDTHS) * FILTERS
    params = {f"table{w}": rng.normal(0, 0.3, (w, 256, FILTERS)) for w in WIDTHS}
    params |= {"biases": np.zeros(wide), "weights": rng.normal(0, 0.1, (wide, len(names))), "offsets": np.zeros(len(names))}
    first, second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    for step in range(1, batches + 1):
        y = rng.integers(0, len(names), BATCH)
        data = np.zeros((BATCH, WINDOW + AHEAD), dtype=np.int64)
        for i, label in enumerate(y):
            own = by_language[label]
            text = own[rng.integers(0, len(own))]
            length = WINDOW if rng.random() < 0.6 else int(rng.integers(8, WINDOW))
            at = int(rng.integers(0, max(1, len(text) - length + 1)))
            part = text[at:at + length]
            data[i, :len(part)] = np.frombuffer(part, dtype=np.uint8)
        best, values = [], []
        for w in WIDTHS:
            table = params[f"table{w}"]
            answer = table[0][data[:, :WINDOW]]
            for k in range(1, w):
                answer = answer + table[k][data[:, k:WINDOW + k]]
            where = answer.argmax(axis=1)
            best.append(where)
            values.append(np.take_along_axis(answer, where[:, None, :], axis=1)[:, 0, :])
        raw = np.concatenate(values, axis=1) + params["biases"]
        hidden = np.maximum(raw, 0)
        error = softmax(hidden @ params["weights"] + params["offsets"])
        error[np.arange(BATCH), y] -= 1
        error /= BATCH
        back = (error @ params["weights"].T) * (raw > 0)
        slopes = {"weights": hidden.T @ error, "offsets": error.sum(axis=0), "biases": back.sum(axis=0)}
        rows = np.arange(BATCH)[:, None]
        filters = np.broadcast_to(np.arange(FILTERS), (BATCH, FILTERS))
        for i, w in enumerate(WIDTHS):
            slope = np.zeros((w, 256, FILTERS))
            for k in range(w):
                np.add.at(slope[k], (data[rows, best[i] + k], filters), back[:, i * FILTERS:(i + 1) * FILTERS])
            slopes[f"table{w}"] = slope
        rate = RATE * (1 - step / (batches + 1))
        for k, g in slopes.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            params[k] = params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Network(names, [params[f"table{w}"] for w in WIDTHS], params["biases"], params["weights"], params["offsets"])


def held_out(doc_id: Column) -> Column:
    """Documents nothing is learnt from; a document without an id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, per_language: int = PER_LANGUAGE, stretch: int = STRETCH, most_rows: int = MOST_ROWS) -> DataFrame:
    """``text`` and ``lang`` of at most ``per_language`` texts of each language, about ``most_rows`` together.

    The distinct texts of the languages are counted first; a threshold on the hash of doc_id and text, so that about twice as many texts as
    needed pass, keeps the ranking to a bounded number of rows of each language. Equal rows pass or
    fail together, so each language's least hash passes in any case, and only distinct rows are ranked.
    """
    mixed = F.pmod(F.xxhash64("doc_id", "text"), F.lit(HASHES))
    at = (F.pmod(F.xxhash64("doc_id", "text"), F.greatest(F.length("text") - stretch, F.lit(1))) + 1).cast("int")
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = labelled.groupBy("lang").agg(F.greatest(F.approx_count_distinct(mixed, 0.02), F.lit(1)).alias("_n"), F.min(mixed).alias("_least"))
    quota = F.least(F.lit(per_language), F.greatest(F.lit(1), F.floor(F.lit(most_rows) / F.col("_languages"))))
    share = counts.crossJoin(F.broadcast(counts.agg(F.count(F.lit(1)).alias("_languages")))).select(
        "lang", quota.alias("_quota"), F.greatest(F.ceil((2.0 * quota + 64) * F.lit(float(HASHES)) / F.col("_n")), F.col("_least") + 1).alias("_below"))
    part = labelled.join(F.broadcast(share), "lang").where(mixed < F.col("_below")).select(
        "doc_id", "lang", "_quota", mixed.alias("_mixed"), F.substring(F.col("text"), at, F.lit(stretch)).alias("text")).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_mixed", "doc_id", "text"))
    return part.withColumn("_rank", rank).where(F.col("_rank") <= F.col("_quota")).orderBy("lang", "_rank").select("text", "lang")


def fit_on(docs: DataFrame) -> Network | None:
    rows = labelled_sample(docs).collect()  # PER_LANGUAGE stretches of each language at most
    return fit([r.text for r in rows], [r.lang for r in rows])


def predicted(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of the whole ``text``; columns of these names are replaced."""
    kept = docs.drop("lang_pred", "score")
    names = kept.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(net) if net else None
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            ok = [i for i, t in enumerate(texts) if reader and t and has_letter(t)]
            tongues: list[str] = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            for group in _groups(ok, texts):
                chance = reader.probabilities([to_bytes(texts[i]) for i in group])
                best = chance.argmax(axis=1)
                for i, b, c in zip(group, best, chance):
                    tongues[i], scores[i] = net.languages[b], c[b]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tongues), pa.array(scores)], [*names, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)


def _groups(rows: list[int], texts: list[str], most: int = 2_000_000) -> Iterator[list[int]]:
    """Runs of rows with at most ``most`` characters together, or one longer text."""
    group, size = [], 0
    for i in rows:
        if group and size + len(texts[i]) > most:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(texts[i])
    if group:
        yield group
