"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a classifier decides.

One pass over whole texts finds the base spans (fixed patterns and checks) and further
candidates, and lets five labelers vote on each: shape, check (checksum or range), gazetteer,
context and code-like surroundings. A vote is yes, no or none. The votes of all documents
are counted by pattern; expectation-maximisation over these counts estimates, for each kind,
how reliable each labeler is and how likely each pattern marks personal data. A logistic
classifier of span and context features learns from these probabilities on a bounded
sample and settles every candidate. Base spans always stay.

Every search is linear in the text, whatever runs of digits or letters it holds.

Defined cases: null and empty texts have no span; repeated rows are treated alike; with
no candidate anywhere the classifier is empty and adds nothing; further columns are kept by
``redacted`` and not read by ``found``.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.session import scratch_folder

KINDS = ["email", "ip", "card", "phone", "id", "person"]
BASE_KINDS = KINDS[:4]
SAMPLE = 20_000
HASHES = 1 << 40
EM_ROUNDS = 60
AROUND = 40
KEEP_AT = 0.5

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SPOKEN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z]{2,24}")
LONG_IP = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
LOCAL_PHONE = re.compile(r"(?<![\w+.-])\(?[0-9]{2,4}\)?(?:[\x20./-][0-9]{2,4}){2,4}(?![\w-])")
PERSON_ID = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
NAME = re.compile(r"\.?\x20([A-Z][a-zà-ÿ]{1,20})(\x20[A-Z][a-zà-ÿ]{1,20})?")

#: Titles that stand before names.
TITLES = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora"]
#: Common given names.
GIVEN_NAMES = frozenset([
    "James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda", "David", "Elizabeth", "William", "Susan",
    "Thomas", "Sarah", "Peter", "Anna", "Hans", "Ursula", "Klaus", "Monika", "Pierre", "Marie", "Jean", "Sophie", "Carlos",
    "Carmen", "José", "Lucía", "Juan", "Laura", "Paul", "Julia", "Martin", "Claire", "Antonio", "Elena",
])
#: Whole words near personal data of a kind.
CUES = {
    "email": frozenset(["mail", "email", "contact", "correo", "write", "reach"]),
    "ip": frozenset(["ip", "ipv4", "ipv6", "host", "server", "address", "client", "login"]),
    "card": frozenset(["card", "visa", "credit", "karte", "carte", "tarjeta", "payment"]),
    "phone": frozenset(["phone", "telephone", "cell", "call", "tel", "mobile", "fax", "telefon", "teléfono", "téléphone", "handy"]),
    "id": frozenset(["ssn", "social", "security", "passport", "id", "identity"]),
    "person": frozenset(["name", "called", "signed", "dear", "regards", "author"]),
}
#: Ends of host names in wide use that are longer than a country's two letters.
DOMAIN_ENDS = frozenset("com org net edu gov mil int info biz name pro museum aero coop jobs mobi travel arpa app dev cloud online site shop blog xyz".split())
WORDS = re.compile(r"[^\W_]+")
CODE = re.compile(r"[=\"'<>{}\[\]/\\#_]|version|isbn|order|token|hash|uuid", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Outwards from every @: the local part is the run of its letters before it, after the last match."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans by kind, leftmost and not overlapping within a kind."""
    return {
        "email": emails(text) if "@" in text else [],
        "ip": [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if _is_card(m.group())],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= _digits(m.group()) <= 15] if "+" in text else [],
    }


def _digits(s: str) -> int:
    return sum(c in "0123456789" for c in s)


def _is_card(s: str) -> bool:
    if len(s) > 37:  # 19 digits and 18 separators
        return False
    digits = s.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits)


def further_candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans of wider patterns, which only the classifier may turn into personal data."""
    out = []
    if "at)" in text or "at]" in text:
        out += [("email", *m.span()) for m in SPOKEN_EMAIL.finditer(text)]
    if text.count(":") >= 7:
        out += [("ip", *m.span()) for m in LONG_IP.finditer(text)]
    for m in CARD.finditer(text):
        if len(m.group()) <= 37 and 13 <= _digits(m.group()) <= 19 and not _is_card(m.group()):
            out.append(("card", *m.span()))
    if "-" in text or "." in text or "(" in text:
        out += [("phone", *m.span()) for m in LOCAL_PHONE.finditer(text) if 9 <= _digits(m.group()) <= 15]
    if "-" in text:
        out += [("id", *m.span()) for m in PERSON_ID.finditer(text)]
    for title in TITLES:
        at = text.find(title)
        while at >= 0:
            end = at + len(title)
            if (at == 0 or not text[at - 1].isalnum()) and (m := NAME.match(text, end)):
                out.append(("person", m.start(1), m.end()))
                end = m.end()
            at = text.find(title, end)
    return out


def _whole(text: str, begin: int, end: int) -> str:
    """The lower-cased words that lie whole between the places."""
    end = min(end, len(text))
    while 0 < begin < end and text[begin].isalnum() and text[begin - 1].isalnum():
        begin += 1
    while begin < end < len(text) and text[end].isalnum() and text[end - 1].isalnum():
        end -= 1
    return text[begin:end].lower()


def votes(kind: str, text: str, start: int, end: int, base: bool) -> str:
    """One letter per labeler: y, n or - for none."""
    span = text[start:end]
    before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
    near = _whole(text, max(0, start - AROUND), start) + " " + _whole(text, end, end + AROUND)
    digits = "".join(c for c in span if c in "0123456789")
    if kind == "card":
        check = "y" if luhn(digits) else "n"
    elif kind == "id":
        check = "n" if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else "y"
    elif kind == "phone":
        check = "y" if 10 <= len(digits) <= 12 else "n"
    elif kind == "ip":
        check = "n" if span.startswith(("0.", "127.")) else "y"
    else:
        check = "-"
    if kind == "email":
        end = re.split(r"[.\x20)\]]", span)[-1].lower()
        gazetteer = "y" if end in DOMAIN_ENDS or (len(end) == 2 and end.isalpha()) else "n" if end.isdigit() else "-"
    elif kind == "person":
        gazetteer = "y" if span.split(" ")[0] in GIVEN_NAMES else "-"
    else:
        gazetteer = "-"
    context = "y" if CUES[kind].intersection(WORDS.findall(near)) else "-"
    code = "n" if CODE.search(before[-8:] + " " + after[:3]) else "-"
    return ("y" if base else "n" if kind == "card" else "-") + check + gazetteer + context + code


def features(kind: str, text: str, start: int, end: int, vote: str) -> list[str]:
    span = text[start:end]
    shape = re.sub(r"9+", "9", re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]+", "a", span)))[:24]
    words = text[max(0, start - AROUND):start].lower().split()[-2:]
    return [kind, f"{kind} shape {shape}", f"{kind} digits {min(20, _digits(span))}", f"{kind} length {min(40, len(span)) // 4}",
            *(f"{kind} after {w[:12]}" for w in words), *(f"{kind} vote {i}{v}" for i, v in enumerate(vote))]


def look(text: str | None) -> list[tuple[str, int, int, bool, str, list[str]]]:
    """All candidates of a text: kind, start, end, whether base, votes and features."""
    if not text:
        return []
    base = base_spans(text)
    spans = [(k, s, e, True) for k in BASE_KINDS for s, e in base[k]]
    begins, ends = [], []
    for s, e in sorted((s, e) for _, s, e, _ in spans):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            begins.append(s)
            ends.append(e)
    for kind, s, e in further_candidates(text):
        i = bisect.bisect_right(ends, s)
        if i == len(begins) or begins[i] >= e:
            spans.append((kind, s, e, False))
    out = []
    for kind, s, e, is_base in spans:
        vote = votes(kind, text, s, e, is_base)
        out.append((kind, s, e, is_base, vote, features(kind, text, s, e, vote)))
    return out


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.string()), ("features", pa.list_(pa.string()))])
SPAN_SQL = "array<struct<kind:string,start:bigint,end:bigint,base:boolean,votes:string,features:array<string>>>"


def with_candidates(docs: DataFrame, keep: list[str], out: str = "candidates") -> DataFrame:
    """``keep`` and ``out`` of every row of ``docs``; reads ``text``."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    names = [*keep, "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "base", "votes", "features"), c)) for c in look(t.as_py())] for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(SPAN))], [*keep, out])

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), f"`{out}` {SPAN_SQL}"])
    return docs.select(*keep, F.col("text").cast("string").alias("_text")).toDF(*names).mapInArrow(run, schema)


def reliabilities(counts: dict[tuple[str, str], int], rounds: int = EM_ROUNDS) -> dict[tuple[str, str], float]:
    """The probability of each (kind, votes) pattern, by expectation-maximisation for two classes per kind.

    A labeler is described by its chances of each vote given the class, smoothed by a prior that
    expects a vote to be right nine times out of ten.
    """
    out: dict[tuple[str, str], float] = {}
    for kind in {k for k, _ in counts}:
        patterns = sorted(v for k, v in counts if k == kind)
        n = np.array([counts[kind, v] for v in patterns], dtype=float)
        codes = np.array([["yn-".index(c) for c in v] for v in patterns])
        p = np.array([(1 + 2 * v.count("y")) / (2 + 2 * (v.count("y") + v.count("n"))) for v in patterns])
        prior = np.array([[9.0, 1.0, 5.0], [1.0, 9.0, 5.0]])  # votes y, n, none of personal data and of others
        for _ in range(rounds):
            chance = np.clip(((p * n).sum() + 2) / (n.sum() + 4), 0.02, 0.98)
            logs = [np.log(chance), np.log(1 - chance)]
            for j in range(codes.shape[1]):
                for c, weight in ((0, p * n), (1, (1 - p) * n)):
                    table = prior[c] + np.bincount(codes[:, j], weight, minlength=3)
                    logs[c] = logs[c] + np.log(table / table.sum())[codes[:, j]]
            p = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -500, 500)))
        out.update({(kind, v): float(x) for v, x in zip(patterns, p)})
    return out


@dataclass
class Classifier:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -2.0

    def probability(self, names: list[str]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(self.weights.get(f, 0.0) for f in names), -500, 500))))


def fit_classifier(rows: list[list[str]], targets: list[float], times: list[int], ridge: float = 1e-3, rounds: int = 400) -> Classifier:
    """Logistic regression on soft labels by accelerated gradient descent; a row counts by the root of its ``times``."""
    if not rows:
        return Classifier()
    seen: Counter = Counter()
    for r, k in zip(rows, times):
        seen.update(dict.fromkeys(r, k))
    index = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= 3))}
    weight = np.sqrt(np.array(times, dtype=float))
    weight /= weight.mean()
    at = np.array([(i, index[f]) for i, r in enumerate(rows) for f in set(r) if f in index], dtype=np.int64).reshape(-1, 2)
    y, n = np.array(targets), len(rows)
    w = v = np.zeros(len(index) + 1)
    step = 4.0 / ((1 + max(len(set(r)) for r in rows)) * weight.max())
    for k in range(rounds):
        z = v[-1] + np.bincount(at[:, 0], v[at[:, 1]], minlength=n)
        error = weight * (0.5 * (1 + np.tanh(z / 2)) - y)
        slope = np.append(np.bincount(at[:, 1], error[at[:, 0]], minlength=len(index)), error.sum()) / n
        slope[:-1] += ridge * v[:-1]
        new = v - step * slope
        v, w = new + k / (k + 3) * (new - w), new
    return Classifier({f: float(w[i]) for f, i in index.items()}, float(w[-1]))


def _written(df: DataFrame) -> DataFrame:
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def learn(candidates: DataFrame, column: str = "candidates", sample: int = SAMPLE) -> Classifier:
    """Vote patterns are counted over all documents; their number is bounded by kinds and labelers."""
    spans = candidates.select(F.explode(column).alias("c"))
    counted = spans.groupBy("c.kind", "c.votes").count().collect()
    chance = reliabilities({(r["kind"], r["votes"]): r["count"] for r in counted})
    distinct = _written(spans.groupBy("c.kind", "c.votes", "c.features").count())
    mixed = F.pmod(F.xxhash64("kind", "votes", "features"), F.lit(HASHES))
    # about twice the sample passes, so that no more than that is sorted and sent
    few = distinct.where(mixed <= F.lit(min(HASHES, (2 * sample + 1000) * HASHES // max(distinct.count(), 1))))
    rows = few.orderBy(mixed, "kind", "votes", "features").limit(sample).collect()
    return fit_classifier([r["features"] for r in rows], [chance[r["kind"], r["votes"]] for r in rows], [r["count"] for r in rows])


def settled(candidates: list[dict], classifier: Classifier, at: float = KEEP_AT) -> list[tuple[str, int, int]]:
    """Base spans and the candidates the classifier takes, by kind as listed, then start."""
    kept = [(c["kind"], c["start"], c["end"]) for c in candidates if c["base"] or classifier.probability(c["features"]) >= at]
    return sorted(set(kept), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def found(docs: DataFrame) -> tuple[DataFrame, Classifier]:
    """``doc_id`` and ``candidates`` of all rows, in a table below the shared folder, and the classifier they teach."""
    table = _written(with_candidates(docs, ["doc_id"]))
    return table, learn(table)


def with_spans(candidates: DataFrame, classifier: Classifier) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` as ``kind:start:end`` lists, and the base counts by kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            base, spans, counts = [], [], [[] for _ in BASE_KINDS]
            for row in batch.column(1).to_pylist():
                row = row or []
                base.append([f"{c['kind']}:{c['start']}:{c['end']}" for c in row if c["base"]])
                spans.append([f"{k}:{s}:{e}" for k, s, e in settled(row, classifier)])
                for kind, column in zip(BASE_KINDS, counts):
                    column.append(sum(c["base"] and c["kind"] == kind for c in row))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.string()))],
                ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base", "spans"])

    kind = candidates.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in BASE_KINDS)
    return candidates.select("doc_id", "candidates").mapInArrow(run, f"doc_id {kind}, {counts}, base array<string>, spans array<string>")


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """Overlapping spans become one mark, that of the span that begins first."""
    if not spans:
        return text
    out, end = [], 0
    for kind, start, stop in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= end:
            out += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join(out) + text[end:]


def redacted(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; all columns and rows stay."""
    names = docs.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t in batch.column(place):
                text = t.as_py()
                rows = [dict(zip(("kind", "start", "end", "base", "votes", "features"), c)) for c in look(text)]
                texts.append(redact(text, settled(rows, classifier)))
            columns = list(batch.columns)
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
