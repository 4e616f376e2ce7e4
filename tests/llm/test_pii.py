from __future__ import annotations

import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from lathework.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The base patterns as they are written down."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1]))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(alphabet="ab1209.@+-() %é٣", max_size=60), st.text(alphabet="4111 -.+5", max_size=60), st.from_regex(EMAIL), st.from_regex(IP), st.from_regex(PHONE)))
def test_base_spans(text):
    found = pii.base_spans(text)
    assert [(k, *s) for k in pii.BASE_KINDS for s in found[k]] == plain(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "(1" * 150_000):
        begin = time.time()
        pii.look(text)
        assert time.time() - begin < 10


def test_expectation_maximisation_finds_the_unreliable_labeler():
    counts = {("phone", "yyyy-"): 500, ("phone", "nnnn-"): 500, ("phone", "yyyyn"): 480, ("phone", "nnnyn"): 40, ("phone", "yynyn"): 40}
    chance = pii.reliabilities(counts)
    assert chance["phone", "yyyy-"] > 0.9 > 0.1 > chance["phone", "nnnn-"]


def test_candidates_with_cues_are_added_and_others_left(spark):
    rows = [(i, f"please call my phone 555-20{i % 10}-{1000 + i} today, mail a{i}@b.org") for i in range(60)]
    rows += [(100 + i, f"please call phone +1 555 20{i % 10} {1000 + i} now") for i in range(60)]
    rows += [(200 + i, f"order token=\"4111111111{100000 + i}\" shipped") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    table, classifier = pii.found(docs)
    out = {r.doc_id: r for r in pii.with_spans(table, classifier).collect()}
    assert all(any(s.startswith("phone") for s in out[i].spans) for i in range(60))
    assert all(set(out[i].base) <= set(out[i].spans) for i in out)
    assert all(len(out[200 + i].spans) == len(out[200 + i].base) for i in range(60))
    clean = {r.doc_id: r.text for r in pii.redacted(docs, classifier).collect()}
    assert clean[0] == "please call my phone [PHONE] today, mail [EMAIL]"


def test_redaction_merges_overlaps():
    assert pii.redact("abcdefgh", [("ip", 1, 4), ("card", 3, 6)]) == "a[IP]gh"
    assert pii.redact(None, []) is None and pii.redact("", []) == ""


def test_driver_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    table, classifier = pii.found(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.with_spans(table, classifier).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert r.base == [f"{k}:{s}:{e}" for k, s, e in want]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in pii.BASE_KINDS]


def test_odd_and_empty(odd_documents, no_documents):
    table, classifier = pii.found(odd_documents)
    assert [(r.base, r.spans) for r in pii.with_spans(table, classifier).collect()] == [([], [])] * 10
    assert sorted(map(repr, pii.redacted(odd_documents, classifier).collect())) == sorted(map(repr, odd_documents.collect()))
    table, classifier = pii.found(no_documents)
    assert pii.with_spans(table, classifier).count() == 0
