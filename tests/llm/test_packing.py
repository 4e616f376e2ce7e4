from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lathework.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
TABLE = packing.WordIds(PATH)


def ids(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aAbÉéß1²٣.,'!?;:*<|>endoftxs \n\tΣİÍ’́\x1c\x85", max_size=60))
def test_words_give_the_ids_of_the_whole_text(text):
    assert np.frombuffer(TABLE.ids(text), "<u4").tolist() == ids(text)


def test_special_tokens_and_small_tables():
    text = "a<|endoftext|>b <|ENDOFTEXT|> it's, don't. 12.5, x" + " ".join(f" w{i}" for i in range(90))
    assert np.frombuffer(packing.WordIds(PATH, limit=20).ids(text), "<u4").tolist() == ids(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.integers(1, 12))
def test_differencing_keeps_every_piece_once(lengths, windows):
    sets = packing.difference(np.array(lengths, dtype=np.int64), windows)
    assert sorted(i for s in sets for i in s) == list(range(len(lengths)))
    assert len(sets) <= windows


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_no_window_is_over_its_capacity(lengths):
    array = np.array(lengths, dtype=np.int64)
    sets = packing.windows_of(array, 100)
    assert all(0 < array[s].sum() <= 100 for s in sets)
    assert sorted(i for s in sets for i in s) == list(range(len(lengths)))


def test_windows_are_nearly_equal():
    array = np.random.default_rng(1).integers(1, 512, 2000)
    sums = [int(array[s].sum()) for s in packing.windows_of(array)]
    assert max(sums) <= 2048 and max(sums) - min(sums) < 60


def checked(docs, packed, texts):
    rows = packed.collect()
    by_sequence, by_document = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_document.setdefault(r.doc_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    for doc_id, pieces in by_document.items():
        whole = [*ids(texts[doc_id] or ""), 1]
        assert {p.doc_tokens for p in pieces} == {len(whole)}
        spans = sorted({(p.start, p.length, p.ids_crc32) for p in pieces})
        assert sum(n for _, n, _ in spans) == len(whole)
        for start, length, crc in spans:
            assert crc == zlib.crc32(np.array(whole[start:start + length], dtype="<u4").tobytes())
    return rows


def test_odd_documents(odd_documents):
    texts = {r.doc_id: r.text for r in odd_documents.collect()}
    rows = checked(odd_documents, packing.packed_documents(odd_documents, block=3), texts)
    assert len([r for r in rows if r.doc_id == 8]) == 2
    assert {r.length for r in rows if r.doc_id in (2, 3, 4)} == {1}


def test_no_documents(no_documents):
    assert packing.packed_documents(no_documents).count() == 0


@pytest.mark.parametrize("block", [64, 4096])
def test_little_padding(spark, block):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = checked(docs, packing.packed_documents(docs, block=block), texts)
    filled = sum(r.length for r in rows)
    windows = len({r.sequence_id for r in rows})
    assert filled / (2048 * windows) > (0.97 if block == 4096 else 0.85)


def test_equal_rows_are_dealt_over_blocks(spark):
    pieces = spark.range(20_000).selectExpr("1L AS doc_id", "0L AS start", "300L AS length", "5L AS ids_crc32", "300L AS doc_tokens")
    out = packing.pack(pieces, 20_000)
    blocks = out.groupBy((out["sequence_id"] / 2**32).cast("int")).count().collect()
    assert len(blocks) == 5 and max(r["count"] for r in blocks) < 4_500
