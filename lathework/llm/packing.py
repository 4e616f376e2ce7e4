"""Packing of token sequences into windows by Karmarkar-Karp multiway differencing.

A document's ids are cut into pieces of at most ``cut`` ids. Pieces are dealt by a hash of their place, so that equal ones part, into
blocks of about ``BLOCK`` pieces, so that a block is one bounded group however large the corpus
is. Within a block, differencing splits the pieces into windows of nearly equal sums: every
piece begins as a partition with one filled window; the two partitions with the largest
imbalance are merged time and again, the fullest window of one with the emptiest of the
other. If the fullest window is over the capacity, the number of windows rises and the block
is partitioned anew.

Defined cases: a null or empty text has the closing id alone; repeated rows are packed as
often as they occur; an empty table gives no pieces; further columns of the input are not read.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import operator
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.session import scratch_folder

CAPACITY = 2048
CUT = 512
BLOCK = 4096
CACHED_WORDS = 1_500_000
END_ID = 1
AHEAD = 1024
END_MARK = "</w>"

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"


#: ASCII marks but for the apostrophe and those of special tokens.
CLOSING = ".,;:!?)(*&%$#@-_+=/\\\"[]{}~`^"


def _latin(word: str) -> bool:
    """Letters whose lower case is one letter, the same in any library."""
    return word.isascii() or (max(word) < "\u0250" and "\u0130" not in word)


class WordIds:
    """The ids of blank-delimited words as little-endian unsigned 32-bit bytes.

    The tokenizer treats blanks and line feeds as white space that separates words, and
    nothing it does looks across white space, so a text's ids are its words' ids in order.
    It lower-cases letters and splits a word before punctuation that follows a letter or
    digit, so Latin capitals and closing marks need no entry of their own. Both tables
    begin anew beyond ``limit`` words.
    """

    def __init__(self, tokenizer: str, limit: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # of each id, whether it ends a word
        self.last[[i for piece, i in vocabulary.items() if piece.endswith(END_MARK)]] = True
        self.limit = limit
        self.words: dict[str, bytes] = {"": b""}
        self.stems: dict[str, bytes] = {"": b""}

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_stems(self, stems: list[str]) -> None:
        """Latin letters and digits in lower case are encoded many at a time, separated by blanks.

        A stem of letters alone is one word to the tokenizer, and a word's last id stands for a
        piece with the end mark, so the ids of a row of such stems are cut behind those. Stems with digits are cut by offsets.
        """
        alpha, plain, rest, marked = [], [], [], self.last.any()
        for stem in stems:
            if stem.isalnum() and (stem.isascii() or _latin(stem)) and stem.lower() == stem:
                (alpha if marked and stem.isalpha() else plain).append(stem)
            else:
                rest.append(stem)
        self.stems.update((s, self._encode(s)) for s in rest)
        for at in range(0, len(alpha), 2000):
            part = alpha[at:at + 2000]
            ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            if len(ends) != len(part):
                raise ValueError("a word of letters has no end mark of its own")
            raw = ids.tobytes()
            self.stems.update(zip(part, map(raw.__getitem__, map(slice, [0, *ends], ends))))
        for at in range(0, len(plain), 2000):
            part = plain[at:at + 2000]
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            raw = np.asarray(encoded.ids, dtype="<u4").tobytes()
            begins = np.cumsum([0, *(len(s) + 1 for s in part)])
            cuts = (4 * np.searchsorted([b for b, _ in encoded.offsets], begins)).tolist()
            self.stems.update(zip(part, map(raw.__getitem__, map(slice, cuts, cuts[1:]))))

    def _learn(self, unknown: set[str]) -> None:
        if len(self.words) + len(unknown) > self.limit:
            self.words, self.stems = {"": b""}, {"": b""}
        first, last = [], []
        for word in unknown:
            low = word.lower() if "<" not in word and _latin(word) else word
            stem = low.rstrip(CLOSING)
            if stem == low or not (stem[-1:].isalnum() and _latin(stem[-1])):
                first.append(low)
                last.append("")
            else:
                first.append(stem)
                last.append(low[len(stem):])
        self._learn_stems(list(set(first).union(last).difference(self.stems)))
        ids = self.stems.__getitem__
        self.words.update(zip(unknown, map(operator.add, map(ids, first), map(ids, last))))

    def ids(self, text: str) -> bytes:
        return self._joined(_split(text))

    def _joined(self, words: list[str]) -> bytes:
        if len(words) > self.limit // 2:  # one text may have more words than the table
            return b"".join(self._joined(words[at:at + self.limit // 2]) for at in range(0, len(words), self.limit // 2))
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            self._learn(set(words).difference(self.words))
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:  # the table began anew
            self._learn(set(words).difference(self.words))
        return b"".join(map(self.words.__getitem__, words))

    def batch(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; unknown words of ``AHEAD`` texts are learnt together."""
        for at in range(0, len(texts), AHEAD):
            some = [_split(t or "") for t in texts[at:at + AHEAD].to_pylist()]
            unknown = set(itertools.chain.from_iterable(some)).difference(self.words)
            if unknown and len(unknown) < self.limit // 2:
                self._learn(unknown)
            yield from map(self._joined, some)


def _split(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


@functools.lru_cache(maxsize=1)
def word_table(tokenizer: str, limit: int) -> WordIds:
    """One table for all tasks of a Python worker; it takes about 300 bytes a word."""
    import public_tokenizers

    return WordIds(public_tokenizers.path(tokenizer), limit)


def token_pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", cut: int = CUT, capacity: int = CAPACITY,
                 end_id: int = END_ID, with_ids: bool = False, cached_words: int = CACHED_WORDS) -> DataFrame:
    """Pieces of every document: full windows of ``capacity`` ids first, then the rest in pieces of at most ``cut`` ids.

    ``with_ids`` adds ``ids``, the piece's ids as little-endian unsigned 32-bit integers.
    """
    closing = np.asarray([end_id], dtype="<u4").tobytes()
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table(tokenizer, cached_words)
        for batch in batches:
            out: list[list] = [[] for _ in range(6 if with_ids else 5)]
            for doc_id, ids in zip(batch.column(0).to_pylist(), words.batch(batch.column(1))):
                ids += closing
                total = len(ids) // 4
                whole = total // capacity * capacity
                starts = [*range(0, whole, capacity), *range(whole, total, cut)]
                for start, end in zip(starts, [*starts[1:], total]):
                    piece = ids[4 * start:4 * end]
                    for column, value in zip(out, (doc_id, start, end - start, zlib.crc32(piece), total, piece)):
                        column.append(value)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(out)]
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(cut_up, schema)


def difference(lengths: np.ndarray, windows: int) -> list[list[int]]:
    """Karmarkar-Karp: the indices of ``lengths`` in ``windows`` sets of nearly equal sums.

    A partial partition holds its filled windows only, in descending order; the others are
    empty. Merging a descending list with the reverse of another one pairs opposite ends.
    """
    if windows <= 0 or not len(lengths):
        return []
    left: dict[int, int] = {}
    right: dict[int, int] = {}
    made = len(lengths)
    heap = [(-int(n), i, np.array([n], dtype=np.int64), np.array([i], dtype=np.int64)) for i, n in enumerate(lengths)]
    if windows == 1:
        return [list(range(len(lengths)))]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, others, more = heapq.heappop(heap)
        if len(others) > len(sums):
            sums, nodes, others, more = others, more, sums, nodes
        both = len(sums) + len(others) - windows
        if both > 0:  # the last windows of each side meet the other side's last in opposite order
            ends = np.arange(made, made + both)
            mine, theirs = slice(len(sums) - both, None), slice(len(others) - both, None)
            left.update(zip(ends.tolist(), nodes[mine].tolist()))
            right.update(zip(ends.tolist(), more[theirs][::-1].tolist()))
            made += both
            sums = np.concatenate([sums[:len(sums) - both], sums[mine] + others[theirs][::-1], others[:len(others) - both]])
            nodes = np.concatenate([nodes[:len(nodes) - both], ends, more[:len(more) - both]])
        else:
            sums, nodes = np.concatenate([sums, others]), np.concatenate([nodes, more])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        gap = int(sums[0]) - (int(sums[-1]) if len(sums) == windows else 0)
        heapq.heappush(heap, (-gap, serial, sums, nodes))
        serial += 1
    sets = []
    for node in heap[0][3].tolist():
        stack, members = [node], []
        while stack:
            top = stack.pop()
            if top in left:
                stack += (left[top], right[top])
            else:
                members.append(top)
        sets.append(sorted(members))
    return sets


def windows_of(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """As few nearly equal sets as differencing fits into ``capacity``; no length may exceed it."""
    windows = -(-int(lengths.sum()) // capacity)
    while True:
        sets = difference(lengths, windows)
        fullest = max((int(lengths[s].sum()) for s in sets), default=0)
        if fullest <= capacity:
            return sets
        windows = min(len(lengths), max(windows + 1, windows * fullest // capacity))


def pack_block(block: pd.DataFrame, capacity: int = CAPACITY) -> pd.DataFrame:
    block = block.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
    lengths = block["length"].to_numpy()
    full = int((lengths == capacity).sum())
    sets = [[i] for i in range(full)] + [[full + i for i in s] for s in windows_of(lengths[full:], capacity)]
    window = np.empty(len(block), dtype=np.int64)
    offset = np.empty(len(block), dtype=np.int64)
    for w, members in enumerate(sets):
        window[members] = w
        offset[members] = np.cumsum(lengths[members]) - lengths[members]
    return block.assign(sequence_id=(block["_block"].to_numpy() << 32) + window, offset=offset).drop(columns="_block")


def pack(pieces: DataFrame, count: int, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``count`` is their number."""
    blocks = max(1, -(-count // block))
    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64(F.monotonically_increasing_id(), "doc_id", "start"), F.lit(blocks)))
    return dealt.groupBy("_block").applyInPandas(lambda rows: pack_block(rows, capacity), PACKED)


def packed_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, cut: int = CUT, block: int = BLOCK,
                     cached_words: int = CACHED_WORDS) -> DataFrame:
    """Tokenise once into a table below the shared folder, then pack its pieces."""
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    token_pieces(docs, tokenizer, cut, capacity, cached_words=cached_words).write.parquet(folder)
    pieces = spark.read.schema(PIECES).parquet(folder)
    return pack(pieces, pieces.count(), capacity, block)
