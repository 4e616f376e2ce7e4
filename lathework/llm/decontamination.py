"""Benchmark decontamination by greedy string tiling.

Texts are compared as lower-cased words; in scripts written without blanks every character is a
word. A seed is ``SEED`` words in a row, or the whole of a shorter item; its running
Karp-Rabin hash is a polynomial in the words' hashes. Seeds of the benchmark set bits in a
bitmap that grows with their number. One pass over the documents keeps the runs of words whose seeds hit the
bitmap: every tile lies in such a run, so nothing else of a document travels. A join on each item's rarest seeds gives
the pairs of document and item that may reach the threshold, and tiling settles them: the longest
unmarked match is marked on both sides, time and again, until none of ``SEED`` words is left.
The covered share of the item decides, so passages in another order are found as well.

Defined cases: null and empty texts match nothing; an item of fewer than ``SEED`` words is found
where all its words stand in a row; repeated documents are found as often as they occur (once per
doc_id and item, with the larger coverage, if they share an id); a document without an id
cannot be named by ``contaminated``, but ``clean_documents`` drops it like any other; empty tables give no rows; further columns are kept by
``clean_documents`` and not read by ``contaminated``.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.session import scratch_folder

SEED = 5
COVERAGE = 0.5
BITS_PER_SEED = 64
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28  # of the bitmap: 128 KB to 32 MB
MOST_CACHED = 150_000
BASE = np.uint64(0x9E3779B97F4A7C15)

#: Han, kana, bopomofo, Thai, Lao, Myanmar, Khmer, Tai scripts and their marks.
UNSPACED = (
    "\u0e01-\u0e3a\u0e40-\u0e4e\u0e50-\u0e59\u0e81-\u0edf\u1000-\u1049\u1050-\u109f\u1780-\u17d3\u17d7\u17dc-\u17e9\u1950-\u19da\u1a20-\u1a99"
    "\u3005-\u3007\u3021-\u302f\u3031-\u3035\u3038-\u303c\u3041-\u309a\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\ua9e0-\ua9fe\uaa60-\uaadd\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff")
WORD = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
RUNS = "array<array<bigint>>"


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_CACHED:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return out


def word_hashes(text: str | None, cache: WordHashes) -> np.ndarray:
    words = WORD.findall((text or "").lower())
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def seed_hashes(words: np.ndarray, seed: int = SEED) -> np.ndarray:
    """The hash of every ``seed`` words in a row, modulo 2 ** 64."""
    if len(words) < seed:
        return np.empty(0, dtype=np.uint64)
    out = np.full(len(words) - seed + 1, seed, dtype=np.uint64)
    for i in range(seed):
        out = out * BASE + words[i:len(words) - seed + 1 + i]
    return out ^ (out >> np.uint64(32))


def tile(item: np.ndarray, runs: list[np.ndarray], seed: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (item position, place in the joined runs, length) by greedy string tiling, longest first.

    Runs are joined with a gap that no tile crosses.
    """
    begins, at = [], 0
    for run in runs:
        begins.append(at)
        at += len(run) + 1
    places: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for r, run in enumerate(runs):
        for j, h in enumerate(seed_hashes(run, seed).tolist()):
            places[h].append((r, j))
    heap = []
    for i, h in enumerate(seed_hashes(item, seed).tolist()):
        for r, j in places.get(h, ()):
            run = runs[r]
            if i and j and item[i - 1] == run[j - 1]:
                continue  # part of a match that begins earlier
            n = min(len(item) - i, len(run) - j)
            differ = np.flatnonzero(item[i:i + n] != run[j:j + n])
            n = int(differ[0]) if len(differ) else n
            if n >= seed:
                heap.append((-n, i, begins[r] + j))
    heapq.heapify(heap)
    marked, used, tiles = np.zeros(len(item), dtype=bool), np.zeros(max(at, 1), dtype=bool), []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        taken = marked[i:i + n] | used[j:j + n]
        if not taken.any():
            marked[i:i + n] = used[j:j + n] = True
            tiles.append((i, j, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):  # what no tile covers yet
            if end - begin >= seed:
                heapq.heappush(heap, (begin - end, i + begin, j + begin))
    return tiles


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once below the shared folder."""
    spark = df.sparkSession
    folder = scratch_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def hashed_items(benchmark: DataFrame, seed: int = SEED) -> DataFrame:
    """``item_id``, ``words``, the ``length`` of its seeds, its distinct ``seeds`` and how many ``places`` each has, of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            words = [word_hashes(t.as_py(), cache) for t in batch.column(1)]
            lengths = [min(seed, len(w)) for w in words]
            seeds, places = zip(*(np.unique(seed_hashes(w, n) if n else w, return_counts=True) for w, n in zip(words, lengths))) if words else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int32()), *(pa.array([x.view(np.int64) for x in c], pa.list_(pa.int64())) for c in (words, seeds, places))],
                ["item_id", "length", "words", "seeds", "places"])

    plain = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "item_id bigint, length int, words array<bigint>, seeds array<bigint>, places array<bigint>")


def seed_bitmap(items: DataFrame, least: int = LEAST_BITS, most: int = MOST_BITS) -> np.ndarray:
    """Bits of all seeds, eight a byte, gathered as 64-bit words: one row a word at most reaches the driver.

    There are ``BITS_PER_SEED`` times as many bits as seeds, as far as ``most`` allows, so about one other word in so many passes.
    """
    seeds = items.agg(F.sum(F.size("seeds"))).first()[0] or 0
    bits = min(max(1 << (BITS_PER_SEED * seeds).bit_length(), least), most)
    words = (
        items.select(F.explode("seeds").alias("seed")).select(F.pmod("seed", F.lit(bits)).alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask"))
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    for word, mask in words.collect():
        out[word] = mask
    return out.view(np.uint8)


def hit_runs(docs: DataFrame, bitmap: np.ndarray, lengths: Sequence[int] = (SEED,)) -> DataFrame:
    """``doc_id``, distinct ``runs`` of word hashes, how often each occurs (``copies``) and their distinct ``seeds`` of all ``lengths``, for documents that hit the bitmap."""
    packed = docs.sparkSession.sparkContext.broadcast(bitmap)  # MOST_BITS / 8 bytes at most
    bits = 8 * len(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, there = WordHashes(), packed.value
        for batch in batches:
            ids, runs, copies, seeds = [], [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = word_hashes(text.as_py(), cache)
                found, held = [], np.zeros(len(words) + 1, dtype=np.int32)  # +1 where a hit begins, -1 behind its end
                for n in lengths:
                    hashes = seed_hashes(words, n)
                    bit = np.mod(hashes.view(np.int64), bits)
                    at = np.flatnonzero(there[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                    if len(at):
                        found.append(hashes[at])
                        held[at] += 1
                        held[at + n] -= 1
                if not found:
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(held) > 0]).astype(np.int8)))
                own = Counter(words[b:e].tobytes() for b, e in zip(edges[::2], edges[1::2]))
                ids.append(doc_id.as_py())
                runs.append([np.frombuffer(x, dtype=np.int64).tolist() for x in sorted(own)])
                copies.append([own[x] for x in sorted(own)])
                seeds.append(np.unique(np.concatenate(found)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(runs, pa.list_(pa.list_(pa.int64()))), pa.array(copies, pa.list_(pa.int64())), pa.array(seeds, pa.list_(pa.int64()))],
                ["doc_id", "runs", "copies", "seeds"])

    plain = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return plain.mapInArrow(run, f"doc_id bigint, runs {RUNS}, copies array<bigint>, seeds array<bigint>")


def rarest_seeds(items: DataFrame, of_docs: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``item_id`` and ``seed``: the seeds of which any document that covers an item must hold one.

    A tile lies where the document holds every seed. The most frequent seeds are left out as long as the words of the item
    under all of them together are too few to reach the coverage: a document that holds no other seed can't reach it either. So
    phrases that many items and documents share bring no pairs unless they make up that share of the item.
    """
    known = of_docs.groupBy("seed").agg(F.count(F.lit(1)).alias("documents"))
    named = kept(items.withColumn("item", F.monotonically_increasing_id()))
    counted = named.select("item", F.explode("seeds").alias("seed")).join(known, "seed")
    lists = counted.groupBy("item").agg(F.collect_list("seed").alias("held"), F.collect_list("documents").alias("documents"))  # an item's own seeds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, seeds = [], []
            for item_id, length, words, held, documents in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *batch.columns[2:]):
                words = words.values.to_numpy().view(np.uint64)
                at = defaultdict(list)
                for i, h in enumerate(seed_hashes(words, length).view(np.int64).tolist()):
                    at[h].append(i)
                covered, left_out = np.zeros(len(words), dtype=bool), 0
                order = sorted(zip(documents.as_py(), held.as_py()), reverse=True)
                for _, seed in order:
                    more = covered.copy()
                    for i in at[seed]:
                        more[i:i + length] = True
                    if more.sum() >= coverage * len(words):
                        break
                    covered, left_out = more, left_out + 1
                ids += [item_id] * (len(order) - left_out)
                seeds += [seed for _, seed in order[left_out:]]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seeds, pa.int64())], ["item_id", "seed"])

    return named.select("item", "item_id", "length", "words").join(lists, "item").select("item_id", "length", "words", "held", "documents").mapInArrow(
        run, "item_id bigint, seed bigint")


def tiled(pairs: DataFrame, coverage: float = COVERAGE, seed: int = SEED) -> DataFrame:
    """The pairs whose tiles cover enough of the item; reads ``doc_id``, ``item_id``, ``words``, ``runs`` and ``copies``.

    Of equal runs an item needs no more than it can have tiles.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for doc_id, item_id, words, runs, copies in zip(*(batch.column(i).to_pylist() for i in range(5))):
                item = np.array(words, dtype=np.int64).view(np.uint64)
                length = min(seed, len(item))
                whole = [np.array(r, dtype=np.int64).view(np.uint64) for r, n in zip(runs, copies) for _ in range(min(n, len(item) // length))]
                tiles = tile(item, whole, length)
                covered = sum(n for _, _, n in tiles)
                if tiles and covered >= coverage * len(item):
                    for column, value in zip(out, (doc_id, item_id, len(item), covered, len(tiles))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "item_id", "item_words", "covered_words", "tiles"])

    schema = "doc_id bigint, item_id bigint, item_words bigint, covered_words bigint, tiles bigint"
    return pairs.select("doc_id", "item_id", "words", "runs", "copies").mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED) -> DataFrame:
    """One row per document and item whose text is covered: ``doc_id``, ``item_id``, ``item_words``, ``covered_words``, ``tiles``, ``coverage``."""
    items = kept(hashed_items(benchmark, seed))
    lengths = [r.length for r in items.where("length > 0").select("length").distinct().collect()]  # ``seed`` of them at most
    hits = kept(hit_runs(docs, seed_bitmap(items), sorted(lengths)))
    of_docs = hits.select("doc_id", F.explode("seeds").alias("seed"))
    met = of_docs.join(rarest_seeds(items, of_docs, coverage), "seed").select("doc_id", "item_id").distinct()
    # m places of shared seeds cover at most length * m words
    shared = F.aggregate(F.arrays_zip("seeds", "places"), F.lit(0).cast("bigint"), lambda m, s: m + F.when(F.array_contains("_held", s["seeds"]), s["places"]).otherwise(0))
    pairs = met.join(items, "item_id").join(hits.select("doc_id", "runs", "copies", F.col("seeds").alias("_held")), "doc_id").where(
        shared * F.col("length") >= F.size("words") * coverage)
    best = tiled(pairs, coverage, seed).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("covered_words", "tiles", "item_words")).alias("_best"))
    return best.select("doc_id", "item_id", "_best.item_words", "_best.covered_words", "_best.tiles").withColumn(
        "coverage", F.col("covered_words") / F.col("item_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED) -> DataFrame:
    """``docs`` without the rows that cover an item.

    Rows are told apart by a hash of doc_id and text, so those without an id and those that share one are judged each by its own text.
    """
    name = "_row_key" + "_" * max(map(len, docs.columns), default=0)  # a name no column has
    key = F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text"))
    rows = docs.withColumn(name, key)
    found = contaminated(rows.select(F.col(name).alias("doc_id"), "text"), benchmark, coverage, seed)
    found = kept(found.select(F.col("doc_id").alias(name)).distinct())
    return rows.join(found, name, "left_anti").select(*docs.columns)
