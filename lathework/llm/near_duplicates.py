"""Near-duplicates by banded MinHash with sequential Bayesian verification.

One pass gives every document its number of distinct shingles, a digest of its words, a
signature of ``BANDS * ROWS`` minima and the hashes of its bands. Documents of equal words are
one class, whose smallest id stands for it; only these are compared.

Candidates share a band. A band's bucket is not paired up: all members are compared with
the smallest one (the pivot). Links give components; a bucket whose members are in one
component needs no further comparison. The members of the other buckets are grouped anew by their
rarest shingles, of which two linked texts must share one, and within such a group those outside
its largest component are compared with those of other components, where places and sizes allow a link. After that every two
candidates have been compared, are in one component already, or cannot be linked, so no component is
missed, and a passage that many texts share brings no pairs.

A pair is compared in batches of ``STEP`` minima. With a uniform prior, the share of
agreeing minima gives the posterior of the similarity; a pair is pruned as soon as the chance
that it reaches the threshold falls below ``MISS``. What survives is verified on the full
shingle sets. A pair at the threshold shares no band with probability
``(1 - T ** ROWS) ** BANDS``, 5e-5 with the values below.

Defined cases: a null or empty text, or one without a word, has no shingle and no link; a
shorter text than a shingle has its whole sequence as one; repeated rows are one class; a row
without doc_id has the component of its class; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.session import scratch_folder

SHINGLE = 2
PERCENT = 80
BANDS = 25
ROWS = 5
STEP = 25
MISS = 1e-6
MOST_CACHED = 150_000
AT_ONCE = 4096
BITMAP_BITS = 1 << 23
COUNTERS = 1 << 18
PARITY_WORDS = 8
BEFORE = 4

SIGNED = "doc_id bigint, n_shingles bigint, words_digest binary, signature binary, bands array<bigint>"

_rng = np.random.default_rng(20)
FACTORS = (_rng.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
SUMMANDS = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)[:, None]


def words_of(text: str | None) -> list[bytes]:
    """``bytes`` lower-cases A-Z only and splits at blanks and the five control characters after tab's."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingles(words: list[bytes], size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(size))))


def linked(a: set, b: set, percent: int = PERCENT) -> bool:
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_CACHED:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def shingle_hashes(words: list[bytes], cache: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted."""
    h = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(size, len(h))
    if not width:
        return h
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = (out ^ h[i:len(h) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of every permutation of the hashes' upper halves."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), AT_ONCE):
        np.minimum(best, (FACTORS * x[None, at:at + AT_ONCE] + SUMMANDS).min(axis=1), out=best)
    return best


def band_hashes(best: np.ndarray) -> np.ndarray:
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in best.reshape(BANDS, ROWS).T:
        out = (out ^ column) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def signed(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            counts, digests, signatures, bands = [], [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                hashes = shingle_hashes(words, cache, size)
                counts.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                best = signature(hashes) if len(hashes) else None
                signatures.append(None if best is None else best.tobytes())
                bands.append([] if best is None else band_hashes(best))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "words_digest", "signature", "bands"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SIGNED)


def least_agreements(percent: int = PERCENT, miss: float = MISS, total: int = BANDS * ROWS, step: int = STEP) -> dict[int, int]:
    """For every number of compared minima, the least number of agreements that keeps a pair.

    With a uniform prior the posterior is a Beta distribution; its tail above the threshold is the
    chance of at most ``m`` successes in ``n + 1`` trials at the threshold.
    """
    t = percent / 100
    out = {}
    for n in range(step, total + 1, step):
        below = 0.0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= miss:
                out[n] = m
                break
    return out


def survivors(pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a`` and ``b`` of the pairs that no posterior bound prunes; reads ``sa`` and ``sb``."""
    least = least_agreements(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint32).reshape(-1, BANDS * ROWS) for i in (2, 3))
            left = np.arange(batch.num_rows)
            agree = np.zeros(batch.num_rows, dtype=np.int64)
            for n, m in least.items():
                agree[left] += (one[left, n - STEP:n] == two[left, n - STEP:n]).sum(axis=1)
                left = left[agree[left] >= m]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(left)), batch.column(1).take(pa.array(left))], ["a", "b"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def confirmed(pairs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``a`` and ``b`` of the pairs that are linked on full sets; reads ``ta`` and ``tb``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            a, b = [], []
            for one, two, ta, tb in zip(*(batch.column(i) for i in range(4))):
                if (text := ta.as_py()) != last:  # neighbours often share their pivot
                    last, own = text, shingles(words_of(text), size)
                if linked(own, shingles(words_of(tb.as_py()), size), percent):
                    a.append(one.as_py())
                    b.append(two.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return pairs.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once below the shared folder."""
    spark = df.sparkSession
    folder = scratch_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _own_exchange(least: DataFrame) -> DataFrame:
    return least.withColumnsRenamed({"u": "_u"})


def _own(key: str) -> Column:
    """A join of edges with one aggregated row per node, on the node and its hash.

    Rows dealt by the node alone do not suffice for two keys, so both sides come straight from an
    exchange of their own and adaptive execution can split the edges of a hub.
    """
    return (F.col(key) == F.col(f"_{key}")) & (F.xxhash64(key) == F.xxhash64(f"_{key}"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of ``edges``.

    Alternating large-star and small-star steps: every step links the neighbours of a node to
    the smallest of them, until nothing changes. Steps are written to the shared folder.
    """
    now = kept(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    state = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(_own_exchange(least), _own("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(least.where("m < u").select("u", F.col("m").alias("v"))).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(_own_exchange(low), _own("u")).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = kept(small.union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def rows_of(docs: DataFrame, ids: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """``doc_id`` and ``text`` of the documents in ``ids``.

    A bitmap of the ids, ``bits`` / 64 rows at most, is broadcast first, so that few other texts are exchanged.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = (
        ids.select(place(F.col("doc_id")).alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("_mask"))
    )
    marked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("_bit", place(F.col("doc_id")))
    near = marked.withColumn("_word", F.shiftright("_bit", 6)).join(F.broadcast(words), "_word").where(F.expr("shiftright(_mask, cast(_bit % 64 as int)) & 1 = 1"))
    return near.select("doc_id", "text").join(ids, "doc_id")


def _compare(pairs: DataFrame, signatures: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (``a``, ``b``): signatures first, then texts of what is left."""
    one = signatures.select(F.col("doc_id").alias("a"), F.col("signature").alias("sa"))
    two = signatures.select(F.col("doc_id").alias("b"), F.col("signature").alias("sb"))
    left = kept(survivors(pairs.join(one, "a").join(two, "b"), percent))
    ids = left.select(F.col("a").alias("doc_id")).union(left.select("b")).distinct()
    texts = kept(rows_of(docs, ids))
    with_texts = (
        left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
    )
    return kept(confirmed(with_texts, size, percent).distinct())


def parities(hashes: np.ndarray) -> np.ndarray:
    """Bits that tell of ``64 * PARITY_WORDS`` remainders whether an odd number of the hashes has it.

    A hash that only one of two sets holds flips one bit, so the bits in which the sets differ are no more than such hashes.
    """
    odd = np.bincount(np.mod(hashes, 64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def rare_shingles(texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``n``, ``place``, ``key`` and the ``before`` last keys of the rarest shingles of every text, rarest first; and ``doc_id`` with its ``parity`` bits.

    A link needs ``percent`` of either set in common, so all but that share and one more, in any order that is
    the same for all texts, meet. The order is by counts of hash remainders over all
    ``texts`` (``COUNTERS`` numbers), then by hash, so shingles that many texts share come last.
    """
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            found = [shingle_hashes(words_of(t.as_py()), cache, size).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "hashes"])

    hashed = kept(texts.select("doc_id", "text").mapInArrow(hashes, "doc_id bigint, hashes array<bigint>"))
    counted = hashed.select(F.explode("hashes").alias("h")).groupBy(F.pmod("h", F.lit(COUNTERS)).cast("int").alias("at")).count().toArrow()
    counts = np.zeros(COUNTERS, dtype=np.int64)
    counts[counted.column("at").to_numpy()] = counted.column("count").to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = [], []
            for row in batch.column(1):
                h = row.values.to_numpy()
                order = np.lexsort((h, shared.value[np.mod(h, COUNTERS)]))
                keys.append(h[order[:len(h) + percent * -len(h) // 100 + 1]] if len(h) else h)
                sizes.append(len(h))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n", "keys"])

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([parities(row.values.to_numpy()) for row in batch.column(1)], pa.list_(pa.int64()))], ["doc_id", "parity"])

    before = F.slice("keys", F.greatest(F.col("place") - BEFORE + 1, F.lit(1)), F.least(F.col("place"), F.lit(BEFORE)))
    rare = hashed.mapInArrow(rarest, "doc_id bigint, n bigint, keys array<bigint>").select("doc_id", "n", "keys", F.posexplode("keys").alias("place", "key"))
    rare = rare.select("doc_id", "n", "place", "key", before.alias("before"))
    return rare, hashed.mapInArrow(bits, "doc_id bigint, parity array<bigint>").groupBy("doc_id").agg(F.first("parity").alias("parity"), F.count(F.lit(1)).alias("_texts"))


def _shared(members: DataFrame) -> DataFrame:
    """Members of bands that more than one document has, with the band's smallest one, ``pivot``."""
    pivots = members.groupBy("band").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("_most")).where("pivot < _most").drop("_most")
    return members.join(pivots, "band")


def _mixed(members: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Members of the groups that hold more than one component, with their own and the group's largest one, ``main``."""
    known = members.join(labels, members["doc_id"] == labels["node"], "left").withColumn("component", F.coalesce("component", "doc_id")).drop("node")
    sizes = known.groupBy(key, "component").agg(F.count(F.lit(1)).alias("_n"))
    mixed = sizes.groupBy(key).agg(F.max(F.struct("_n", "component")).alias("_main"), F.count(F.lit(1)).alias("_parts")).where("_parts > 1")
    return known.join(mixed.select(key, F.col("_main.component").alias("main")), key)


def _open_pairs(shared: DataFrame, labels: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs of different components that share a rare shingle and may be linked by their sizes.

    They are looked for among the documents of bands that hold more than one component. Of two
    linked sets the smaller (by size, then id) has the pair's common share in the larger, so
    it meets the other with fewer of its rarest shingles; what follows the first common shingle on
    either side must be enough for the overlap a link needs; and no more parity bits may differ than a link allows the sets
    to differ, so that members of a large group of texts just below the threshold don't meet each other.
    """
    ids = kept(_mixed(shared.select("band", "doc_id"), labels, "band").select("doc_id").distinct())
    rare, bits = rare_shingles(rows_of(docs, ids), size, percent)
    open_keys = _mixed(rare, labels, "key").withColumn("outside", F.col("component") != F.col("main"))
    # several texts under one id have no parity of their own, so nothing is concluded from it
    own = bits.select("doc_id", F.when(F.col("_texts") == 1, F.col("parity")).alias("parity"))
    keys = kept(open_keys.join(own, "doc_id"))
    least = lambda total: F.ceil(percent * total / (100 + percent))  # noqa: E731  # overlap of linked sets of ``total`` together
    small = keys.where(F.col("place") <= F.col("n") - least(2 * F.col("n"))).select(
        "key", *[F.col(c).alias(f"small_{c}") for c in ("doc_id", "n", "place", "component", "outside", "parity", "before")])
    need = least(F.col("small_n") + F.col("n"))
    differing = reduce(operator.add, [F.bit_count(F.col("small_parity")[i].bitwiseXOR(F.col("parity")[i])) for i in range(PARITY_WORDS)])
    meet = (
        (F.col("small_component") != F.col("component"))
        & (F.struct("small_n", "small_doc_id") < F.struct("n", "doc_id"))
        & (F.col("small_n") - F.col("small_place") >= need) & (F.col("n") - F.col("place") >= need)
        & ~F.arrays_overlap("small_before", "before")  # the pair meets at such a key already
        & F.coalesce(differing <= F.col("small_n") + F.col("n") - 2 * need, F.lit(True))
    )
    pairs = small.where("small_outside").join(keys, "key").where(meet).union(small.where("NOT small_outside").join(keys.where("outside"), "key").where(meet))
    return pairs.select(F.least("small_doc_id", "doc_id").alias("a"), F.greatest("small_doc_id", "doc_id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    table = kept(signed(docs, size))
    classes = kept(table.where("n_shingles > 0").groupBy("words_digest").agg(F.min("doc_id").alias("rep")).where("rep IS NOT NULL"))
    own = classes.withColumnRenamed("words_digest", "_digest")
    reps = kept(table.join(own, (F.col("doc_id") == F.col("rep")) & (F.col("words_digest") == F.col("_digest")), "left_semi").select("doc_id", "signature", "bands"))
    shared = kept(_shared(reps.select("doc_id", F.explode("bands").alias("band"))))
    first = kept(shared.where("doc_id != pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct())
    links = _compare(first, reps, docs, size, percent)
    labels = components(links)
    second = _open_pairs(shared, labels, docs, size, percent).join(first, ["a", "b"], "left_anti")
    more = _compare(kept(second), reps, docs, size, percent)
    contracted = more.join(labels.toDF("a", "ca"), "a", "left").join(labels.toDF("b", "cb"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = components(contracted).toDF("component", "_merged")
    final = labels.join(merged, "component", "left").select("node", F.coalesce("_merged", "component").alias("component"))
    final = final.union(merged.join(labels.select(F.col("node").alias("component")), "component", "left_anti").select("component", "_merged"))
    by_class = own.join(final, F.col("rep") == F.col("node"), "left").select("_digest", F.coalesce("component", "rep").alias("_component"))
    component: Column = F.when(F.col("n_shingles") > 0, F.coalesce("_component", "doc_id")).otherwise(F.col("doc_id"))
    return (
        table.select("doc_id", "n_shingles", "words_digest").join(by_class, F.col("words_digest") == F.col("_digest"), "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )
