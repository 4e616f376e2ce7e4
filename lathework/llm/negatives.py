"""Hard-negative mining with exact scores from a residue number system.

Vectors become whole numbers, x = floor(256 * c), and a score is the integer inner product of two of
them. For every prime of a base the matrices of centred residues are multiplied in float32: as long as
terms * (p / 2)^2 stays below 2^24 every partial sum is a whole number that float32 holds exactly, in any order
of addition, so long vectors are cut into chunks of that many terms. Chinese remaindering with
balanced mixed-radix digits turns the residues into the signed score. The base is as many primes, from the largest of
eight bits downwards, as twice the largest possible score needs.

Rows are dealt into slices and anchors into blocks of bounded size; every tile of a slice and a block is
one task's group, so all anchors meet all rows and nothing larger than a tile is held. The first pass
keeps the best rows of the anchor's label of each tile, a window over the tiles' few rows picks the
positives; the second pass keeps the best rows of other labels inside every positive's window of scores, and a
window picks the negatives. Scores fall, ties go to the smaller vec_id, then to the earlier row.

Defined cases: rows with a null vec_id or label, a null vector, a null or non-finite component, an
empty vector, a length other than the table's most frequent one (the shorter, of two as frequent) or a squared norm above 2^56 take no part;
equal vectors tie; rows that share a vec_id are rows of their own, as anchors and as partners; an anchor without a positive has no
rows; a positive score below 0 has an empty window, one of 0 takes scores of 0; empty tables give no rows; further columns are not read.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathework.session import scratch_folder

SCALE = 256
LARGEST_NORM = float(2**56)  # a hundred times a score fits 64 bits
POSITIVES = NEGATIVES = 5
WINDOW = (80, 100)  # per cent of the positive's score
ANCHORS, SLICE, LEAST_SLICE = 16_384, 65_536, 4_096  # of a tile
CELLS = 1 << 21  # scores held at once inside a tile

FIRST = "anchor_row bigint, anchor_id bigint, positive_row bigint, positive_id bigint, positive_score bigint"
SECOND = FIRST + ", negative_row bigint, negative_id bigint, negative_score bigint"


def _written(df: DataFrame) -> DataFrame:
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@functools.cache
def prime_base(bound: int) -> tuple[int, ...]:
    """Primes from 251 downwards whose product is above 2 * ``bound``, so that -bound to bound are told apart."""
    out, product = [], 1
    for p in range(255, 2, -2):
        if all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            out.append(p)
            product *= p
            if product > 2 * bound:
                return tuple(out)
    raise ValueError(f"no base of small primes reaches {bound}")


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Residues from -(p - 1) / 2 to (p - 1) / 2."""
    half = p // 2
    return (x + half) % p - half


def residues(x: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    return [centred(x, p).astype(np.float32) for p in primes]


def modular_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a b' modulo p of residue matrices in float32, centred."""
    terms = (2**24 - 1) // (p // 2) ** 2
    out = np.zeros((len(a), len(b)), dtype=np.int32)
    for begin in range(0, a.shape[1], terms):
        out += centred((a[:, begin:begin + terms] @ b[:, begin:begin + terms].T).astype(np.int32), p)
    return centred(out, p)


def exact_product(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """The signed products of the matrices with these residues.

    The balanced digits of a number in the radices 1, p0, p0 p1, ... are found one by one; sums of
    lower digits stay within the bound the base was chosen for, so 64 bits suffice.
    """
    out, radix = None, 1
    for p, x, y in zip(primes, a, b):
        product = modular_product(x, y, p)
        if out is None:
            out = product.astype(np.int64)
        else:
            digit = centred((product - centred(out, p)) * pow(radix, -1, p), p)
            out += digit * radix
        radix *= p
    return out


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, falling; of equal ones the earlier place comes first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:k]


def usable(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(``row``, ``vec_id``, ``label``, ``x``, ``anchor``) of the rows that take part, written once, from ``vec_id``, ``label``, ``embedding``, ``anchor``."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    whole = lambda c: F.floor(c.cast("double") * scale).cast("bigint")
    norm = F.aggregate("embedding", F.lit(0.0), lambda total, c: total + whole(c).cast("double") * whole(c).cast("double"))
    taken = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").where(finite).where(norm <= LARGEST_NORM)
    return _written(taken.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.transform("embedding", lambda c: whole(c).cast("int")).alias("x"), norm.alias("norm"), F.coalesce("anchor", F.lit(False)).alias("anchor")))


class Tile:
    """Anchors of a block and rows of a slice, rows by vec_id so that ties fall into order."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, dims: int, primes: tuple[int, ...]):
        self.primes = primes
        self.ids, self.rows, self.labels = (rows.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        order = np.lexsort((self.rows, self.ids))
        self.ids, self.rows, self.labels = self.ids[order], self.rows[order], self.labels[order]
        whole = lambda t: t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)
        self.right = residues(whole(rows)[order], primes)
        self.left = residues(whole(anchors), primes)
        self.anchor_ids, self.anchor_rows, self.anchor_labels = (anchors.column(c).to_numpy() for c in ("vec_id", "row", "label"))

    def scores(self):
        """(place of an anchor, its scores against all rows), some anchors at a time."""
        step = max(CELLS // len(self.ids), 1)
        for begin in range(0, len(self.anchor_ids), step):
            block = exact_product([x[begin:begin + step] for x in self.left], self.right, self.primes)
            for i, scores in enumerate(block, begin):
                yield i, scores

    def positives(self, k: int) -> pa.Table:
        out: list[list] = [[] for _ in range(5)]
        same = {label: np.flatnonzero(self.labels == label) for label in np.unique(self.anchor_labels)}
        for i, scores in self.scores():
            others = same[self.anchor_labels[i]]
            others = others[self.rows[others] != self.anchor_rows[i]]
            at = others[best(scores[others], k)]
            for column, values in zip(out, ([self.anchor_rows[i]] * len(at), [self.anchor_ids[i]] * len(at), self.rows[at], self.ids[at], scores[at])):
                column.extend(values)
        return pa.table([pa.array(c, pa.int64()) for c in out], [f.split()[0] for f in FIRST.split(", ")])

    def negatives(self, positives: pa.Table, k: int, window: tuple[int, int]) -> pa.Table:
        out: list[list] = [[] for _ in range(8)]
        rows, ids, own = (positives.column(c).to_pylist() for c in ("positive_rows", "positive_ids", "positive_scores"))
        low, high = window
        for i, scores in self.scores():
            least = min(-(low * -s // 100) for s in own[i])
            at = np.flatnonzero((scores >= least) & (self.labels != self.anchor_labels[i]))
            at = at[np.argsort(-scores[at], kind="stable")]
            rising = -scores[at]
            for row, id_, score in zip(rows[i], ids[i], own[i]):
                begin = int(np.searchsorted(rising, -(high * score // 100), side="left"))
                end = int(np.searchsorted(rising, low * -score // 100, side="right"))
                taken = at[begin:max(min(end, begin + k), begin)]
                for column, values in zip(out, (*([v] * len(taken) for v in (self.anchor_rows[i], self.anchor_ids[i], row, id_, score)), self.rows[taken], self.ids[taken], scores[taken])):
                    column.extend(values)
        return pa.table([pa.array(c, pa.int64()) for c in out], [f.split()[0] for f in SECOND.split(", ")])


def _first(df: DataFrame, key: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every key, with ``rank`` from 1."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= k)


def mined(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, scale: int = SCALE,
          anchors_per_block: int = ANCHORS, rows_per_slice: int | None = None) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score`` from ``vec_id``, ``label``, ``embedding`` and ``anchor``.

    ``anchor`` (boolean) marks the rows that ask.
    """
    spark = rows.sparkSession
    every = usable(rows, scale)
    size = F.size("x").alias("size")
    common = every.groupBy(size).agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.max("norm").alias("norm")).orderBy(F.desc("n"), "size").first()
    if common is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    dims, primes = common["size"], prime_base(int(common["norm"] * (1 + 1e-12)) + 1)
    n_slices = -(-common["n"] // (rows_per_slice or min(max(common["n"] // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), LEAST_SLICE), SLICE)))
    n_blocks = max(-(-common["anchors"] // anchors_per_block), 1)
    used = every.where(F.size("x") == dims).drop("norm")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    anchors = _written(used.where("anchor").select("row", "vec_id", "label", "x", dealt(n_blocks).alias("block")))
    sliced = used.select("row", "vec_id", "label", "x", dealt(n_slices).alias("slice")).withColumn("block", numbers(n_blocks)).groupBy("block", "slice")
    tiles = lambda df: df.withColumn("slice", numbers(n_slices)).groupBy("block", "slice")

    def first_pass(block: pa.Table, slice_: pa.Table) -> pa.Table:
        return Tile(block, slice_, dims, primes).positives(positives)

    def second_pass(block: pa.Table, slice_: pa.Table) -> pa.Table:
        return Tile(block, slice_, dims, primes).negatives(block, negatives, window)

    near = tiles(anchors).cogroup(sliced).applyInArrow(first_pass, FIRST)
    chosen = _first(near, ["anchor_row"], [F.desc("positive_score"), F.col("positive_id"), F.col("positive_row")], positives)
    lists = chosen.groupBy("anchor_row").agg(*[F.collect_list(c).alias(f"{c}s") for c in ("positive_row", "positive_id", "positive_score")])  # ``positives`` rows at most
    asked = _written(anchors.join(lists.withColumnRenamed("anchor_row", "row"), "row"))
    hard = tiles(asked).cogroup(sliced).applyInArrow(second_pass, SECOND)
    ranked = _first(hard, ["anchor_row", "positive_row"], [F.desc("negative_score"), F.col("negative_id"), F.col("negative_row")], negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
