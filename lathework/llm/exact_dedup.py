"""Exact deduplication against a minimal perfect hash of the digests that history holds.

Two texts are equal when they are identical without ASCII white space; what is compared is the
SHA-256 of the rest. The distinct digests of the historical documents are dealt into buckets of
about ``BUCKET`` keys. Inside a bucket the keys fall into groups of about four, and every group gets a
displacement that sends its keys to free places (hash and displace), larger groups first, until
every place of the bucket is taken: with the number of keys in earlier buckets added, slots run from 0
without a gap. A slot holds the full digest, the winner's locator (doc_id and row) and the number of copies.

A digest that is looked up always leads to one slot or to an empty bucket; whether it is a member is
settled by comparing all 32 bytes. Members are merged with the winner of their slot, nonmembers
form groups of their own. Digests are made distinct before they are looked up, so a text with any number of copies is
one key; the rows themselves meet the decisions in one join whose sides come straight from
their exchange, where adaptive execution splits a hot digest.

Of equal texts the one of most code points stays, then of the smallest doc_id, then the first row.

Defined cases: a null text counts as empty, and all texts of white space alone are equal to it; rows without a doc_id
lose against those with one; of rows equal in everything one stays; an empty history has no slots
and makes every document a nonmember; empty tables give no rows; further columns are not read,
``unseen`` keeps them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from lathework.session import scratch_folder

BUCKET = 512
GROUP = 4
BLOCK = 4096  # buckets whose sizes are summed in one window
SHIFTS = range(1, 41)
WHITE = " \t\n\v\f\r"


@dataclass(frozen=True)
class DigestIndex:
    """``slots`` (slot, digest, doc_id, row, standing, copies) and ``buckets`` (bucket, first_slot, size, shift, seeds)."""

    slots: DataFrame
    buckets: DataFrame
    n_buckets: int

    def save(self, folder: str) -> None:
        self.slots.write.parquet(f"{folder}/slots")
        self.buckets.withColumn("n_buckets", F.lit(self.n_buckets)).write.parquet(f"{folder}/buckets")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> DigestIndex:
        buckets = spark.read.parquet(f"{folder}/buckets")
        count = buckets.select(F.max("n_buckets")).first()[0] or 1
        return cls(spark.read.parquet(f"{folder}/slots"), buckets.drop("n_buckets"), count)


def _written(df: DataFrame) -> DataFrame:
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def digest(text: Column) -> Column:
    """SHA-256 of the text without ASCII white space, 32 bytes."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), WHITE, ""), 256))


def standing(doc_id: Column, n_chars: Column) -> Column:
    """One number that is larger for the better row: more code points, then the smaller doc_id, then any doc_id."""
    number = lambda c: c.cast("decimal(38,0)")
    power = lambda n: number(F.lit(str(2**n)))
    of_id = F.coalesce(power(63) - number(doc_id), number(F.lit(0)))  # 1 to 2 ** 64
    return number(number(n_chars) * power(65) + of_id)


def digested(docs: DataFrame, *more: Column) -> DataFrame:
    """(``doc_id``, ``n_chars``, ``digest``, ``row``) of every document, and ``more``; written once, so ``row`` stays."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return _written(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.char_length(text).cast("bigint").alias("n_chars"), digest(F.col("text")).alias("digest"),
        F.monotonically_increasing_id().alias("row"), *more))


def winners(rows: DataFrame) -> DataFrame:
    """(``digest``, ``doc_id``, ``row``, ``standing``, ``copies``): the best row of each digest."""
    judged = rows.withColumn("standing", standing(F.col("doc_id"), F.col("n_chars")))
    return judged.groupBy("digest").agg(
        F.max_by("doc_id", "standing").alias("doc_id"), F.max_by("row", "standing").alias("row"), F.max("standing").alias("standing"),
        F.count(F.lit(1)).alias("copies"))


def displacements(h1: np.ndarray, h2: np.ndarray) -> tuple[int, np.ndarray]:
    """The shift of the hashes and the displacement of every group with which the keys take places 0 to len - 1, each once.

    A key's place is (a + s div n * b + s mod n) mod n, where a and b are its shifted hashes and s is its group's displacement.
    """
    n = len(h1)
    groups = (h1 >> np.uint64(40)) % np.uint64(-(-n // GROUP))
    members: dict[int, list[int]] = {}
    for i, g in enumerate(groups.tolist()):
        members.setdefault(g, []).append(i)
    order = sorted(members, key=lambda g: (-len(members[g]), g))
    steps = np.arange(n)
    for shift in SHIFTS:  # a second shift is needed for tiny buckets only
        a, b = ((h >> np.uint64(shift)) % np.uint64(n) for h in (h1, h2))
        a, b = a.astype(np.int64), b.astype(np.int64)
        free, seeds = np.ones(n, dtype=bool), np.zeros(-(-n // GROUP), dtype=np.int32)
        for g in order:
            own = members[g]
            for turn in range(n if len(own) > 1 else 1):
                base = (a[own] + turn * b[own]) % n
                if len(set(base.tolist())) < len(own):
                    continue
                fits = np.flatnonzero(free[(base[None, :] + steps[:, None]) % n].all(axis=1))
                if len(fits):
                    seeds[g] = turn * n + fits[0]
                    free[(base + fits[0]) % n] = False
                    break
            else:
                break
        else:
            return shift, seeds
    raise ValueError("two keys of a bucket agree in all hashes")


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2))


def _bucket(key: Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets).cast("bigint"))


def _slot(key: Column) -> Column:
    """The slot a key leads to, from the columns of its bucket; null in an empty bucket."""
    h1, h2 = _hashes(key)
    size, shift = F.col("size"), F.col("shift")
    shifted = lambda h: F.call_function("shiftrightunsigned", h, shift) % size
    group = F.shiftrightunsigned(h1, 40) % F.ceil(size / GROUP)
    seed = F.get("seeds", group.cast("int")).cast("bigint")
    return F.col("first_slot") + (shifted(h1) + F.floor(seed / size) * shifted(h2) + seed % size) % size


def build_index(rows: DataFrame, bucket: int = BUCKET) -> DigestIndex:
    """The perfect hash over the distinct digests of ``rows`` (as ``digested`` makes them)."""
    keys = _written(winners(rows))
    n_buckets = max(-(-keys.count() // bucket), 1)

    def build(group: pa.Table) -> pa.Table:
        h1, h2 = (group.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        shift, seeds = displacements(h1, h2)
        return pa.table({"bucket": group.column("bucket")[:1], "size": [len(h1)], "shift": pa.array([shift], pa.int32()), "seeds": pa.array([seeds], pa.list_(pa.int32()))})

    h1, h2 = _hashes(F.col("digest"))
    hashed = keys.select(_bucket(F.col("digest"), n_buckets).alias("bucket"), h1.alias("h1"), h2.alias("h2"))
    sized = _written(hashed.groupBy("bucket").applyInArrow(build, "bucket bigint, size bigint, shift int, seeds array<int>"))
    # sums of earlier sizes: over blocks of buckets, then inside a block
    block = F.floor(F.col("bucket") / BLOCK).alias("block")
    blocks = sized.groupBy(block).agg(F.sum("size").alias("m"))
    earlier = blocks.select("block", (F.sum("m").over(Window.orderBy("block")) - F.col("m")).alias("earlier"))
    inside = F.sum("size").over(Window.partitionBy("block").orderBy("bucket")) - F.col("size")
    buckets = _written(sized.withColumn("block", block).join(earlier, "block").withColumn("first_slot", F.col("earlier") + inside).select(
        "bucket", "first_slot", "size", "shift", "seeds"))
    placed = keys.withColumn("bucket", _bucket(F.col("digest"), n_buckets)).join(buckets, "bucket")
    slots = placed.select(_slot(F.col("digest")).alias("slot"), *keys.columns)
    return DigestIndex(_written(slots), buckets, n_buckets)


def looked_up(keys: DataFrame, index: DigestIndex) -> DataFrame:
    """``keys`` (distinct ``digest`` and further columns) with the ``slot`` whose digest equals theirs byte by byte, else null."""
    led = keys.withColumn("bucket", _bucket(F.col("digest"), index.n_buckets)).join(index.buckets, "bucket", "left").select(
        *keys.columns, _slot(F.col("digest")).alias("slot"))
    there = index.slots.select("slot", F.col("digest").alias("_held"))
    return led.join(there, "slot", "left").select(*keys.columns, F.when(F.col("_held") == F.col("digest"), F.col("slot")).alias("slot"))


def decisions(fresh: DataFrame, index: DigestIndex) -> DataFrame:
    """(``digest``, ``keep_id``, ``keep_row``, ``group_size``, ``slot``) of every digest of the index and of the new rows' ``winners``."""
    found = _written(looked_up(fresh, index))
    new = found.where("slot IS NOT NULL").select("slot", *[F.col(c).alias(f"new_{c}") for c in ("doc_id", "row", "standing", "copies")])
    better = F.coalesce(F.col("new_standing") > F.col("standing"), F.lit(False))
    pick = lambda c: F.when(better, F.col(f"new_{c}")).otherwise(F.col(c))
    members = index.slots.join(new, "slot", "left").select(
        "digest", pick("doc_id").alias("keep_id"), pick("row").alias("keep_row"), (F.col("copies") + F.coalesce("new_copies", F.lit(0))).alias("group_size"), "slot")
    others = found.where("slot IS NULL").select("digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("copies").alias("group_size"), "slot")
    return members.unionByName(others)


def deduplicated(docs: DataFrame, historical: Column, bucket: int = BUCKET) -> DataFrame:
    """A row per document, ``historical`` ones and new ones: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``historical``, ``slot``.

    ``slot`` is null where history does not hold the text.
    """
    rows = digested(docs, F.coalesce(historical, F.lit(False)).alias("historical"))
    index = build_index(rows.where("historical"), bucket)
    decided = _written(decisions(winners(rows.where("NOT historical")), index))
    return rows.join(decided, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "historical", "slot")


def unseen(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` whose text ``index`` does not hold, one of each text, with all their columns."""
    name = "_row" + "_" * max(map(len, docs.columns), default=0)  # a name no column has
    rows = _written(docs.withColumn(name, F.monotonically_increasing_id()))
    narrow = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.char_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("bigint").alias("n_chars"),
                         digest(F.col("text")).alias("digest"), F.col(name).alias("row"))
    first = looked_up(winners(narrow), index).where("slot IS NULL").select(F.col("row").alias(name))
    return rows.join(_written(first), name, "left_semi").select(*docs.columns)
