"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every shingle is hashed once; the hash names a bin and a value, and a bin keeps its least
value. An empty bin takes over the value of another one: hashes of (bin, attempt) name the
bins to try, and after ``PROBES`` tries the filled bin with the least hash of (bin, that bin)
is taken, so the choice is uniform and the same for every text. The low ``CODE_BITS`` bits of
each bin make up the fingerprint. Two bins agree by chance with probability
``2 ** -CODE_BITS``, which the likeness corrects.

The next document's text is a successor in doc_id order. Buckets of neighbouring ids, bounded by
approximate quantiles, are the window groups; the first row of each bucket is added as an extra
last row of the bucket before it, so texts are exchanged once. An id of very many rows (or none, for rows without one) is a
bucket of its own, cut into parts by a hash of the text; only rows equal in id and text share a part in any number.

Defined cases: a null text is empty; a text of fewer words than a shingle has its whole
sequence as one; a text without words has the fingerprint of zeros; the likeness of two texts without
words is 1; a null doc_id sorts first; repeated ids follow each other by text (by its hash, where they are very many); the only
document is its own successor; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
BINS = 256
CODE_BITS = 8
PROBES = 6
VALUE_BITS = 48
ROWS_PER_BUCKET = 2_000
MOST_BUCKETS = 65_536
WHITE = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """A hash for every ``size`` words in a row of the lower-cased text."""
    def of_words(words: Column) -> Column:
        def joined(hashes: Column) -> Column:
            starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (size - 1), F.lit(0)))
            return F.transform(starts, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, size)]))

        return (
            F.when(F.size(words) >= size, let(F.transform(words, lambda w: F.xxhash64(w)), joined))
            .when(F.size(words) > 0, F.array(F.xxhash64(F.lit(size), words)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(F.array_remove(F.split(F.lower(text), WHITE), ""), of_words)


def bin_minima(hashes: Column, bins: int = BINS) -> Column:
    """One entry per bin, bin number above ``VALUE_BITS`` bits of value; all ones for an empty bin.

    An entry of the largest value is added for each bin; after sorting, the first entry of
    each bin is its least.
    """
    none = (1 << VALUE_BITS) - 1
    keyed = F.transform(hashes, lambda h: F.shiftleft(F.pmod(h, F.lit(bins)), VALUE_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - VALUE_BITS)))
    marks = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.shiftleft(i.cast("bigint"), VALUE_BITS).bitwiseOR(F.lit(none)))
    before = lambda entries, i: F.coalesce(F.shiftright(F.get(entries, i - 1), VALUE_BITS), F.lit(-1))
    return let(F.sort_array(F.concat(keyed, marks)), lambda s: F.filter(s, lambda v, i: F.shiftright(v, VALUE_BITS) != before(s, i)))


def densified(minima: Column, bins: int = BINS, probes: int = PROBES) -> Column:
    """``minima`` with the empty bins filled; all zeros if every bin is empty."""
    none = F.lit((1 << VALUE_BITS) - 1)
    empty = lambda v: v.bitwiseAND(none) == none

    def fill(m: Column) -> Column:
        def attempt(i: Column, a: int) -> Column:
            return let(F.get(m, F.pmod(F.xxhash64(i, F.lit(a)), F.lit(bins)).cast("int")), lambda v: F.when(~empty(v), v))

        def least(i: Column) -> Column:
            filled = F.filter(m, lambda v: ~empty(v))
            return F.array_min(F.transform(filled, lambda v: F.struct(F.xxhash64(i, F.shiftright(v, VALUE_BITS)).alias("h"), v.alias("v"))))["v"]

        return F.transform(m, lambda v, i: F.when(~empty(v), v).otherwise(
            F.coalesce(*[attempt(i, a) for a in range(probes)], least(i), F.lit(0).cast("bigint"))))

    return let(minima, fill)


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The low bits of all bins, packed into 64-bit integers, the first bin in the highest bits."""
    per_word = 64 // CODE_BITS

    def packed(codes: Column) -> Column:
        low = lambda c: c.bitwiseAND(F.lit((1 << CODE_BITS) - 1))
        parts = lambda w: [F.shiftleft(low(F.get(codes, w * per_word + k)), CODE_BITS * (per_word - 1 - k)) for k in range(per_word)]
        return F.transform(F.sequence(F.lit(0), F.lit(BINS // per_word - 1)), lambda w: reduce(lambda x, y: x.bitwiseOR(y), parts(w)))

    return let(densified(bin_minima(shingle_hashes(text, size))), packed)


def as_hex(print_: Column) -> Column:
    """Two digits per bin."""
    return F.lower(F.array_join(F.transform(print_, lambda v: F.lpad(F.hex(v), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """The share of agreeing bins less what chance gives, between 0 and 1.

    Two packed words differ in the codes of which their exclusive or has a bit; all bits of a code are gathered in its lowest.
    """
    lowest = F.lit(sum(1 << (CODE_BITS * k) for k in range(64 // CODE_BITS)))
    chance = 2.0**-CODE_BITS

    def gathered(v: Column, shift: int) -> Column:
        return let(v, lambda x: x.bitwiseOR(F.shiftrightunsigned(x, shift)))

    def differing(v: Column) -> Column:
        return F.bit_count(gathered(gathered(gathered(v, 4), 2), 1).bitwiseAND(lowest))

    other = F.aggregate(F.zip_with(a, b, lambda x, y: differing(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n)
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), ((BINS - other) / F.lit(float(BINS)) - chance) / (1 - chance)))


@dataclass(frozen=True)
class Buckets:
    """Runs of neighbouring keys: the least key of every bucket but the first, and into how many parts each bucket is cut."""

    bounds: list[int]
    parts: list[int]

    def of(self, key: Column) -> Column:
        """The number of bounds that are not above ``key``, by bisection."""
        if not self.bounds:
            return F.lit(0)
        table = F.from_json(F.lit(json.dumps(self.bounds)), "array<bigint>")
        steps = F.array(*[F.lit(1 << p) for p in range(len(self.bounds).bit_length() - 1, -1, -1)])
        return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(table, low + step - 1) <= key, low + step).otherwise(low))

    def spread(self, bucket: Column, text: Column) -> Column:
        """The order of rows that share a key of many rows: a hash of 63 bits of their text; 0 elsewhere."""
        if max(self.parts) == 1:
            return F.lit(0).cast("bigint")
        return F.when(self._parts(bucket) > 1, F.shiftrightunsigned(F.xxhash64(text), 1)).otherwise(F.lit(0).cast("bigint"))

    def part(self, bucket: Column, spread: Column) -> Column:
        if max(self.parts) == 1:
            return F.lit(0)
        return F.least(F.floor(spread / F.lit(2.0**63) * self._parts(bucket)).cast("int"), self._parts(bucket) - 1)

    def _parts(self, bucket: Column) -> Column:
        return F.get(F.from_json(F.lit(json.dumps(self.parts)), "array<int>"), bucket)


def key_buckets(docs: DataFrame, key: Column, rows_per_bucket: int = ROWS_PER_BUCKET) -> Buckets:
    """By quantiles of the ids, ``MOST_BUCKETS`` at most.

    A key that several quantiles fall on has about so many times ``rows_per_bucket`` rows: it becomes a bucket of its own, which is cut
    into as many parts and one more by a hash of the text.
    """
    ids = docs.select(key.alias("k"))
    buckets = min(MOST_BUCKETS, -(-ids.count() // rows_per_bucket))
    if buckets < 2:
        return Buckets([], [1])
    quantiles = F.percentile_approx("k", [i / buckets for i in range(1, buckets)], max(10_000, 10 * buckets))
    times = Counter(ids.agg(quantiles).first()[0])
    heavy = {k: n for k, n in times.items() if n > 1}
    bounds = sorted({*times, *(k + 1 for k in heavy if k < (1 << 63) - 1)})
    return Buckets(bounds, [1, *(heavy.get(k, 0) + 1 for k in bounds)])


def with_successor(rows: DataFrame, key: str, text: str, buckets: Buckets, derived: dict[str, Column]) -> DataFrame:
    """``rows`` with ``derived`` columns and, for them and ``text``, ``next_<c>`` from the following row.

    Rows follow each other by ``key``, then ``text`` (by its hash first where a key has many rows); the first row follows the last. Derived
    columns are computed once for each row and once more for the first row of a part of a bucket.
    """
    order = ["_spread", text]
    placed = rows.withColumn("_bucket", buckets.of(F.col(key)))
    placed = placed.withColumn("_spread", buckets.spread(F.col("_bucket"), F.col(text))).withColumn("_part", buckets.part(F.col("_bucket"), F.col("_spread")))
    group = ["_bucket", "_part"]
    heads = placed.groupBy(*group).agg(F.min(key).alias("_head"), F.min("_spread").alias("_least"))  # a bucket of parts has one key
    around, every = Window.orderBy(*group), Window.partitionBy(F.lit(0))  # one row per part
    latest = F.max(F.struct(*group)).over(every)
    heads = heads.select("_head", "_least", *[F.coalesce(F.lag(g).over(around), latest.getField(g)).alias(f"_goes{g}") for g in group])
    firsts = placed.join(F.broadcast(heads), (F.col(key) == F.col("_head")) & (F.col("_spread") == F.col("_least")))  # at most MOST_BUCKETS heads and as many parts
    extra = firsts.groupBy(*[f"_goes{g}" for g in group]).agg(F.min(F.struct(key, *order)).alias("_r")).select(
        *[F.col(f"_goes{g}").alias(g) for g in group], *[F.col(f"_r.{c}").alias(c) for c in (key, *order)], F.lit(True).alias("_extra"))
    both = placed.withColumn("_extra", F.lit(False)).unionByName(extra, allowMissingColumns=True).withColumns(derived)
    within = Window.partitionBy(*group).orderBy("_extra", key, *order)
    led = both.select("*", *[F.lead(c).over(within).alias(f"next_{c}") for c in (text, *derived)])
    return led.where("NOT _extra").drop(*group, "_spread", "_extra")


def edited_fingerprints(docs: DataFrame, size: int = SHINGLE, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Fingerprints of every text and of its edit: its second half gives way to the next document's beginning."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    buckets = key_buckets(docs, key, rows_per_bucket)
    rows = docs.select(key.alias("_key"), F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    led = with_successor(rows, "_key", "text", buckets, {"fp": fingerprint(F.col("text"), size)})
    led = led.withColumn("n_chars", F.char_length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))

    def described(text: Column) -> Column:
        return let(fingerprint(text, size), lambda e: F.struct(
            F.sha2(text.cast("binary"), 256).alias("edited_sha256"), as_hex(F.col("fp")).alias("fingerprint"), as_hex(e).alias("edited_fingerprint"),
            likeness(F.col("fp"), e).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next")))

    return led.select("doc_id", "n_chars", let(edited, described).alias("_d")).select("doc_id", "n_chars", "_d.*")
