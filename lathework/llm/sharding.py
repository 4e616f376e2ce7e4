"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised to ``2 ** BITS`` cells, the cells become one index on a Hilbert
curve, and the rows in the order of that index are cut into runs of equal counts. Rows that
are close in all dimensions share a file, so a reader can prune files by any of them.

Ranks are found without sorting everything in one place. Rows are counted by curve index and
hash slice; the number of slices per index follows the table's size, so one curve cell that
holds a third of all rows is cut into many slices. Sums of earlier cells are taken over the
grid (at most ``2 ** (BITS * dimensions)`` rows), sums of earlier slices within a cell, and
ranks only within a slice.

Only DataFrame functions run; texts are read once for size and checksum and never exchanged.

Defined cases: a null text has size 1 and the checksum of no bytes; null dimensions take cell 0;
repeated rows take a place each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathework.session import scratch_folder

SHARDS = 8
BITS = 4
ROWS_PER_SLICE = 5_000


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of the cell given by ``axes``, each below ``2 ** bits``.

    Skilling's transform from axes to the transposed index, one bit level at a time, as integer
    arithmetic; the loop runs while the plan is built.
    """
    n = len(axes)
    state = F.struct(*[a.cast("int").alias(f"x{i}") for i, a in enumerate(axes)])

    def stepped(column: Column, change) -> Column:
        """``change`` applied to the axes of ``column``, which is evaluated once."""
        return F.transform(F.array(column), lambda s: F.struct(*[x.alias(f"x{i}") for i, x in enumerate(change([s[f"x{i}"] for i in range(n)]))]))[0]

    for level in range(bits - 1, 0, -1):
        for i in range(n):
            def undo(x: list[Column], i: int = i, q: int = 1 << level) -> list[Column]:
                flip = x[i].bitwiseAND(F.lit(q)) != 0
                swap = x[0].bitwiseXOR(x[i]).bitwiseAND(F.lit(q - 1))
                out = list(x)
                out[0] = F.when(flip, x[0].bitwiseXOR(F.lit(q - 1))).otherwise(x[0].bitwiseXOR(swap))
                if i:
                    out[i] = F.when(flip, x[i]).otherwise(x[i].bitwiseXOR(swap))
                return out
            state = stepped(state, undo)

    def gray(x: list[Column]) -> list[Column]:
        out = [x[0]]
        for i in range(1, n):
            out.append(x[i].bitwiseXOR(out[i - 1]))
        turn = F.lit(0)
        for level in range(bits - 1, 0, -1):
            turn = F.when(out[-1].bitwiseAND(F.lit(1 << level)) != 0, turn.bitwiseXOR(F.lit((1 << level) - 1))).otherwise(turn)
        return [o.bitwiseXOR(turn) for o in out]

    return F.transform(F.array(stepped(state, gray)), lambda s: reduce(
        lambda a, b: a.bitwiseOR(b),
        [F.shiftleft(F.shiftright(s[f"x{i}"], level).bitwiseAND(F.lit(1)).cast("bigint"), level * n + n - 1 - i)
         for level in range(bits) for i in range(n)],
    ))[0]


def hashed_cell(value: Column, bits: int = BITS) -> Column:
    """Cell of a value without an order of its own."""
    return F.when(value.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(value.cast("string")), F.lit(1 << bits)).cast("int"))


def log_cell(value: Column, bits: int = BITS) -> Column:
    """Cell of a size: half its binary logarithm, so that 16 cells reach four thousand million."""
    return F.coalesce(F.least(F.floor(F.log2(F.greatest(value.cast("double"), F.lit(1.0))) / 2).cast("int"), F.lit((1 << bits) - 1)), F.lit(0))


def curve_order(rows: DataFrame, curve: str, key: list[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``rows`` with ``rank`` (gapless from 0) along ``curve``, then a hash, then ``key``, and ``total``."""
    by_cell = Window.orderBy(curve)  # over the grid, not over rows
    cells = rows.groupBy(curve).agg(F.count(F.lit(1)).alias("_n"))
    before = cells.select(
        F.col(curve).alias("_cell"), F.ceil(F.col("_n") / F.lit(rows_per_slice)).alias("_slices"),
        (F.sum("_n").over(by_cell) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    dealt = (
        rows.join(F.broadcast(before), F.col(curve).eqNullSafe(F.col("_cell"))).drop("_cell")  # the grid bounds it
        .withColumn("_slice", F.pmod(F.xxhash64(*key), F.col("_slices")))
    )
    slices = dealt.groupBy(curve, "_slice").agg(F.count(F.lit(1)).alias("_m"))
    earlier = slices.withColumn("_earlier", F.sum("_m").over(Window.partitionBy(curve).orderBy("_slice")) - F.col("_m")).drop("_m")
    within = F.row_number().over(Window.partitionBy(curve, "_slice").orderBy(F.xxhash64(*key), *key)) - 1
    ranked = dealt.withColumn("_within", within).join(earlier, [curve, "_slice"])
    return ranked.withColumn("rank", F.col("_before") + F.col("_earlier") + F.col("_within")).drop("_slices", "_slice", "_before", "_earlier", "_within")


def sharded(rows: DataFrame, curve: str, key: list[str], shards: int = SHARDS, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: runs along ``curve`` whose counts differ by one at most."""
    ranked = curve_order(rows, curve, key, rows_per_slice)
    small, large = F.expr(f"total div {shards}"), F.expr(f"total % {shards}")
    wide = large * (small + 1)  # rows of the shards that hold one more
    in_wide = F.col("rank") < wide
    shard = F.when(in_wide, F.expr(f"rank div (total div {shards} + 1)")).otherwise(
        large + F.expr(f"(rank - total % {shards} * (total div {shards} + 1)) div greatest(total div {shards}, 1)"))
    slot = F.when(in_wide, F.expr(f"rank % (total div {shards} + 1)")).otherwise(
        F.expr(f"(rank - total % {shards} * (total div {shards} + 1)) % greatest(total div {shards}, 1)"))
    return ranked.withColumn("shard", shard.cast("int")).withColumn("slot", slot.cast("bigint")).drop("rank", "total")


def document_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Curve over language, source and size; within a cell of the curve a hash decides.

    The narrow rows are written once below the shared folder, so texts are read once; their places there deal equal rows
    over all slices of a cell.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.length(raw).cast("bigint") + 1).alias("size"), F.crc32(raw).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_place"),  # written once, so it stays
        hilbert_index([hashed_cell(F.col("lang"), bits), hashed_cell(F.col("source"), bits), log_cell(F.length(raw), bits)], bits).alias("_curve"),
    )
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    rows.write.parquet(folder)
    return sharded(spark.read.schema(rows.schema).parquet(folder), "_curve", ["_place"], shards, rows_per_slice).drop("_curve", "_place")
