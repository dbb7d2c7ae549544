"""Shards along a Hilbert curve over several metadata dimensions.

Every dimension is quantised into levels of about equal row counts, a row's
levels give its index on the Hilbert curve, and rows sorted by that index are cut
into runs of equal length. Neighbours on the curve are close in all dimensions at
once, so a shard spans a small box of them and a filter on any dimension skips
most shards by their minima and maxima.

No task sorts a whole curve cell: a cell's rows are spread over buckets by a hash
of the key, buckets are counted, their places follow from sums of counts (first
over the buckets of a cell, then over cells, of which there are at most
2^(bits x dimensions)), and only rows of one bucket are numbered together. The
number of a cell's buckets follows from its rows, so a cell with a third of all rows
is many buckets and a small one is one.

Law: ``rows``; shard sizes are at most one row apart. Defined results: nulls take
the lowest level; ties on the curve are ordered by bucket, key and text; repeated
rows get a slot each; an empty table gives no rows; columns named like the added
ones give way to them.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.llm.texts import let, need, without
from arrearscope.session import written

#: Bits per dimension: 32 levels.
BITS = 5
#: Rows that are numbered together, about.
BUCKET_ROWS = 4096
SHARDS = 40
#: Counts of cells are broadcast up to 2^this many cells.
BROADCAST_BITS = 16


def curve_steps(n: int) -> list[tuple[int, int]]:
    """For each (state, cell corner): the corner's rank in the state, and the state inside it.

    A state is the corner where the curve enters and the axis along which it
    leaves; ranks follow the reflected binary code turned into that state.
    """
    full = (1 << n) - 1

    def turned(x: int, by: int) -> int:
        by %= n
        return ((x << by) | (x >> (n - by))) & full

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    rank_of = {gray(i): i for i in range(1 << n)}

    def entry(i: int) -> int:
        return 0 if i == 0 else gray(2 * ((i - 1) // 2))

    def axis(i: int) -> int:
        if i == 0:
            return 0
        ones = i if i % 2 else i - 1
        return ((ones ^ (ones + 1)).bit_length() - 1) % n

    steps = []
    for enter, along, corner in product(range(1 << n), range(n), range(1 << n)):
        rank = rank_of[turned(corner ^ enter, -(along + 1))]
        inner_enter = enter ^ turned(entry(rank), along + 1)
        inner_along = (along + axis(rank) + 1) % n
        steps.append((rank, inner_enter * n + inner_along))
    return steps


def curve_index(levels: list[Column], bits: int = BITS) -> Column:
    """Hilbert index of a point with ``bits`` bits per coordinate, as one expression."""
    n = len(levels)
    steps = curve_steps(n)
    ranks = F.array(*[F.lit(r) for r, _ in steps])
    states = F.array(*[F.lit(s) for _, s in steps])

    def index(point: Column) -> Column:
        def step(acc: Column, bit: Column) -> Column:
            corner = sum(
                (F.bit_get(F.get(point, F.lit(j)), bit).cast("int") * (1 << j) for j in range(n)), F.lit(0)
            )
            at = acc["s"] * (1 << n) + corner
            return F.named_struct(
                F.lit("h"), acc["h"] * (1 << n) + F.get(ranks, at), F.lit("s"), F.get(states, at)
            )

        start = F.named_struct(F.lit("h"), F.lit(0).cast("long"), F.lit("s"), F.lit(0))
        order = F.array(*[F.lit(b) for b in reversed(range(bits))])
        return F.aggregate(order, start, step, lambda acc: acc["h"])

    return let(F.array(*[level.cast("long") for level in levels]), index)


def edges(docs: DataFrame, dimension: str, bits: int = BITS) -> list:
    """The values at 2^bits - 1 equal steps of the ordered rows; a common value is several of them.

    Distinct values are counted first, ordered by ranges and cumulated range by range,
    so any ordered type works and only the edges reach the driver. Nulls come before all.
    """
    steps, value = 1 << bits, F.col("value")
    counts = docs.groupBy(F.col(f"`{dimension}`").alias("value")).agg(F.count("*").alias("n"))
    ordered = written(counts.repartitionByRange(value.asc_nulls_first()).withColumn("part", F.spark_partition_id()), "values")
    below = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ordered.groupBy("part").agg(F.sum("n").alias("rows"))
    starts = totals.select("part", F.coalesce(F.sum("rows").over(below), F.lit(0)).alias("start"), F.sum("rows").over(Window.partitionBy()).alias("all"))
    upto = Window.partitionBy("part").orderBy(value.asc_nulls_first())
    placed = ordered.join(starts, "part").select("value", "all", "n", (F.col("start") + F.sum("n").over(upto)).alias("last"))
    # the steps j with (last - n) * steps < j * all <= last * steps, the end left out
    first, end = f"((last - n) * {steps}L) DIV all + 1", f"least((last * {steps}L) DIV all, {steps - 1}L)"
    found = placed.selectExpr("value", f"greatest({end} - ({first}) + 1, 0L) AS times").filter("times > 0 AND value IS NOT NULL")
    return [v for row in found.collect() for v in [row["value"]] * row["times"]]


def _below(array: Column, value: Column) -> Column:
    # a second parameter of the function would be the place in the array
    return F.size(F.filter(array, lambda e: e < value))


def quantise(docs: DataFrame, dimensions: list[str], bits: int = BITS) -> list[Column]:
    """Level of each dimension: the edges below the value; rare values share a level."""
    levels = []
    for d in dimensions:
        found = edges(docs, d, bits)
        kind = docs.schema[d].dataType
        array = F.array(*[F.lit(e).cast(kind) for e in found])
        value = F.col(f"`{d}`")
        levels.append(_below(array, value) if found else F.lit(0))
    return levels


def assign(
    docs: DataFrame, dimensions: list[str], shards: int = SHARDS, key: str = "doc_id", text: str = "text", bits: int = BITS
) -> DataFrame:
    """All columns, with ``curve`` (the index), ``shard`` and ``slot`` (from 0 in each shard)."""
    need(docs, key, text, *dimensions)
    kept = [F.col(f"`{c}`") for c in without(docs.columns, "curve", "shard", "slot")]
    rows = docs.count()
    if not rows:
        nothing = {"curve": F.lit(0).cast("long"), "shard": F.lit(0).cast("int"), "slot": F.lit(0).cast("long")}
        return docs.select(*kept).withColumns(nothing)
    placed = docs.select(
        F.struct(*kept).alias("row"),
        curve_index(quantise(docs, dimensions, bits), bits).alias("curve"),
        F.xxhash64(F.col(f"`{key}`"), F.lit(1)).alias("h"),
    )
    until = (Window.unboundedPreceding, -1)
    # a row per cell that holds rows, 2^(bits x dimensions) at most
    sizes = written(placed.groupBy("curve").agg(F.count("*").alias("n")), "cells")
    over_cells = Window.orderBy("curve").rowsBetween(*until)
    cells = sizes.select(
        "curve", F.coalesce(F.sum("n").over(over_cells), F.lit(0)).alias("cell_start"),
        F.ceil(F.col("n") / BUCKET_ROWS).alias("buckets"),
    )
    if bits * len(dimensions) <= BROADCAST_BITS:
        cells = F.broadcast(cells)
    placed = placed.join(cells, "curve").withColumn("bucket", F.pmod("h", "buckets"))
    counts = placed.groupBy("curve", "bucket").agg(F.count("*").alias("n"))
    in_cell = Window.partitionBy("curve").orderBy("bucket").rowsBetween(*until)
    starts = counts.select("curve", "bucket", F.coalesce(F.sum("n").over(in_cell), F.lit(0)).alias("bucket_start"))
    order = [F.col(f"row.`{key}`"), F.xxhash64(F.col(f"row.`{text}`"))]
    number = F.row_number().over(Window.partitionBy("curve", "bucket").orderBy(*order)) - 1
    ranked = placed.join(starts, ["curve", "bucket"]).select(
        "row", "curve", (F.col("cell_start") + F.col("bucket_start") + number).alias("rank")
    )
    # run s holds the ranks from ceil(s * rows / shards) on
    shard = F.expr(f"cast((rank * {shards}L) div {rows}L AS int)")
    first = F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")
    return ranked.withColumn("shard", shard).select("row.*", "curve", "shard", (F.col("rank") - first).alias("slot"))


def write(assigned: DataFrame, path: str) -> None:
    """One folder per shard, rows by slot; dimensions keep narrow ranges in each."""
    assigned.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
