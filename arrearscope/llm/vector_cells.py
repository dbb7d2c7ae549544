"""Exact top-k search by inner product over vector-approximation files.

Equal vectors are one entry that keeps its smallest ids, so a group of copies costs one
vector, however large it is. Entries are dealt into slices; a slice stores every vector
as cells (one byte a component, the cell's borders apart), and the exact vectors lie in
a table of their own. A search scans the cells only: from a cell's borders follow the
least and the largest inner product a query can have with the vectors in it. Entries
whose largest product lies below the kth least one are out. For the others exact vectors
are read in the order of that bound, a few per query and round, until no entry left can
reach the kth exact product.

Queries meet slices in blocks: a task holds one slice of cells and one block of queries,
both of bounded size, and no vector passes through the driver.

Defined results: vectors that are null, or hold a null, a non-finite component or one of
2^20 or more in size (whose products might leave the integers), take no part, nor do rows without an id; a vector is
compared with vectors of its own length only, and the empty vector is one of length 0;
rows with the query's id are its own and not among its results; repeated ids, and
repeated query rows, give their rows each; ties go to the smaller id; fewer than k others
give all of them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from arrearscope.llm.texts import need
from arrearscope.session import written

#: Cells per component.
CELLS = 64
#: Entries of a slice, and queries of a block, about.
SLICE, BLOCK = 1 << 14, 1 << 14
#: Bounds in memory together: queries times entries of a slice.
BOUNDS_AT_ONCE = 1 << 22
#: Exact vectors per query in the first round, in multiples of k; the next rounds read four times as many each.
FIRST_READ = 2
#: Scaled components are below this in size, so sums of their products stay exact.
LARGEST = 1 << 28


def vectors(table: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): components times ``scale``, rounded down, of the rows that take part."""
    need(table, key, vector)
    scaled = F.transform(F.col(f"`{vector}`"), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    able = F.forall(F.col(f"`{vector}`"), lambda x: F.abs(x.cast("double")) < LARGEST / scale)
    # null where a component is, and false for what is not finite
    rows = table.filter(F.col(f"`{key}`").isNotNull() & F.coalesce(able & ~F.exists(f"`{vector}`", F.isnull), F.lit(False)))
    return rows.select(F.col(f"`{key}`").cast("long").alias("id"), scaled.cast("array<int>").alias("v"))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): each distinct vector with its k + 1 smallest ids and their row counts.

    One more than k, as a query's own id is left out of its results.
    """
    counted = rows.groupBy("v", "id").agg(F.count("*").alias("n"))
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = counted.withColumn("place", smallest).filter(F.col("place") <= k + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("ids"))


# -- the files ------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    if not dim or not len(column):
        return np.zeros((len(column), dim), np.int32)
    flat = pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), dim)


def cells_of(v: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of every component, and each cell's smallest and largest value (d x cells).

    Cells of a component hold about equally many of the slice's values; equal values
    share a cell.
    """
    n, d = v.shape
    codes = np.zeros((n, d), np.uint8)
    low, high = np.zeros((d, cells), np.int32), np.zeros((d, cells), np.int32)
    for j in range(d):
        values, counts = np.unique(v[:, j], return_counts=True)
        before = np.cumsum(counts) - counts
        cell = (before * cells // n).astype(np.int64)
        codes[:, j] = cell[np.searchsorted(values, v[:, j])]
        used, first = np.unique(cell, return_index=True)
        low[j, used] = values[first]
        high[j, used] = values[np.append(first[1:], len(values)) - 1]
    return codes, low, high


_SLICE_FIELDS = "dim int, slice int, entries binary, first binary, second binary, codes binary, low binary, high binary"


def _slice_file(cells: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        codes, low, high = cells_of(_matrix(rows.column("v"), key[0].as_py()), cells)
        longs = [rows.column(c).to_numpy().astype("<i8").tobytes() for c in ("entry", "first", "second")]
        parts = [*longs, codes.tobytes(), low.astype("<i4").tobytes(), high.astype("<i4").tobytes()]
        names = ["entries", "first", "second", "codes", "low", "high"]
        found = {"dim": pa.array([key[0].as_py()], pa.int32()), "slice": pa.array([key[1].as_py()], pa.int32())}
        return pa.table(found | {c: pa.array([p], pa.binary()) for c, p in zip(names, parts)})

    return run


def approximations(indexed: DataFrame, cells: int = CELLS) -> DataFrame:
    """One row per slice: its entries, their two smallest ids, their cells and the cells' borders."""
    ids = (F.col("ids")[0]["id"].alias("first"), F.coalesce(F.get("ids", F.lit(1))["id"], F.col("ids")[0]["id"]).alias("second"))
    rows = indexed.select("dim", "slice", "entry", *ids, "v")
    return rows.groupBy("dim", "slice").applyInArrow(_slice_file(cells), _SLICE_FIELDS)


# -- the scan -------------------------------------------------------------------------


def bounds(q: np.ndarray, codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each query with each entry; exact in doubles."""
    columns = np.arange(codes.shape[1])
    least, most = low[columns, codes].astype(float), high[columns, codes].astype(float)
    up, down = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    return up @ least.T + down @ most.T, up @ most.T + down @ least.T


def _kept(least: np.ndarray, most: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Entries that may be among the k best by (product, smaller id)."""
    if len(least) <= k:
        return np.arange(len(least))
    kth = np.partition(least, len(least) - k)[len(least) - k]
    near = np.nonzero(most >= kth)[0]
    # of equal products the k smallest ids win: the kth of (product, id) is the border
    tied = np.nonzero(least >= kth)[0]
    worst = tied[np.lexsort((ids[tied], -least[tied]))[k - 1]]
    return near[(most[near] > kth) | (ids[near] <= ids[worst])]


_BOUND_SCHEMA = "query long, entry long, other long, least long, most long"


def _scan(k: int, cell_count: int):
    def run(key: tuple, cells: pa.Table, queries: pa.Table) -> pa.Table:
        dim, out = key[0].as_py(), []
        q = _matrix(queries.column("v"), dim)
        rows, own = queries.column("query").to_numpy(), queries.column("id").to_numpy()
        for part in cells.to_pylist():
            entry, first, second = (np.frombuffer(part[c], "<i8") for c in ("entries", "first", "second"))
            codes = np.frombuffer(part["codes"], np.uint8).reshape(len(entry), dim)
            low, high = (np.frombuffer(part[c], "<i4").reshape(dim, cell_count) for c in ("low", "high"))
            step = max(1, BOUNDS_AT_ONCE // len(entry))
            for start in range(0, len(q), step):
                least, most = bounds(q[start : start + step], codes, low, high)
                for i in range(len(least)):
                    at = start + i
                    # the smallest id that is not the query's; an entry of its id alone is out
                    other = np.where(first == own[at], second, first)
                    mine = np.nonzero(other != own[at])[0]
                    found = mine[_kept(least[i, mine], most[i, mine], other[mine], k)]
                    out.append((np.full(len(found), rows[at]), entry[found], other[found], least[i, found], most[i, found]))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
        return pa.table(dict(zip(("query", "entry", "other", "least", "most"), map(pa.array, columns))))

    return run


def _best(rows: DataFrame, product: str, k: int, ceiling: str) -> DataFrame:
    """Rows whose ``ceiling`` reaches the kth of (``product``, smaller id) of their query."""
    query = Window.partitionBy("query")
    place = F.row_number().over(query.orderBy(F.desc(product), "other"))
    worth = F.struct(F.col(product).alias("p"), (-F.col("other")).alias("o"))
    border = F.max(F.when(F.col("_place") == k, worth)).over(query)
    reach = F.struct(F.col(ceiling).alias("p"), (-F.col("other")).alias("o"))
    marked = rows.withColumn("_place", place).withColumn("_border", border)
    return marked.filter(F.col("_border").isNull() | (reach >= F.col("_border"))).drop("_place", "_border")


def search(
    table: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
    slice_rows: int = SLICE, block_rows: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score): the k best rows of ``table`` for each row of ``queries``.

    ``queries`` has the same two columns. Scores are inner products of scaled integers.
    """
    base = written(vectors(table, key, vector, scale), "vectors")
    distinct = written(entries(base, k).withColumn("entry", F.monotonically_increasing_id()), "entries")
    slices, dim = max(1, -(-distinct.count() // slice_rows)), F.size("v").alias("dim")
    place = F.pmod(F.xxhash64("entry"), F.lit(slices)).cast("int").alias("slice")
    files = written(approximations(distinct.select(dim, place, "entry", "ids", "v")), "cells")

    asked = vectors(queries, key, vector, scale).withColumn("query", F.monotonically_increasing_id())
    asked = written(asked, "queries")
    blocks = max(1, -(-asked.count() // block_rows))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    left = files.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.select(dim, "query", "id", "v", block.alias("block")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    meeting = ("dim", "slice", "block")
    scanned = left.groupBy(*meeting).cogroup(right.groupBy(*meeting)).applyInArrow(_scan(k, CELLS), _BOUND_SCHEMA)
    left_over = written(_best(written(scanned, "bounds"), "least", k, "most"), "left-over")

    read = None
    take = FIRST_READ * k
    while not left_over.isEmpty():
        order = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("most"), "other"))
        ordered = left_over.withColumn("place", order)
        now = ordered.filter(F.col("place") <= take).select("query", "entry", "other")
        product = F.aggregate(
            F.zip_with("qv", "v", lambda a, b: a.cast("long") * b.cast("long")), F.lit(0).cast("long"), lambda s, x: s + x
        )
        exact = now.join(distinct.select("entry", "v"), "entry").join(asked.select("query", F.col("v").alias("qv")), "query")
        exact = exact.select("query", "entry", "other", product.alias("score"))
        both = exact if read is None else read.unionByName(exact)
        read = written(_best(both, "score", k, "score"), "read")
        # what is left can only come in with a bound that reaches the kth exact product
        rest = ordered.filter(F.col("place") > take).select("query", "entry", "other", "most", F.lit(None).cast("long").alias("score"))
        known = read.select("query", "entry", "other", F.col("score").alias("most"), "score")
        reaching = _best(rest.unionByName(known), "score", k, "most").filter("score IS NULL")
        left_over = written(reaching.drop("score"), "left-over")
        take *= 4
    if read is None:
        return base.sparkSession.createDataFrame([], "query_id long, rank int, id long, score long")
    listed = read.join(distinct.select("entry", "ids"), "entry").select("query", "score", F.inline("ids"))
    named = listed.join(asked.select("query", F.col("id").alias("query_id")), "query").filter("id <> query_id")
    # rows of one id stand together; no more than k of them can be listed
    rows = named.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int"))))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id", "copy"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
