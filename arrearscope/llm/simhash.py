"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint's thirty-two 2-bit segments are mapped to their numbers of ones, a point
of a small grid. Changing one bit moves the point by one step, so the Manhattan
distance of two points is a lower bound of the fingerprints' Hamming distance.
Points within two steps of each other share a grid cell within one step of both;
every fingerprint goes to its own cell and the cells one step away, at most 65 and 49
on average, and fingerprints that meet another one in a cell are candidates. Short
segments keep chance meetings rare: two random points are within two steps of each
other once in 4.5e10 pairs, with 4-bit segments it would be once in 3e6.

Candidates are verified exactly without pairs: two fingerprints differ in at most
two bits if and only if some value differs in at most one bit from both. Each
candidate meets the others at its 65 such values, where all are linked with the
smallest. A group of n near copies costs 65 n rows and not n^2 pairs, and no link
is lost. Equal fingerprints are one from the start.

Defined results: null and empty texts have the fingerprint zero, linked like any
other; texts of one or two words have one shingle; the identity of a row is its key
and text hash, so equal rows are one document; null keys come last when the smallest
is chosen; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.llm.components import components
from arrearscope.llm.texts import free_name, need
from arrearscope.session import written

SHINGLE = 3
SEED = 42
#: Segments of a fingerprint, two bits each.
SEGMENTS = 32
#: Shingle hashes that are summed at a time.
AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of UTF-8 text; A-Z are lower-cased, ASCII white space parts words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words = [b" ".join(words)]
        runs = [words]
    else:
        runs = [words[i:] for i in range(shingle)]
    shingles = map(b" ".join, zip(*runs))
    return majority(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, len(runs[-1])))


def majority(hashes: np.ndarray) -> int:
    """Signed 64 bits, each set if it is in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        part = hashes[at : at + AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or b"", shingle) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())], names=["key", "text_hash", "fp"]
            )

    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, text_hash, fp) per row."""
    need(docs, key, text)
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(body).alias("text_hash"), body.cast("binary").alias("t"))
    schema = rows.select("key", "text_hash", F.lit(0).cast("long").alias("fp")).schema
    return rows.mapInArrow(_fingerprints(shingle), schema)


def segment_counts(fp: Column) -> Column:
    """Numbers of ones of all 2-bit segments, in place, two bits each; bit operations cannot overflow."""
    ones, shifted = F.lit(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    one = fp.bitwiseXOR(shifted).bitwiseAND(ones)
    two = fp.bitwiseAND(shifted).bitwiseAND(ones)
    return one.bitwiseOR(F.shiftleft(two, 1))


def _cells(point: str) -> Column:
    """The grid cell of a point and all cells one step away: a count of 0 becomes 1, 1 becomes 0 or 2, 2 becomes 1."""
    steps = []
    for i in range(0, 2 * SEGMENTS, 2):
        count = f"(shiftrightunsigned({point}, {i}) & 3)"
        steps += [
            f"IF({count} < 2, {point} ^ shiftleft(2 * {count} + 1, {i}), NULL)",
            f"IF({count} > 0, {point} ^ shiftleft(2 * {count} - 1, {i}), NULL)",
        ]
    return F.expr(f"array_compact(array({point}, {', '.join(steps)}))")


def candidates(distinct: DataFrame) -> DataFrame:
    """The fingerprints ``fp`` with another one within two steps on the grid."""
    placed = distinct.select("fp", segment_counts(F.col("fp")).alias("point")).select("fp", F.explode(_cells("point")).alias("cell"))
    met = placed.groupBy("cell").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a < b").select("cell")
    met = written(met, "met-cells")
    return placed.join(met, "cell", "left_semi").select("fp").distinct()


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints at most two bits apart."""
    found = written(candidates(distinct), "simhash-candidates")
    near = "concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))"
    meeting = found.select("fp", F.explode(F.expr(near)).alias("value"))
    stars = meeting.groupBy("value").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a < b")
    stars = written(stars.select(F.col("value"), "a"), "simhash-stars")
    edges = meeting.join(stars, "value").filter("a <> fp AND bit_count(a ^ fp) <= 2")
    return edges.select("a", F.col("fp").alias("b")).distinct()


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, text_hash, fp, chosen_key, chosen_hash) per row: the smallest document of its component."""
    rows = written(fingerprints(docs, key, text, shingle), "simhash")
    return choose(rows, links)


def choose(rows: DataFrame, edges: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` (key, text_hash, fp) with the smallest document of each component that ``edges`` draws between distinct fp."""
    me = F.struct(F.col("key").isNull().alias("n"), "key", "text_hash")
    distinct = written(rows.groupBy("fp").agg(F.min(me).alias("least")), "simhash-distinct")
    roots = components(edges(distinct.select("fp")))
    placed = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = written(placed, "simhash-roots")
    chosen = placed.groupBy("root").agg(F.min("least").alias("chosen"))
    by_fp = written(placed.join(chosen, "root").select("fp", F.col("chosen.key").alias("chosen_key"), F.col("chosen.text_hash").alias("chosen_hash")), "simhash-chosen")
    return rows.join(by_fp, "fp")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each component: its smallest document, once."""
    return keep_chosen(docs, link(docs, key, text, shingle), key, text)


def keep_chosen(docs: DataFrame, linked: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` that are chosen in ``linked``, once each."""
    # one column, equal also where the key is null, so one shuffle of the texts serves the join and the
    # window; coalesce() says that hashes are never null, as on the other side, else the types differ
    hashed = F.coalesce("chosen_hash", F.lit(0).cast("long")).alias("chosen_hash")
    chosen = linked.select(F.struct("chosen_key", hashed).alias("_chosen")).distinct()
    me, number = free_name(docs.columns, "_me"), free_name(docs.columns, "_again")
    rows = docs.withColumn(me, F.struct(F.col(f"`{key}`").alias("chosen_key"), F.xxhash64(F.col(f"`{text}`")).alias("chosen_hash")))
    kept = rows.join(chosen, rows[me] == chosen["_chosen"], "left_semi")
    again = Window.partitionBy(me).orderBy(F.lit(0))
    return kept.withColumn(number, F.row_number().over(again)).filter(F.col(number) == 1).drop(me, number)
