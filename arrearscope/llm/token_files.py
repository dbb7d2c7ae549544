"""Token ids of a corpus as binary blocks with Elias-Fano document boundaries.

``write`` sorts documents by id across partitions, encodes them and writes
blocks: one concatenated id array each, and the positions where documents end as
an Elias-Fano sequence with a sampled select structure, about two bits plus the
low bits per document instead of a 64-bit table. The blocks are binary values in
a parquet table, so the writer commits whole tasks and a lost executor leaves no
half-written file behind. ``read`` decodes the blocks; only the totals of
partitions are added up to place them in the whole.

Defined results: a null text is an empty one and has the end id alone; null
document ids sort first; rows of one id keep any order among equal texts, else the
order of their text hashes; an empty table gives no blocks and no rows; other
columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrearscope.llm.encoding import encoder
from arrearscope.llm.texts import need

#: Ids after which a block is closed; a longer document has a block of its own.
BLOCK_IDS = 1 << 19
#: Every so many ones of the upper bits a select sample is kept.
SAMPLE = 64
_HEADER = struct.Struct("<4sBBHQQQ")
_MAGIC = b"EFID"


def pack_boundaries(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Low width, low bits, upper bits and select samples of a rising sequence."""
    n, top = len(ends), int(ends[-1]) if len(ends) else 0
    width = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
    ends = ends.astype(np.uint64)
    low = ((ends[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    ones = (ends >> np.uint64(width)).astype(np.int64) + np.arange(n)
    upper = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
    upper[ones] = 1
    return (
        width,
        np.packbits(low.ravel(), bitorder="little").tobytes(),
        np.packbits(upper, bitorder="little").tobytes(),
        ones[::SAMPLE].astype("<u4").tobytes(),
    )


class Boundaries:
    """Ends of documents in a block, from their packed form."""

    def __init__(self, n: int, width: int, low: bytes, upper: bytes, samples: bytes):
        self.n, self.width = n, width
        self.low, self.upper = np.frombuffer(low, np.uint8), np.frombuffer(upper, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    def select(self, i: int) -> int:
        """End of the i-th document: the i-th one of the upper bits, and its low bits."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at // 8
        bits = int(self.upper[byte]) >> (at % 8) << (at % 8)
        while (ones := bits.bit_count()) <= left:
            left -= ones
            byte += 1
            bits = int(self.upper[byte])
        for _ in range(left):
            bits &= bits - 1
        one = byte * 8 + (bits & -bits).bit_length() - 1
        low = 0
        for k in range(self.width):
            bit = i * self.width + k
            low |= (int(self.low[bit // 8]) >> (bit % 8) & 1) << k
        return ((one - i) << self.width) | low

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)) << self.width
        if not self.width:
            return high
        low = np.unpackbits(self.low, bitorder="little")[: self.n * self.width].reshape(self.n, self.width)
        return high + low.astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))


def pack_block(documents: list[bytes], width: int) -> bytes:
    """One block from the id bytes of consecutive documents."""
    ids = b"".join(documents)
    ends = np.cumsum([len(d) // width for d in documents])
    low_width, low, upper, samples = pack_boundaries(ends)
    head = _HEADER.pack(_MAGIC, width, low_width, 0, len(documents), len(low), len(upper))
    return b"".join((head, low, upper, samples, ids))


def unpack_block(block: bytes) -> tuple[Boundaries, np.ndarray]:
    """Boundaries and ids of a block."""
    magic, width, low_width, _, n, n_low, n_upper = _HEADER.unpack_from(block)
    if magic != _MAGIC:
        raise ValueError("not a block of token ids")
    at = [_HEADER.size]
    for size in (n_low, n_upper, 4 * -(-n // SAMPLE)):
        at.append(at[-1] + size)
    parts = [block[a:b] for a, b in zip(at, at[1:])]
    return Boundaries(n, low_width, *parts), np.frombuffer(block, f"<u{width}", offset=at[-1])


_BLOCK_FIELDS = "part int, block int, n_documents long, n_ids long, doc_ids array<long>, payload binary"


def _blocks(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([end_id], encode.dtype).tobytes()
        part, block, keys, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([block], pa.int32()),
                    pa.array([len(held)], pa.int64()), pa.array([size // encode.width], pa.int64()),
                    pa.array([keys], pa.list_(pa.int64())), pa.array([pack_block(held, encode.width)], pa.binary()),
                ],
                names=["part", "block", "n_documents", "n_ids", "doc_ids", "payload"],
            )

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encode.encode(batch.column(1).to_pylist())):
                keys.append(key)
                held.append(ids + end)
                size += len(held[-1])
                if size >= BLOCK_IDS * encode.width:
                    yield closed()
                    block, keys, held, size = block + 1, [], [], 0
        if held:
            yield closed()

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the blocks of all documents, ascending by id, to a table at ``path``."""
    need(docs, key, text)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    order = [F.col("k").asc_nulls_first(), F.xxhash64("t")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.mapInArrow(_blocks(tokenizer, end_id), _BLOCK_FIELDS).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, keys, payload in zip(*(batch.column(i).to_pylist() for i in range(4))):
            bounds, ids = unpack_block(payload)
            ends = bounds.all()
            starts = np.concatenate(([0], ends[:-1]))
            wide = ids.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(keys), pa.int32()), pa.array([number] * len(keys), pa.int32()),
                    pa.array(keys, pa.int64()), pa.array(starts, pa.int64()),
                    pa.array([wide[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ],
                names=["part", "block", "doc_id", "local", "ids"],
            )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document; ids are little-endian 32-bit values.

    Blocks' places come from two levels of sums: within a partition's blocks, and
    over partitions, of which there are few.
    """
    table = spark.read.parquet(path)
    sizes = table.select("part", "block", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")
    )
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("block_start"))
    places = starts.join(parts, "part").select("part", "block", (F.col("part_start") + F.col("block_start")).alias("base"))
    rows = table.select("part", "block", "doc_ids", "payload").mapInArrow(
        _documents, "part int, block int, doc_id long, local long, ids binary"
    )
    return rows.join(places, ["part", "block"]).select("doc_id", (F.col("base") + F.col("local")).alias("start"), "ids")
