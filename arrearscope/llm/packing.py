"""Fixed-length training sequences by Karmarkar-Karp multiway differencing.

Documents are encoded and cut into pieces: whole windows, and the rest in pieces
of at most a quarter window. Pieces are dealt over buckets by a hash; in a bucket
whole windows stand alone and the others are put into k windows by differencing:
the two partial partitions of the widest spread are merged again and again, the
fullest window of one with the emptiest of the other, until one near-equal
partition is left. If its fullest window is over the capacity, k rises.

The number of buckets follows from the texts' bytes, so a bucket holds about as
much at any size. A long document is spread over buckets by its pieces.

Defined results: a null text is an empty one and has the end id alone; repeated
rows are packed once each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.llm.encoding import encoder
from arrearscope.llm.texts import need

CAPACITY = 1024
#: Text bytes per bucket, about 250,000 ids or 250 windows.
BUCKET_BYTES = 1 << 20
#: The rest of a document is cut into pieces of at most this part of a window.
CUTS = 4
#: A bucket's windows are numbered from its own multiple of this.
WINDOWS_PER_BUCKET = 1 << 32


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in k groups of near-equal sums.

    A partial partition is (sums in falling order, a list of indices per sum); only
    its groups that hold something are stored, the others count as zero.
    """
    heap = [(-size, i, [size], [[i]]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        _, _, sums, groups = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        # position p of one meets position k-1-p of the other: the fullest meet the emptiest
        overlap = len(sums) + len(other) - k
        if overlap > 0:
            kept, alone = len(sums) - overlap, len(other) - overlap
            joined = [*map(add, sums[kept:], other[: alone - 1 if alone else None : -1]), *sums[:kept], *other[:alone]]
            parts = [*map(add, groups[kept:], others[: alone - 1 if alone else None : -1]), *groups[:kept], *others[:alone]]
        else:
            joined, parts = sums + other, groups + others
        if overlap > 0 or sums[-1] < other[0]:  # else they are in falling order
            order = sorted(range(len(joined)), key=joined.__getitem__, reverse=True)
            joined, parts = [joined[i] for i in order], [parts[i] for i in order]
        sums, groups = joined, parts
        spread = sums[0] - (sums[-1] if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, made, sums, groups))
        made += 1
    return heap[0][3] if heap else []


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity`` each, from pieces that fit one."""
    if not sizes:
        return []
    k = -(-sum(sizes) // capacity)
    while True:
        groups = difference(sizes, k)
        most = max(sum(sizes[i] for i in g) for g in groups)
        if most <= capacity:
            return groups
        k = max(k + 1, k * most // capacity - k // 64)


def _pieces(path: str, end_id: int, capacity: int):
    rest = max(1, capacity // CUTS)

    def cuts(n: int) -> Iterator[tuple[int, int]]:
        whole = n // capacity * capacity
        for at in range(0, whole, capacity):
            yield at, capacity
        left = n - whole
        count = -(-left // rest)
        for j in range(count):
            a, b = left * j // count, left * (j + 1) // count
            yield whole + a, b - a

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([end_id], encode.dtype).tobytes()
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for key, ids in zip(batch.column(0).to_pylist(), encode.encode(batch.column(1).to_pylist())):
                ids += end
                n, w = len(ids) // encode.width, encode.width
                for at, length in cuts(n):
                    rows.append((key, n, at, length, ids[at * w : (at + length) * w]))
                held += len(ids)
                if held > 1 << 22:
                    yield _batch(rows, w)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, encode.width)

    def _batch(rows: list[tuple], width: int) -> pa.RecordBatch:
        doc, n, at, length, ids = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(at, pa.int64()), pa.array(length, pa.int64()),
             pa.array([width] * len(doc), pa.int32()), pa.array(ids, pa.binary())],
            names=["doc_id", "doc_tokens", "start", "length", "width", "packed"],
        )

    return run


def _window(capacity: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "doc_id", "start"], ascending=False, kind="stable").reset_index(drop=True)
        lengths = pieces["length"].tolist()
        whole = next((i for i, n in enumerate(lengths) if n < capacity), len(lengths))
        groups = [[i] for i in range(whole)] + [[whole + i for i in g] for g in pack(lengths[whole:], capacity)]
        window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for number, group in enumerate(groups):
            at = 0
            for i in group:
                window[i], offset[i] = number, at
                at += lengths[i]
        pieces["sequence_id"] = pieces.pop("bucket").astype(np.int64) * WINDOWS_PER_BUCKET + window
        pieces["offset"] = offset
        pieces["ids"] = [np.frombuffer(x, f"<u{w}").astype("<u4").tobytes() for x, w in zip(pieces.pop("packed"), pieces.pop("width"))]
        return pieces

    return run


def sequences(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, doc_tokens, start, length, sequence_id, offset, ids) per piece.

    ``ids`` are little-endian 32-bit values; a sequence is its pieces by offset,
    padded to the capacity.
    """
    need(docs, key, text)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    size = rows.agg(F.sum(F.octet_length("t") + 1)).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    cut = rows.mapInArrow(
        _pieces(tokenizer, end_id, capacity),
        "doc_id long, doc_tokens long, start long, length long, width int, packed binary",
    )
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "packed"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(
        _window(capacity),
        "doc_id long, doc_tokens long, start long, length long, sequence_id long, offset long, ids binary",
    )
