"""Pooling of adjacent score blocks inside a task; light to import for workers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext

#: Blocks of pooled scores: range of the lower end, ends, positives, rows.
BLOCKS = "part int, lo double, hi double, pos long, n long"


class Stack:
    """Blocks in score order whose rates rise; whatever would break that is pooled."""

    def __init__(self) -> None:
        self.blocks: list[list] = []

    def add(self, part: int, lo: float, hi: float, pos: int, n: int) -> None:
        blocks = self.blocks
        # whole numbers, so no rounding decides; a pooled block stays in the range of its lower end
        while blocks and blocks[-1][3] * n >= pos * blocks[-1][4]:
            part, lo, _, more, others = blocks.pop()
            pos, n = pos + more, n + others
        blocks.append([part, lo, hi, pos, n])

    def table(self) -> pa.Table:
        columns = list(zip(*self.blocks)) or [[]] * 5
        kinds = (pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("part", "lo", "hi", "pos", "n"), columns, kinds)})


def pool_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pool the scores of one range, which arrive in order."""
    stack, part = Stack(), TaskContext.get().partitionId()
    for batch in batches:
        for p, pos, n in zip(*(column.to_pylist() for column in batch.columns)):
            stack.add(part, p, p, pos, n)
    yield from stack.table().to_batches()


def pool_group(blocks: pa.Table) -> pa.Table:
    """Pool the blocks of neighbouring ranges."""
    stack = Stack()
    for block in zip(*(column.to_pylist() for column in blocks.select(["part", "lo", "hi", "pos", "n"]).sort_by("lo").columns)):
        stack.add(*block)
    return stack.table()
