"""Language-model scores by a log-bilinear neural model with two words of context.

Tokens are the lower-cased words of a text and one end. The model predicts a
token's unit from the units of the two tokens before it, and inside the unit the
token from the two tokens themselves:

    p(w | context) = p(unit(w) | context) * product of decisions on the way to w

Units are the most frequent tokens, the most frequent word endings, and one for the
rest, so every known and unknown token has one. Their part gives units embeddings,
predicts the next one's by a matrix per context position, and is trained in numpy
with noise-contrastive estimation; one batched matrix product over all contexts then
normalises it into a table.

A unit's tokens are the leaves of a binary tree. Every token with ``LEARNED``
occurrences among the ``FREQUENT`` commonest has a leaf and a vector as context; a
unit's other tokens share one leaf, with one more 0.5 for unknown tokens, and part
there by counts, (c + 0.5) / mass. A decision is the log ratio of the counts on its
two sides plus the product of its vector and the context's, so without anything
learned a unit's tokens have the probabilities of their counts, and with it all
probabilities still sum to one. Vectors are learned on all training texts in the
tasks that count units; a vector moves by the mean over tasks, by its occurrences there.
Tasks pass moves on in half precision, in rows of ``BLOCK`` ids.

Everything gathered covers all training documents and grows with them: token counts
(counted in tasks, added up in a shuffle) and counts of unit triples, at most
``UNITS``^3. Counts of the at most ``FREQUENT`` commonest tokens (a bound in rows, and
64 bytes each) are broadcast; all other tokens meet their counts in a join.

Defined results: a null text is an empty one, which has the end alone; repeated rows
get equal results; null keys are in the fold of the empty key; with no training
document every token is unknown, the base score is 0 and the score that of the
untrained model; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from copy import copy

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arrearscope.llm.language import held_out
from arrearscope.llm.texts import need
from arrearscope.session import written

#: Key of the end in count tables; no word holds white space.
END = b"\n"
UNIT_WORDS = 60
UNIT_ENDINGS = 35
#: Words, endings and the rest.
UNITS = UNIT_WORDS + UNIT_ENDINGS + 1
FREQUENT = 150_000
LONGEST_FREQUENT = 64
DIMENSIONS = 16
#: Occurrences from which a token has a leaf and a vector of its own.
LEARNED = 50
#: Steps along the gradient of decisions: tokens at a time, size, and squares that damp the first ones.
TOGETHER = 1024
RATE = 0.3
DAMPED = 20.0
#: Tokens scored at a time.
SCORED = 1 << 12
STEPS = 1500
BATCH = 1024
NOISE = 48
BATCH_CHARS = 2_000_000
#: Distinct tokens a task counts before it passes counts on.
COUNTED = 400_000
#: Counts of batches a task keeps before it adds them up.
GATHERED = 1_000_000
_MARKS = b".,!?;:)\"'"


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def ending(token: bytes) -> bytes:
    """Last two bytes without closing marks."""
    return (token.rstrip(_MARKS) or token)[-2:]


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[pa.RecordBatch] = []
    ends = 0

    def passed() -> pa.RecordBatch:
        """Counts of distinct tokens over all parts."""
        kinds = pc.dictionary_encode(pa.concat_arrays([p.column(0) for p in parts]))
        n = np.zeros(len(kinds.dictionary), np.int64)
        np.add.at(n, kinds.indices.to_numpy(), np.concatenate([p.column(1).to_numpy() for p in parts]))
        return pa.RecordBatch.from_arrays([kinds.dictionary, pa.array(n)], names=["token", "n"])

    for batch in batches:
        ends += len(batch.column(0))
        for _, texts in _batches_of(batch.column(0).to_pylist()):
            kinds = pc.value_counts(_in_a_row(texts)[0])
            parts.append(pa.RecordBatch.from_arrays(kinds.flatten(), names=["token", "n"]))
            if sum(map(len, parts)) > GATHERED:
                parts = [passed()]
                if len(parts[0]) > COUNTED:
                    yield parts.pop()
    parts.append(pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], names=["token", "n"]))
    yield passed()


def count_tokens(training: DataFrame) -> DataFrame:
    """(token, n) over the texts ``t`` of all training documents, ends included."""
    partial = training.select("t").mapInArrow(_count_tokens, "token binary, n long")
    return partial.filter("n > 0").groupBy("token").agg(F.sum("n").alias("n"))


def _count_endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, kinds = Counter(), Counter()
        for token, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            n[ending(token)] += count
            kinds[ending(token)] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()), pa.array(list(kinds.values()), pa.int64())],
            names=["ending", "n", "kinds"],
        )


class Units:
    """Unit of every token, and the mass of each unit."""

    def __init__(self, words: list[tuple[bytes, int]], endings: list[tuple[bytes, int, int]]):
        """``words``: unit tokens with counts, the end first; ``endings``: (ending, count, kinds) of all other tokens."""
        self.words = {w: i for i, (w, _) in enumerate(words)}
        ranked = sorted(endings, key=lambda e: (-e[1], e[0]))
        self.endings = {e[0]: UNIT_WORDS + i for i, e in enumerate(ranked[:UNIT_ENDINGS])}
        self.mass = np.full(UNITS, 0.5)
        for i, (_, n) in enumerate(words):
            self.mass[i] = n + 0.5  # the only token of its unit
        for e, n, kinds in ranked:
            self.mass[self.endings.get(e, UNITS - 1)] += n + 0.5 * kinds
        # units without any token keep no probability
        self.used = np.zeros(UNITS, bool)
        self.used[: len(words)] = True
        self.used[list(self.endings.values())] = True
        self.used[UNITS - 1] = True

    def of(self, token: bytes) -> int:
        unit = self.words.get(token)
        return self.endings.get(ending(token), UNITS - 1) if unit is None else unit


def contexts(sequence: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units one and two places before each; before a document stand ends (unit 0)."""
    one, two = np.zeros_like(sequence), np.zeros_like(sequence)
    one[1:], two[2:] = sequence[:-1], sequence[:-2]
    one[starts] = 0
    two[starts] = 0
    later = starts + 1
    two[later[later < len(sequence)]] = 0
    return one, two


def _in_a_row(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All tokens without ends, their places among tokens with ends, and where texts start there."""
    # kernels of ASCII do not look at what other bytes mean
    whole = pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string()))
    cut = pc.ascii_split_whitespace(whole)
    pieces, text_of = cut.flatten(), pc.list_parent_indices(cut).to_numpy()
    there = pc.binary_length(pieces).to_numpy() > 0  # white space at the ends of a text leaves empty pieces
    pieces, text_of = pieces.filter(pa.array(there)), text_of[there]
    lengths = np.bincount(text_of, minlength=len(texts)) + 1
    return pieces.view(pa.binary()), np.arange(len(text_of)) + text_of, np.cumsum(lengths) - lengths


def _found(pieces: pa.Array, names: pa.Array) -> np.ndarray:
    """Places in ``names``, -1 for what is not there."""
    return pc.fill_null(pc.index_in(pieces, value_set=names), -1).to_numpy()


def _endings(kinds: pa.Array) -> pa.Array:
    """``ending`` of every token."""
    kept = pc.ascii_rtrim(kinds.view(pa.string()), characters=_MARKS.decode())
    return pc.binary_slice(pc.if_else(pc.equal(pc.binary_length(kept), 0), kinds, kept.view(pa.binary())), -2)


def _batches_of(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of bounded size together, with the place of the first."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and size < BATCH_CHARS:
            size += len(texts[end] or b"")
            end += 1
        yield at, [t or b"" for t in texts[at:end]]
        at = end


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct entries of ``at``, the order that puts equal ones together, where each one's run starts and its length, longest first."""
    placed = np.sort(at.astype(np.int64) << 32 | np.arange(len(at)))
    entry = placed >> 32
    starts = np.concatenate(([0], np.flatnonzero(entry[1:] != entry[:-1]) + 1))
    n = np.append(starts[1:], len(at)) - starts
    longest = np.argsort(-n)
    starts = starts.take(longest)
    return entry.take(starts), placed & 0xFFFFFFFF, starts, n.take(longest)


def _sums(values: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of runs of rows, longest first. Most runs are short, so all take their next row together, and few long ones are left."""
    sums = values.take(starts, axis=0)
    longer = (len(n) - np.cumsum(np.bincount(n))).tolist()  # runs of more rows than that
    taken = 1
    while (left := longer[taken]) > 64:
        sums[:left] += values.take(starts[:left] + taken, axis=0)
        taken += 1
    if left:
        more = n[:left] - taken
        first = np.cumsum(more) - more
        rest = values.take(np.arange(more.sum()) + np.repeat(starts[:left] + taken - first, more), axis=0)
        sums[:left] += np.add.reduceat(rest, first, axis=0)
    return sums


class Leaves(dict):
    """Leaf of every token: its own, or the one its unit's other tokens share."""

    def __init__(self, units: Units, own: dict[bytes, int], rest: list[int]):
        super().__init__(own)
        self.update((w, rest[u]) for w, u in units.words.items())
        self.endings = {e: rest[u] for e, u in units.endings.items()}
        self.last = rest[UNITS - 1]

    def __missing__(self, token: bytes) -> int:
        return self.endings.get(ending(token), self.last)


class Decisions:
    """Trees from units to tokens, and the vectors of decisions and context tokens."""

    def __init__(self, units: Units, frequent: dict[bytes, int], seed: int = 2):
        named = sorted((units.of(w), w) for w, n in frequent.items() if n >= LEARNED and w not in units.words)
        # a unit's leaves are in a row: what has no leaf of its own, then tokens in byte order
        unit = np.array([u for u, _ in named], np.int64)
        leaf = np.arange(len(named)) + unit + 1
        first = np.arange(UNITS) + np.searchsorted(unit, np.arange(UNITS))
        self.rest = first
        self.leaves = Leaves(units, dict(zip((w for _, w in named), leaf.tolist())), first.tolist())
        self.names, self.leaf = pa.array(list(self.leaves), pa.binary()), np.fromiter(self.leaves.values(), np.int32)
        self.endings, self.of_endings = pa.array(list(self.leaves.endings), pa.binary()), np.array([*self.leaves.endings.values()], np.int32)
        mass = np.zeros(UNITS + len(named))
        mass[leaf] = [frequent[w] + 0.5 for _, w in named]
        mass[first] = units.mass - np.bincount(unit, mass[leaf], UNITS)
        self.units = np.zeros(len(mass), np.int64)
        self.units[first], self.units[leaf] = np.arange(UNITS), unit
        self._grow(mass, first)
        # the first half of a vector is a token's as the last one, the second half as the one before
        random = np.random.default_rng(seed).normal(0, 1, (UNITS, DIMENSIONS)).astype(np.float32)
        self.context = random[self.units]
        self.vectors = np.zeros((len(self.prior), DIMENSIONS), np.float32)

    def _grow(self, mass: np.ndarray, first: np.ndarray) -> None:
        """Cuts each unit's row of leaves near the middle of its mass, and the parts again, level by level."""
        until = np.concatenate(([0.0], np.cumsum(mass)))
        low, high = first, np.append(first[1:], len(mass))
        leaves, nodes, sides, priors, made = [], [], [], [], 0
        while len(low):
            cut = high - low > 1
            low, high = low[cut], high[cut]
            half = (until[low] + until[high]) / 2
            mid = np.searchsorted(until, half)
            mid -= until[mid] - half > half - until[mid - 1]
            mid = np.clip(mid, low + 1, high - 1)
            length = high - low
            leaf = np.arange(length.sum()) + np.repeat(low - np.cumsum(length) + length, length)
            leaves.append(leaf)
            nodes.append(np.repeat(np.arange(len(low)) + made, length))
            sides.append(leaf >= np.repeat(mid, length))
            priors.append(np.log((until[high] - until[mid]) / (until[mid] - until[low])))
            made += len(low)
            low, high = np.concatenate((low, mid)), np.concatenate((mid, high))
        leaf = np.concatenate(leaves)
        order = np.argsort(leaf, kind="stable")
        self.nodes = np.concatenate(nodes)[order].astype(np.int32)
        self.sides = np.where(np.concatenate(sides)[order], 1, -1).astype(np.float32)
        self.length = np.bincount(leaf, minlength=len(mass))
        self.starts = np.cumsum(self.length) - self.length
        self.prior = np.concatenate(priors).astype(np.float32)
        # of each decision on a way, its log odds by counts; of each leaf, minus the log of its share by counts
        self.odds = self.sides * self.prior.take(self.nodes)
        until = np.concatenate(([0.0], np.cumsum(np.log1p(np.exp(-self.odds.astype(np.float64))))))
        self.by_counts = until[self.starts + self.length] - until[self.starts]

    def of(self, token: bytes, unit: int) -> int:
        return self.leaves.get(token) or int(self.rest[unit])

    def missing(self, kinds: pa.Array) -> np.ndarray:
        """Leaves of tokens that have none of their own."""
        found = _found(_endings(kinds), self.endings)
        return np.append(self.of_endings, np.int32(self.leaves.last)).take(found)  # the last for what is not there

    def of_all(self, kinds: pa.Array) -> np.ndarray:
        """Leaves of tokens."""
        found = _found(kinds, self.names)
        leaf = self.leaf.take(found)
        leaf[found < 0] = self.missing(kinds.filter(pa.array(found < 0)))
        return leaf

    def _ways(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every decision on the way to each leaf: place of the leaf, place of the decision."""
        length = self.length[leaf]
        token = np.repeat(np.arange(len(leaf)), length)
        return token, np.arange(len(token)) + (self.starts[leaf] - np.cumsum(length) + length)[token]

    def _seen(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        half = DIMENSIONS // 2
        return np.concatenate((self.context.take(one, axis=0)[:, :half], self.context.take(two, axis=0)[:, half:]), axis=1)

    def _blocks(self, leaf: np.ndarray) -> list[tuple[slice, slice, tuple]]:
        """Of leaves by the length of their ways: those of one length, their decisions, and the shape of these."""
        length = self.length[leaf]
        starts = np.concatenate(([0], np.flatnonzero(length[1:] != length[:-1]) + 1))
        blocks, at = [], 0
        for a, b, n in zip(starts.tolist(), [*starts[1:].tolist(), len(leaf)], length[starts].tolist()):
            blocks.append((slice(a, b), slice(at, at := at + (b - a) * n), (b - a, n, DIMENSIONS)))
        return blocks

    def gains(self, leaf: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural logs of the leaves' probabilities in their units, less those by counts alone."""
        found = np.zeros(len(leaf))
        inner = np.flatnonzero(self.length[leaf])
        # ways of one length are a block of equal rows, and equal leaves read the same vectors
        inner = inner[np.argsort(self.length[leaf[inner]] << 32 | leaf[inner])]
        for start in range(0, len(inner), SCORED):
            at = inner[start : start + SCORED]
            _, way = self._ways(leaf[at])
            seen, vectors = self._seen(one[at], two[at]), self.vectors.take(self.nodes.take(way), axis=0)
            z = np.empty(len(way), vectors.dtype)
            blocks = self._blocks(leaf[at])
            for tokens_, ways, shape in blocks:
                np.matmul(vectors[ways].reshape(shape), seen[tokens_, :, None], out=z[ways].reshape(*shape[:2], 1))
            z *= self.sides.take(way)
            z += self.odds.take(way)
            z = np.log(1 + np.exp(np.minimum(-z, 80)))
            for tokens_, ways, shape in blocks:
                found[at[tokens_]] = self.by_counts[leaf[at[tokens_]]] - z[ways].reshape(shape[:2]).sum(axis=1)
        return found

    def gradients(self, leaf: np.ndarray, one: np.ndarray, two: np.ndarray):
        """Of the log-probability of leaves, all with decisions: by decision and by context token, as (those met, sums, how often)."""
        half = DIMENSIONS // 2
        by_length = np.argsort(self.length[leaf])
        leaf, one, two = leaf[by_length], one[by_length], two[by_length]
        token, way = self._ways(leaf)
        node, side = self.nodes.take(way), self.sides.take(way)
        seen, vectors = self._seen(one, two), self.vectors.take(node, axis=0)
        z, by_token = np.empty(len(way), vectors.dtype), np.empty(seen.shape, vectors.dtype)
        blocks = self._blocks(leaf)
        for tokens_, ways, shape in blocks:
            np.matmul(vectors[ways].reshape(shape), seen[tokens_, :, None], out=z[ways].reshape(*shape[:2], 1))
        wrong = side * 0.5 * (1 - np.tanh(0.5 * (self.odds.take(way) + side * z)))
        for tokens_, ways, shape in blocks:
            np.matmul(wrong[ways].reshape(shape[0], 1, shape[1]), vectors[ways].reshape(shape), out=by_token[tokens_, None])
        found, order, starts, n = _runs(node)
        by_decision = seen.take(token.take(order), axis=0)
        by_decision *= wrong.take(order)[:, None]
        yield found, _sums(by_decision, starts, n), n
        found, order, starts, n = _runs(np.concatenate((one, two)))
        by_context = np.zeros((2 * len(leaf), DIMENSIONS), np.float32)
        by_context[: len(leaf), :half], by_context[len(leaf) :, half:] = by_token[:, :half], by_token[:, half:]
        yield found, _sums(by_context.take(order, axis=0), starts, n), n


class Learner:
    """One task's copy of the vectors, moved along the gradient with damped steps."""

    def __init__(self, shared: Decisions):
        self.own = copy(shared)
        self.before = shared.vectors, shared.context
        self.own.vectors, self.own.context = shared.vectors.copy(), shared.context.copy()
        # a row is one value, which is faster to put
        self.rows = [v.view(f"V{v.itemsize * DIMENSIONS}")[:, 0] for v in (self.own.vectors, self.own.context)]
        self.squares = [np.full(len(v), DAMPED, np.float32) for v in self.before]
        self.seen = [np.zeros(len(v), np.int64) for v in self.before]
        self.rng = np.random.default_rng(3)

    def learn(self, leaf: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        inner = self.rng.permutation(np.flatnonzero(self.own.length[leaf]))
        for start in range(0, len(inner), TOGETHER):
            at = inner[start : start + TOGETHER]
            found = list(self.own.gradients(leaf[at], one[at], two[at]))
            for value, put, squares, seen, (rows, gradient, n) in zip(
                (self.own.vectors, self.own.context), self.rows, self.squares, self.seen, found
            ):
                damped = squares.take(rows) + np.einsum("ij,ij->i", gradient, gradient) / DIMENSIONS
                squares[rows] = damped
                gradient *= (RATE / np.sqrt(damped))[:, None]
                gradient += value.take(rows, axis=0)
                put[rows] = gradient.view(put.dtype)[:, 0]
                seen[rows] += n

    def moved(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of decisions and then of contexts: those met, how often, and their moves."""
        for value, before, seen in zip((self.own.vectors, self.own.context), self.before, self.seen):
            rows = np.flatnonzero(seen)
            yield rows, seen[rows], value[rows] - before[rows]


#: What rows of a training task are about.
_TRIPLES, _DECISIONS, _CONTEXTS = 0, 1, 2
#: Ids whose counts and moves are a row together; as many at any size.
BLOCK = 2048
_BLOCKS = "kind int, block int, ids binary, n binary, moves binary"


def _blocks(kind: int, ids: np.ndarray, n: np.ndarray, moves: np.ndarray | None) -> Iterator[tuple]:
    """Rows of ascending ids: places in their block, counts, and moves in half precision."""
    block = ids // BLOCK
    starts = np.flatnonzero(np.diff(block, prepend=-1) > 0)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
        width = 4 if n[a:b].max() < 1 << 32 else 8
        yield (
            kind, int(block[a]), (ids[a:b] % BLOCK).astype("<u2").tobytes(), n[a:b].astype(f"<u{width}").tobytes(),
            b"" if moves is None else moves[a:b].astype("<f2").tobytes(),
        )


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    """One block over all tasks: counts, and the mean move by occurrences (in single precision)."""
    kind = int(rows["kind"].iloc[0])
    total = np.zeros(BLOCK, np.int64)
    moves = np.zeros((BLOCK, DIMENSIONS))
    for ids, n, moved in zip(rows["ids"], rows["n"], rows["moves"]):
        ids = np.frombuffer(ids, "<u2")
        n = np.frombuffer(n, f"<u{len(n) // len(ids)}").astype(np.int64)
        total[ids] += n
        if kind != _TRIPLES:
            moves[ids] += np.frombuffer(moved, "<f2").reshape(-1, DIMENSIONS) * n[:, None].astype(float)
    ids = np.flatnonzero(total)
    mean = b"" if kind == _TRIPLES else (moves[ids] / total[ids, None]).astype("<f4").tobytes()
    return pd.DataFrame(
        {"kind": [kind], "block": [rows["block"].iloc[0]], "ids": [ids.astype("<u2").tobytes()], "n": [total[ids].astype("<i8").tobytes()], "moves": [mean]}
    )


def _ids(rows: pd.DataFrame) -> np.ndarray:
    """Ids of summed blocks, in their order."""
    return np.concatenate([np.frombuffer(x, "<u2") + np.int64(b) * BLOCK for b, x in zip(rows["block"], rows["ids"])])


def _train(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, decisions = shared.value
        learner = Learner(decisions)
        counts = np.zeros(UNITS**3, np.int64)
        for batch in batches:
            for _, texts in _batches_of(batch.column(0).to_pylist()):
                pieces, at, starts = _in_a_row(texts)
                kinds = pc.dictionary_encode(pieces)
                leaf = np.full(len(at) + len(texts), decisions.rest[0], np.int32)
                leaf[at] = decisions.of_all(kinds.dictionary).take(kinds.indices.to_numpy())
                unit = decisions.units[leaf]
                one, two = contexts(unit, starts)
                counts += np.bincount((two * UNITS + one) * UNITS + unit, minlength=UNITS**3)
                learner.learn(leaf, *contexts(leaf, starts))
        found = np.flatnonzero(counts)
        parts = [(found, counts[found], None), *learner.moved()]
        for kind, part in enumerate(parts):
            rows = list(_blocks(kind, *part))
            for at in range(0, len(rows), 20):
                columns = zip(zip(*rows[at : at + 20]), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["kind", "block", "ids", "n", "moves"])

    return run


class LogBilinear:
    """Unit distributions from two context units."""

    def __init__(self, used: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        d = DIMENSIONS
        self.used = used
        self.p = {
            "context": rng.normal(0, 0.1, (UNITS, d)), "target": rng.normal(0, 0.1, (UNITS, d)),
            "one": np.eye(d) + rng.normal(0, 0.05, (d, d)), "two": 0.5 * np.eye(d) + rng.normal(0, 0.05, (d, d)),
            "bias": np.zeros(UNITS),
        }

    def train(self, triples: np.ndarray, counts: np.ndarray, steps: int = STEPS, seed: int = 1) -> None:
        """Noise-contrastive estimation on triples drawn by their counts; noise is the unigram."""
        rng = np.random.default_rng(seed)
        two, one, target = triples // UNITS**2, triples // UNITS % UNITS, triples % UNITS
        unigram = np.bincount(target, counts, UNITS) + 1e-6
        unigram /= unigram.sum()
        self.p["bias"] = np.log(unigram)
        until = np.cumsum(counts / counts.sum())
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        log_noise = np.log(NOISE * unigram)
        for step in range(1, steps + 1):
            drawn = np.minimum(np.searchsorted(until, rng.random(BATCH)), len(until) - 1)
            a, b, v = one[drawn], two[drawn], target[drawn]
            noise = rng.choice(UNITS, NOISE, p=unigram)
            p = self.p
            predicted = p["context"][a] @ p["one"] + p["context"][b] @ p["two"]
            true = (predicted * p["target"][v]).sum(axis=1) + p["bias"][v] - log_noise[v]
            false = predicted @ p["target"][noise].T + p["bias"][noise] - log_noise[noise]
            # gradients of -log sigma(true) - sum log(1 - sigma(false))
            d_true = (0.5 * (np.tanh(0.5 * true) + 1) - 1) / BATCH
            d_false = 0.5 * (np.tanh(0.5 * false) + 1) / BATCH
            d_predicted = d_true[:, None] * p["target"][v] + d_false @ p["target"][noise]
            g = {k: np.zeros_like(x) for k, x in p.items()}
            np.add.at(g["target"], v, d_true[:, None] * predicted)
            np.add.at(g["target"], noise, d_false.T @ predicted)
            np.add.at(g["bias"], v, d_true)
            np.add.at(g["bias"], noise, d_false.sum(axis=0))
            g["one"], g["two"] = p["context"][a].T @ d_predicted, p["context"][b].T @ d_predicted
            np.add.at(g["context"], a, d_predicted @ p["one"].T)
            np.add.at(g["context"], b, d_predicted @ p["two"].T)
            rate = 0.02 * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for k in p:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.001 * (g[k] ** 2 - second[k])
                p[k] -= rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-10)

    def table(self) -> np.ndarray:
        """Normalised natural log-probabilities (two back, one back, unit)."""
        p = self.p
        one, two = p["context"] @ p["one"], p["context"] @ p["two"]
        logits = (two[:, None, :] + one[None, :, :]).reshape(-1, DIMENSIONS) @ p["target"].T + p["bias"]
        logits[:, ~self.used] = -np.inf
        top = logits.max(axis=1, keepdims=True)
        logits -= top + np.log(np.exp(logits - top).sum(axis=1, keepdims=True))
        return logits.reshape(UNITS, UNITS, UNITS)


class Model:
    """What scoring needs in a task: bounded tables only."""

    def __init__(self, decisions: Decisions, mass: np.ndarray, table: np.ndarray, frequent: dict[bytes, int], total: int, distinct: int):
        self.decisions, self.total, self.distinct = decisions, total, distinct
        self.unit_logs = (table / math.log(10) - np.log10(mass)).astype(np.float32)
        # of the commonest tokens and the end: place, leaf, count
        counts = {END: 0} | frequent
        self.names = pa.array(list(counts), pa.binary())
        self.leaf = np.fromiter(map(decisions.leaves.__getitem__, counts), np.int32, len(counts))
        self.count = np.fromiter(counts.values(), np.int64, len(counts))


def fit(spark, counts: DataFrame, training: DataFrame, steps: int = STEPS) -> Model:
    """The model of training texts ``t`` with their written token counts."""
    is_end = F.col("token") == F.lit(END)
    total, distinct, ends = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.sum(F.when(is_end, F.col("n")))).first()
    short = counts.filter(F.octet_length("token") <= LONGEST_FREQUENT)
    # distinct counts are few; the least one that at most FREQUENT tokens reach
    reached = short.groupBy("n").count().orderBy(F.desc("n")).limit(FREQUENT).toPandas()
    above = reached["n"][reached["count"].cumsum() <= FREQUENT].min() if len(reached) else None
    common = short.filter(F.col("n") >= int(above)).collect() if above == above and above is not None else []
    frequent = {bytes(r["token"]): r["n"] for r in sorted(common, key=lambda r: (-r["n"], r["token"]))}
    if ends:
        frequent[END] = ends
    words = [(END, ends or 0)] + [(w, n) for w, n in frequent.items() if w != END][: UNIT_WORDS - 1]
    named = [bytes(w) for w, _ in words]
    others = counts.filter(~F.col("token").isin(*[F.lit(w) for w in named]))
    endings = others.mapInArrow(_count_endings, "ending binary, n long, kinds long").groupBy("ending").agg(
        F.sum("n").alias("n"), F.sum("kinds").alias("kinds")
    )  # at most 65,793 endings of up to two bytes
    units = Units(words, [(bytes(r["ending"]), r["n"], r["kinds"]) for r in endings.collect()])
    decisions = Decisions(units, frequent)
    done = training.select("t").mapInArrow(_train(spark.sparkContext.broadcast((units, decisions))), _BLOCKS)
    summed = written(done.groupBy("kind", "block").applyInPandas(_summed, _BLOCKS), "lm-sums")
    neural = LogBilinear(units.used)
    found = summed.filter(F.col("kind") == _TRIPLES).select("block", "ids", "n").toPandas()  # at most UNITS^3 ids
    if len(found):
        found = found.sort_values("block")
        neural.train(_ids(found), np.frombuffer(b"".join(found["n"]), "<i8").astype(float), steps)
    for kind, values in ((_DECISIONS, decisions.vectors), (_CONTEXTS, decisions.context)):
        moved = summed.filter(F.col("kind") == kind).select("block", "ids", "moves").toPandas()  # at most 2 FREQUENT ids
        if len(moved):
            values[_ids(moved)] += np.frombuffer(b"".join(moved["moves"]), "<f4").reshape(-1, DIMENSIONS)
    return Model(decisions, units.mass, neural.table(), frequent, int(total), int(distinct))


_ROWS = "n_tokens long, n_known long, log_count double, unit_log double, rare array<struct<token:binary,n:long>>"


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        decisions, known = model.decisions, model.count > 0
        logs = np.log10(model.count + 0.5)
        for batch in batches:
            parts = []
            for _, texts in _batches_of(batch.column(2).to_pylist()):
                pieces, at, starts = _in_a_row(texts)
                # distinct tokens, after them the end
                kinds = pc.dictionary_encode(pieces)
                found = np.append(_found(kinds.dictionary, model.names), 0)
                is_rare = found < 0
                rare = kinds.dictionary.filter(pa.array(is_rare[:-1]))
                leaf_of, known_of, log_of = model.leaf.take(found), known.take(found), logs.take(found)
                leaf_of[is_rare], known_of[is_rare], log_of[is_rare] = decisions.missing(rare), False, 0.0
                kind = np.full(len(at) + len(texts), len(found) - 1, np.int32)
                kind[at] = kinds.indices.to_numpy()
                leaf, there, log_of = leaf_of.take(kind), known_of.take(kind), log_of.take(kind)
                left = np.flatnonzero(is_rare.take(kind))
                unit = decisions.units[leaf]
                one, two = contexts(unit, starts)
                unit_log = np.add.reduceat(model.unit_logs[two, one, unit], starts, dtype=np.float64)
                unit_log += np.add.reduceat(decisions.gains(leaf, *contexts(leaf, starts)), starts) / math.log(10)
                n = np.diff(np.append(starts, len(kind)))
                # other tokens per text, each with its number there
                size = max(1, len(rare))
                number = np.cumsum(is_rare) - 1
                pairs, often = np.unique(np.repeat(np.arange(len(texts)), n)[left] * size + number.take(kind[left]), return_counts=True)
                ends = np.searchsorted(pairs, np.arange(len(texts) + 1) * size)
                rare = pa.StructArray.from_arrays([rare.take(pa.array(pairs % size)), pa.array(often, pa.int64())], ["token", "n"])
                parts.append(
                    [pa.array(n, pa.int64()), pa.array(np.add.reduceat(there.astype(np.int64), starts)),
                     pa.array(np.add.reduceat(log_of, starts)), pa.array(unit_log),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare)]
                )
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *(pa.concat_arrays(p) for p in zip(*parts))],
                    names=["key", "held_out", "n_tokens", "n_known", "log_count", "unit_log", "rare"],
                )

    return run


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", steps: int = STEPS) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    need(docs, key, text)
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), held_out(key, 5, 1).alias("held_out"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("t"),
    )
    training = rows.filter(~F.col("held_out"))
    counts = written(count_tokens(training), "token-counts")
    model = fit(spark, counts, training, steps)
    schema = StructType([*rows.select("key", "held_out").schema.fields, *StructType.fromDDL(_ROWS).fields])
    first = rows.mapInArrow(_scorer(spark.sparkContext.broadcast(model)), schema)
    first = written(first.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rare = first.select("row", F.inline("rare"))
    # every rare token has a count of its own in the table or is unknown
    met = rare.join(counts.withColumnRenamed("n", "c"), "token", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("rare_known"),
    )
    log_count = F.col("log_count") + F.coalesce("rare_log", F.lit(0.0))
    floor = math.log10(model.total + 0.5 * (model.distinct + 1))
    return first.drop("rare").join(met, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (log_count - F.col("n_tokens") * floor).alias("base_score"),
        (log_count + F.col("unit_log")).alias("score"),
    )
