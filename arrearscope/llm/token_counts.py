"""Token counts under a unigram vocabulary, by a trie of distinct pre-tokens.

A pre-token is a run without white space, with the word mark in front. The best
segmentation of a prefix depends on the prefix alone, so the forward score of a
trie node (best sum of piece scores, and the pieces it takes) is computed once for
all pre-tokens that share it; the count at a pre-token's last node is stored and
documents add up stored counts.

Scores: the vocabulary files carry ranks and no probabilities, so a piece of rank
r has the Zipf score -ln(r + 1). A character that no piece covers counts as its
UTF-8 bytes, at a score ten below the lowest. Equal scores take fewer pieces.

Defined results: null and empty texts count 0; rows stay as they are, repeated or
not; other columns are kept, those named like the added ones give way to them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.llm.texts import need, without

#: Word mark of the vocabulary, U+2581.
MARK = "▁"
#: Trie nodes a Python worker holds; beyond it the trie starts afresh.
MOST_NODES = 400_000
#: Pre-tokens whose counts a Python worker holds, likewise.
MOST_KNOWN = 600_000
#: Characters of a pre-token that are kept in the trie; the rest is scored beside it.
DEEPEST = 48
#: Characters counted at a time.
BATCH_CHARS = 2_000_000


def piece_scores(path: str) -> dict[str, float]:
    """Zipf scores of the ordinary pieces of a vocabulary file, by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {piece: -math.log(rank + 1) for rank, piece in enumerate(dict.fromkeys(pieces), start=1)}


class Trie:
    """Forward scores and piece counts of prefixes, each computed once."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.unknown = min(scores.values()) - 10.0
        #: Scores of all endings of pieces; an ending that is no piece has none.
        self.endings: dict[str, float | None] = {p[i:]: None for p in scores for i in range(1, len(p))} | scores
        self.terminal: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        """Forget the nodes; counts of pre-tokens stay."""
        self.children: list[dict[str, int]] = [{}]
        self.best: list[float] = [0.0]
        self.pieces: list[int] = [0]

    def _forward(self, token: str, end: int, best: list[float], pieces: list[int]) -> tuple[float, int]:
        """Best score and count of ``token[:end]`` from those of all shorter prefixes."""
        scores, endings, last = self.scores, self.endings, token[end - 1]
        top, count = -math.inf, 0
        for start in range(end - 1, max(0, end - self.longest) - 1, -1):
            score = endings.get(token[start:end], math.inf)
            if score is None:
                continue
            if score == math.inf:
                break  # no piece ends like this, so no longer one does
            score += best[start]
            if score > top or (score == top and pieces[start] + 1 < count):
                top, count = score, pieces[start] + 1
        if last not in scores and best[end - 1] + self.unknown > top:
            top, count = best[end - 1] + self.unknown, pieces[end - 1] + len(last.encode("utf-8", "surrogatepass"))
        return top, count

    def insert(self, token: str) -> int:
        """Count of a pre-token; new nodes get their forward score on the way."""
        node, best, pieces = 0, [0.0], [0]
        for end, char in enumerate(token[:DEEPEST], start=1):
            child = self.children[node].get(char)
            if child is None:
                child = len(self.children)
                self.children[node][char] = child
                self.children.append({})
                score, count = self._forward(token, end, best, pieces)
                self.best.append(score)
                self.pieces.append(count)
            node = child
            best.append(self.best[node])
            pieces.append(self.pieces[node])
        for end in range(DEEPEST + 1, len(token) + 1):
            score, count = self._forward(token, end, best, pieces)
            best.append(score)
            pieces.append(count)
        return pieces[-1]

    def counts(self, texts: list[str]) -> Iterator[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        cut = [t.split() for t in texts]
        if len(self.children) > MOST_NODES:
            self.clear()
        if len(self.terminal) > MOST_KNOWN:
            self.terminal = {}
        known, once = self.terminal, {}
        for word in set(chain.from_iterable(cut)):
            if word not in known:
                (known if len(word) < DEEPEST else once)[word] = self.insert(MARK + word)
        for words in cut:
            if once:
                yield len(words), sum(once[w] if w in once else known[w] for w in words)
            else:
                yield len(words), sum(map(known.__getitem__, words))


_tries: dict[str, Trie] = {}


def _trie(path: str) -> Trie:
    if path not in _tries:
        _tries[path] = Trie(piece_scores(path))
    return _tries[path]


def _counter(path: str, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(path)
        for batch in batches:
            held, chars, counted = [], 0, []
            for text in batch.column(text_at).to_pylist():
                held.append(text or "")
                chars += len(held[-1])
                if chars >= BATCH_CHARS:
                    counted += trie.counts(held)
                    held, chars = [], 0
            counted += trie.counts(held)
            added = [pa.array([c[i] for c in counted], pa.int64()) for i in (0, 1)]
            kept = [batch.column(i) for i in range(batch.num_columns) if i != text_at]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=names)

    return run


def count(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """All columns but the text, with n_pretokens and n_tokens; no shuffle."""
    need(docs, text)
    kept = without(docs.columns, text, "n_pretokens", "n_tokens")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string"))
    schema = rows.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("long").alias("n_pretokens"), F.lit(0).cast("long").alias("n_tokens")).schema
    return rows.mapInArrow(_counter(vocabulary, len(kept), schema.names), schema)
