"""Spelling variants: words one edit apart, found through Bloom filters of the vocabulary.

The vocabulary is cut into shards by word length and hash, and every shard becomes a
blocked Bloom filter built in its own task. Filters are broadcast in rounds of a fixed
number of bytes, so what is sent does not grow with the vocabulary, only the rounds do.
In a round every word generates its edits into the lengths at hand, as hashes: the hash
is a polynomial over the code points, so an edit's hash follows from the word's without
building the edit. Only edits that a filter knows become text and are joined with the
vocabulary, which drops what a filter let through by chance.

Being one edit apart is mutual, so a pair is generated from one side alone: deletions
(an insertion is one seen from the other word) and replacements by larger letters.

Defined results: a null text has no words, a null id is written as nothing in what the
slips are drawn from; words of equal counts are told apart by code points; repeated rows
count each; an empty table gives no rows; other columns are ignored. Texts are read
whole, and every word of the vocabulary takes part however common it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearscope.llm.texts import ascii_lower, let, need
from arrearscope.session import written

RUN = r"[A-Za-zÀ-ÿ]+"
#: Letters a lower-cased run can hold.
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint8)
MIN_LENGTH, MIN_COUNT = 6, 5
#: A word's form is at least so many times as frequent.
FORM_RATIO = 5
#: One occurrence in so many is made a slip.
SLIP_EVERY = 199

#: Words per filter, about.
SHARD_WORDS = 1 << 16
BITS_PER_WORD = 16
#: Bits of a block; all bits of a word lie in one.
BLOCK_BITS = 512
PROBES = 6
#: Filter bytes that are broadcast at once.
ROUND_BYTES = 32 << 20
#: Letters of the words whose edits are in memory together.
LETTERS_AT_ONCE = 1 << 14


def slipped(run: Column, key: Column) -> Column:
    """The lower-cased run, one code point less where the hash of key and run says so."""

    def spoiled(word: Column) -> Column:
        h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), word))
        at = F.pmod(h, F.char_length(word).cast("long")).cast("int")
        left = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
        return F.when(h % SLIP_EVERY == 0, left).otherwise(word)

    return let(ascii_lower(run), spoiled)


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    need(docs, key, text)
    runs = docs.select(F.col(f"`{key}`").alias("key"), F.explode(F.regexp_extract_all(f"`{text}`", F.lit(RUN), F.lit(0))).alias("run"))
    # a shorter run cannot become a word
    words = runs.filter(F.char_length("run") >= MIN_LENGTH).select(slipped(F.col("run"), F.col("key")).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter((F.char_length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


# -- hashes ---------------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A value per code point.
_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(n - 1, 0), _BASE))), dtype=np.uint64)


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length; all are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def _terms(codes: np.ndarray) -> np.ndarray:
    return _VALUES[codes] * _powers(codes.shape[1])


def word_hashes(codes: np.ndarray) -> np.ndarray:
    return _mixed(_terms(codes).sum(axis=1, dtype=np.uint64))


def deletions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash) of every distinct word one letter shorter."""
    terms = _terms(codes)
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    after = terms.sum(axis=1, dtype=np.uint64)[:, None] - before - terms
    distinct = np.ones(codes.shape, bool)
    # deleting either of two equal neighbours gives the same word
    distinct[:, 1:] = codes[:, 1:] != codes[:, :-1]
    row, place = np.nonzero(distinct)
    return row, place, _mixed(before[row, place] + after[row, place] * _BASE_INVERSE)


def replacements(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(row, place, hash, letter) of every word with one letter replaced by a larger one."""
    terms, powers = _terms(codes), _powers(codes.shape[1])
    rest = terms.sum(axis=1, dtype=np.uint64)[:, None] - terms
    for letter in LETTERS:
        row, place = np.nonzero(codes < letter)
        yield row, place, _mixed(rest[row, place] + _VALUES[letter] * powers[place]), int(letter)


# -- filters --------------------------------------------------------------------------


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes >> np.uint64(40)) % np.uint64(shards)


def _bits(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and its bits there as a mask of 64-bit words (n x 8)."""
    block = (hashes & np.uint64(0xFFFFFFFF)) % np.uint64(blocks)
    mask = np.zeros((len(hashes), BLOCK_BITS // 64), np.uint64)
    more = _mixed(hashes + _BASE)
    rows = np.arange(len(hashes))
    for i in range(PROBES):
        bit = (more >> np.uint64(9 * i)) & np.uint64(BLOCK_BITS - 1)
        mask[rows, (bit >> np.uint64(6)).astype(np.int64)] |= np.uint64(1) << (bit & np.uint64(63))
    return block.astype(np.int64), mask


def build_filter(hashes: np.ndarray) -> np.ndarray:
    blocks = max(1, -(-len(hashes) * BITS_PER_WORD // BLOCK_BITS))
    table = np.zeros((blocks, BLOCK_BITS // 64), np.uint64)
    np.bitwise_or.at(table, *_bits(hashes, blocks))
    return table


def known(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter; never false for one that is."""
    more = _mixed(hashes + _BASE)
    block = ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(len(table))).astype(np.int64)
    left = np.arange(len(hashes))
    flat = table.reshape(-1)
    for i in range(PROBES):
        # most edits fail the first bits; only the others are looked at again
        bit = (more[left] >> np.uint64(9 * i)) & np.uint64(BLOCK_BITS - 1)
        word = flat[block[left] * (BLOCK_BITS // 64) + (bit >> np.uint64(6)).astype(np.int64)]
        left = left[(word >> (bit & np.uint64(63))) & np.uint64(1) == 1]
    found = np.zeros(len(hashes), bool)
    found[left] = True
    return found


def _shards(shards_of: dict[int, int]):
    """(word, length, shard) of vocabulary rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.array(batch.column(0).to_pylist(), object)
            lengths = np.array([len(w) for w in words], np.int32)
            for length in np.unique(lengths).tolist():
                own = words[lengths == length].tolist()
                shard = _shard_of(word_hashes(_codes(own, length)), shards_of[length])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array([length] * len(own), pa.int32()), pa.array(shard.astype(np.int32))],
                    names=["word", "length", "shard"],
                )

    return run


def _filter_of(key: tuple, rows: pa.Table) -> pa.Table:
    length, shard = (int(k.as_py()) for k in key)
    table = build_filter(word_hashes(_codes(rows.column("word").to_pylist(), length)))
    return pa.table(
        {"length": pa.array([length], pa.int32()), "shard": pa.array([shard], pa.int32()), "bits": pa.array([table.tobytes()], pa.binary())}
    )


def filters(words: DataFrame, shards_of: dict[int, int]) -> DataFrame:
    """(length, shard, bits): the vocabulary as blocked Bloom filters of about ``SHARD_WORDS`` words."""
    placed = words.select("word").mapInArrow(_shards(shards_of), "word string, length int, shard int")
    return placed.groupBy("length", "shard").applyInArrow(_filter_of, "length int, shard int, bits binary")


# -- candidates -----------------------------------------------------------------------


def _positives(sent, shards_of: dict[int, int]):
    """(word, edit) rows of the edits that the filters at hand know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {k: np.frombuffer(b, np.uint64).reshape(-1, BLOCK_BITS // 64) for k, b in sent.value.items()}
        at_hand = {length: [s for l, s in tables if l == length] for length, _ in tables}

        def passing(length: int, hashes: np.ndarray) -> np.ndarray:
            shard = _shard_of(hashes, shards_of[length])
            found = np.zeros(len(hashes), bool)
            for s in at_hand[length]:
                own = np.nonzero(shard == np.uint64(s))[0]
                found[own] = known(tables[length, s], hashes[own])
            return np.nonzero(found)[0]

        def edits(words: list[str], length: int) -> Iterator[tuple[str, str]]:
            codes = _codes(words, length)
            if length - 1 in at_hand:
                row, place, hashes = deletions(codes)
                for j in passing(length - 1, hashes):
                    word, p = words[row[j]], place[j]
                    yield word, word[:p] + word[p + 1 :]
            if length in at_hand:
                for row, place, hashes, letter in replacements(codes):
                    for j in passing(length, hashes):
                        word, p = words[row[j]], place[j]
                        yield word, word[:p] + chr(letter) + word[p + 1 :]

        for batch in batches:
            by_length: dict[int, list[str]] = {}
            for word in batch.column(0).to_pylist():
                by_length.setdefault(len(word), []).append(word)
            for length, words in by_length.items():
                step = max(1, LETTERS_AT_ONCE // length)
                for start in range(0, len(words), step):
                    found = list(edits(words[start : start + step], length))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w for w, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())], names=["word", "edit"]
                    )

    return run


def _rounds(sizes: list[tuple[int, int, int]], most: int) -> Iterator[list[tuple[int, int]]]:
    """(length, shard) lists whose filters together have at most ``most`` bytes, or are one."""
    held, size = [], 0
    for length, shard, n in sizes:
        if held and size + n > most:
            yield held
            held, size = [], 0
        held.append((length, shard))
        size += n
    if held:
        yield held


def candidates(words: DataFrame, shard_words: int = SHARD_WORDS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, edit): every edit, generated from one side of a pair, that may be a word."""
    spark = words.sparkSession
    per_length = words.groupBy(F.char_length("word").alias("length")).agg(F.count("*").alias("n")).collect()
    shards_of = {r["length"]: -(-r["n"] // shard_words) for r in per_length}
    table = written(filters(words, shards_of), "filters")
    sizes = table.select("length", "shard", F.octet_length("bits").alias("n")).orderBy("length", "shard").collect()
    found = spark.createDataFrame([], "word string, edit string")
    for at_hand in _rounds([tuple(r) for r in sizes], round_bytes):
        lengths = sorted({length for length, _ in at_hand})
        first, last = at_hand[0], at_hand[-1]
        inside = F.struct("length", "shard").between(
            F.struct(F.lit(first[0]), F.lit(first[1])), F.struct(F.lit(last[0]), F.lit(last[1]))
        )
        held = {(r["length"], r["shard"]): bytes(r["bits"]) for r in table.filter(inside).collect()}
        sent = spark.sparkContext.broadcast(held)
        probing = words.filter(F.char_length("word").isin(*lengths, *[length + 1 for length in lengths])).select("word")
        # a word makes some hundred edits, so tasks are cut by words and not by bytes
        probing = probing.repartition("word")
        found = found.union(written(probing.mapInArrow(_positives(sent, shards_of), "word string, edit string"), "positives"))
        sent.unpersist()
    return found


def pairs(words: DataFrame, **kw) -> DataFrame:
    """(a, b, n_a, n_b): every pair of words one edit apart, once; ``words`` is (word, n)."""
    a = words.select(F.col("word"), F.col("n").alias("n_a"))
    b = words.select(F.col("word").alias("edit"), F.col("n").alias("n_b"))
    both = candidates(words, **kw).join(b, "edit").join(a, "word")
    return both.select(F.col("word").alias("a"), F.col("edit").alias("b"), "n_a", "n_b")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: forms are followed twice as far every round.

    A form is more frequent than its word, so there are no circles, and the rounds grow
    with the logarithm of the longest way, which the counts bound.
    """
    reached = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = written(reached.join(onward, "root", "left"), "roots")
        if further.filter("next IS NOT NULL").isEmpty():
            return reached
        reached = further.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    words = written(vocabulary(docs, key, text), "vocabulary")
    near = pairs(words, **kw)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("other"), F.col("n_a").alias("other_n")),
    )
    best = near.select(F.inline(sides)).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    most = -F.col("best.less")
    best = written(
        best.select(
            "word", "n_near", F.when(most >= FORM_RATIO * F.col("n"), F.col("best.other")).alias("form"),
            F.when(most >= FORM_RATIO * F.col("n"), most).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(best.filter("form IS NOT NULL"))
    rows = words.join(best, "word", "left").join(roots, "word", "left")
    return rows.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
