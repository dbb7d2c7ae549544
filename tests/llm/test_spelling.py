"""Spelling variants against generated neighbourhoods."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arrearscope.llm import spelling
from tests.llm.conftest import ODD_TEXTS, lower

ALPHABET = [chr(c) for c in spelling.LETTERS.tolist()]


def plain_vocabulary(rows) -> dict[str, int]:
    counts: Counter = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{word}".encode())
            counts[word if h % 199 else word[: h % len(word)] + word[h % len(word) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def neighbours(word: str) -> set[str]:
    near = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for letter in ALPHABET:
        near |= {word[:i] + letter + word[i:] for i in range(len(word) + 1)}
        near |= {word[:i] + letter + word[i + 1 :] for i in range(len(word))}
    return near - {word}


def plain_variants(rows) -> dict[str, tuple]:
    words = plain_vocabulary(rows)
    form, count = {}, {}
    for w, n in words.items():
        near = neighbours(w) & words.keys()
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
        count[w] = len(near)

    def root(w: str) -> str:
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, count[w], words.get(form[w])) for w, n in words.items()}


def found(df) -> dict[str, tuple]:
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_given_texts(small_docs):
    want = plain_variants(small_docs.collect())
    assert found(spelling.variants(small_docs)) == want
    # many small filters in many rounds
    assert found(spelling.variants(small_docs, shard_words=7, round_bytes=256)) == want


def test_chains_ties_and_odd_texts(make_docs):
    rng = random.Random(5)
    counts = {"letter": 700, "lettre": 5, "lettér": 130, "letté": 9, "lettérs": 20, "lettèrs": 20, "aaaaaa": 40, "aaaaaaa": 8, "baaaaa": 40, "STRASSE": 6}
    words = [w for w, n in counts.items() for _ in range(n)]
    rng.shuffle(words)
    texts = [" ".join(words[i::7]) for i in range(7)]
    docs = make_docs(*texts, *ODD_TEXTS, (None, "letter " * 11), (3, texts[0]), (3, texts[0]), (500, "longer-words," * 100_000), (501, "é" * 300_000))
    want = plain_variants(docs.collect())
    assert want["lettérs"][0] == "lettér" and want["lettérs"][1] == "letter"
    assert found(spelling.variants(docs)) == want


def test_empty_and_clashing(make_docs):
    docs = make_docs((1, "wonderful " * 9 + "wonderfull " * 60))
    want = found(spelling.variants(docs))
    assert want == plain_variants(docs.collect()) and want["wonderful"][0] == "wonderfull"
    assert spelling.variants(docs.limit(0)).collect() == []
    assert spelling.variants(make_docs(None, "", "few")).collect() == []
    names = ("word", "n", "form", "root", "run", "key", "n_near", "edit")
    assert found(spelling.variants(docs.select("*", *[F.lit(1).alias(c) for c in names]))) == want
    with pytest.raises(ValueError, match="text"):
        spelling.variants(docs.drop("text"))


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("aabcÿé"), min_size=2, max_size=9))
def test_hashes_of_edits(word):
    codes = spelling._codes([word], len(word))
    shorter = {word[:i] + word[i + 1 :] for i in range(len(word))}
    row, place, hashes = spelling.deletions(codes)
    made = {word[:p] + word[p + 1 :]: h for p, h in zip(place.tolist(), hashes.tolist())}
    assert len(place) == len(shorter) == len(made)
    assert made == {w: int(spelling.word_hashes(spelling._codes([w], len(w)))[0]) for w in shorter}
    for row, place, hashes, letter in spelling.replacements(codes):
        for p, h in zip(place.tolist(), hashes.tolist()):
            other = word[:p] + chr(letter) + word[p + 1 :]
            assert other > word and h == int(spelling.word_hashes(spelling._codes([other], len(other)))[0])


def test_filters_know_their_words_and_few_others():
    rng = np.random.default_rng(3)
    inside, outside = rng.integers(0, 1 << 63, (2, 50_000)).astype(np.uint64)
    table = spelling.build_filter(inside)
    assert table.nbytes * 8 <= 50_000 * spelling.BITS_PER_WORD + spelling.BLOCK_BITS
    assert spelling.known(table, inside).all()
    assert spelling.known(table, outside).mean() < 0.01
    assert len(spelling.known(table, inside[:0])) == 0


def test_rounds_are_bounded():
    sizes = [(6, 0, 40), (6, 1, 40), (7, 0, 100), (8, 0, 10), (8, 1, 90), (9, 0, 1)]
    rounds = list(spelling._rounds(sizes, 100))
    assert rounds == [[(6, 0), (6, 1)], [(7, 0)], [(8, 0), (8, 1)], [(9, 0)]]
    assert list(spelling._rounds([], 100)) == []
