"""Language identification and language-model scores: gradients, sums and held-out results."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from arrearscope.llm import language, lm_scoring
from tests.llm.conftest import ODD_TEXTS, lower, words

MEDIUM = "/root/testdata/sf0.01"


def fold(key: int | None, modulus: int) -> int:
    return zlib.crc32(b"" if key is None else str(key).encode()) % modulus


def test_backpropagation_equals_differences():
    tagger = language.ByteTagger(["a", "b", "c"], hidden=4)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    batch, labels = [b"abc", b"b", b"cabca"], np.array([0, 2, 1])
    _, grads = tagger.gradients(batch, labels)
    rng = np.random.default_rng(0)
    for name, value in tagger.p.items():
        used = np.flatnonzero(grads[name])
        for at in rng.choice(used, min(6, len(used)), replace=False):
            where, step = np.unravel_index(at, value.shape), 1e-3
            kept = value[where]
            value[where] = kept + step
            above = tagger.gradients(batch, labels)[0]
            value[where] = kept - step
            below = tagger.gradients(batch, labels)[0]
            value[where] = kept
            assert grads[name][where] == pytest.approx((above - below) / (2 * step), rel=2e-2, abs=2e-4)


def test_positions_are_labelled_with_distributions():
    tagger = language.ByteTagger(["a", "b"])
    data, there = tagger.table([b"abc", b"x"])
    log_p, _ = tagger.log_probabilities(data, there)
    assert np.exp(log_p).sum(axis=2) == pytest.approx(np.ones(there.shape), abs=1e-5)
    alone = tagger.pooled([b"x"])[0]
    assert tagger.pooled([b"abc", b"x"])[1] == pytest.approx(alone, abs=1e-5)


def test_segments_cover_every_byte():
    text = ("Ab " + "z" * 100 + "\tc").encode()
    assert b"".join(language.segments(text)) == b"ab" + b"z" * 100 + b"c"
    assert max(map(len, language.segments(text))) == language.STRETCH


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = language.predict(docs, language.fit(docs, steps=300)).collect()
    true = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert len(rows) == len(true)
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == true[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_only_training_labels_are_learned(make_docs):
    docs = make_docs(*ODD_TEXTS, *ODD_TEXTS[6:9], (None, "ein text"))
    tagger = language.fit(docs, steps=5)
    rows = language.predict(docs, tagger).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = ODD_TEXTS[r["doc_id"]] if r["doc_id"] is not None and r["doc_id"] < len(ODD_TEXTS) else "x"
        if not any(map(str.isalpha, text or "")):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    unlabelled = docs.withColumn("lang", docs["source"])
    assert language.fit(unlabelled) is None
    assert {r["lang_pred"] for r in language.predict(unlabelled, None).collect()} == {"und"}
    assert language.predict(make_docs(), tagger).count() == 0


def plain_base(docs: list[tuple]) -> dict:
    def tokens(t):
        return [*words(lower(t or "")), "\n"]

    counts = Counter(w for k, t in docs if fold(k, 5) != 1 for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    floor = total + 0.5 * (distinct + 1)
    return {
        k: (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, math.fsum(math.log10((counts[w] + 0.5) / floor) for w in tokens(t)))
        for k, t in docs
    }


@pytest.mark.parametrize("frequent", [lm_scoring.FREQUENT, 70])
def test_base_scores_equal_plain_sums(make_docs, small_docs, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    for docs in (make_docs(*ODD_TEXTS, "a a b"), small_docs):
        want = plain_base([(r["doc_id"], r["text"]) for r in docs.collect()])
        rows = lm_scoring.score(docs, steps=20).collect()
        assert len(rows) == len(want)
        for r in rows:
            n, known, total, base = want[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
            assert r["held_out"] == (fold(r["doc_id"], 5) == 1)
            assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_probabilities_sum_to_one():
    words_ = [(lm_scoring.END, 7), (b"the", 20), (b"of", 9)]
    others = {b"king": 3, b"ring": 2, b"cat": 1, b"odd": 1}
    endings = Counter()
    kinds = Counter()
    for w, n in others.items():
        endings[lm_scoring.ending(w)] += n
        kinds[lm_scoring.ending(w)] += 1
    units = lm_scoring.Units(words_, [(e, endings[e], kinds[e]) for e in endings])
    neural = lm_scoring.LogBilinear(units.used)
    rng = np.random.default_rng(0)
    triples = rng.integers(0, lm_scoring.UNITS**3, 500)
    neural.train(triples, np.ones(500), steps=30)
    table = np.exp(neural.table())
    assert table.sum(axis=2) == pytest.approx(np.ones(table.shape[:2]))
    counts = dict(words_) | others
    # one unknown token for every ending unit and the rest
    total = sum(table[3, 5, units.of(w)] * (n + 0.5) / units.mass[units.of(w)] for w, n in counts.items())
    unknown = [*units.endings.values(), lm_scoring.UNITS - 1]
    total += sum(table[3, 5, u] * 0.5 / units.mass[u] for u in unknown)
    assert total == pytest.approx(1.0)


def some_decisions(monkeypatch) -> tuple:
    monkeypatch.setattr(lm_scoring, "LEARNED", 2)
    words_ = [(lm_scoring.END, 7), (b"the", 20)]
    others = {b"king": 3, b"ring": 2, b"thing": 9, b"sing": 1, b"cat": 4, b"odd": 1}
    n, kinds = Counter(), Counter()
    for w, c in others.items():
        n[lm_scoring.ending(w)] += c
        kinds[lm_scoring.ending(w)] += 1
    monkeypatch.setattr(lm_scoring, "UNIT_ENDINGS", 1)  # all but -ng share the unit of the rest
    units = lm_scoring.Units(words_, [(e, n[e], kinds[e]) for e in n])
    found = lm_scoring.Decisions(units, dict(words_) | others)
    found.vectors = np.random.default_rng(4).normal(0, 0.5, found.vectors.shape)
    return units, found, dict(words_) | others


def test_decisions_share_out_all_of_a_unit(monkeypatch):
    units, found, counts = some_decisions(monkeypatch)
    leaf = np.array([found.of(w, units.of(w)) for w in counts])
    assert len(set(leaf[[units.of(w) == units.of(b"king") for w in counts]])) == 4  # three tokens and the rest
    for one, two in ((0, 0), (5, 61), (60, 3)):
        gains = np.exp(found.gains(leaf, np.full(len(leaf), one), np.full(len(leaf), two)))
        rest = np.exp(found.gains(found.rest, np.full(len(found.rest), one), np.full(len(found.rest), two)))
        for unit in {units.of(w) for w in counts}:
            total = sum(g * (c + 0.5) / units.mass[unit] for g, (w, c) in zip(gains, counts.items()) if units.of(w) == unit)
            total += 0.5 / units.mass[unit] * rest[unit] if unit >= lm_scoring.UNIT_WORDS else 0
            assert total == pytest.approx(1.0, abs=1e-5)


def test_gradients_of_decisions_equal_differences(monkeypatch):
    units, found, counts = some_decisions(monkeypatch)
    found.context = found.context.astype(np.float64)
    leaf = np.array([found.of(w, units.of(w)) for w in (b"king", b"thing", b"cat", b"sing", b"king")])
    one, two = np.array([3, 3, 9, 60, 2]), np.array([4, 3, 2, 1, 60])
    for value, (rows, gradient, _) in zip((found.vectors, found.context), found.gradients(leaf, one, two)):
        for row, of_row in zip(rows, gradient):
            for d in range(lm_scoring.DIMENSIONS):
                kept = value[row, d]
                value[row, d] = kept + 1e-3
                above = found.gains(leaf, one, two).sum()
                value[row, d] = kept - 1e-3
                below = found.gains(leaf, one, two).sum()
                value[row, d] = kept
                assert of_row[d] == pytest.approx((above - below) / 2e-3, rel=1e-3, abs=1e-5)


def test_context_tells_tokens_of_one_unit_apart(make_docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "UNIT_WORDS", 1)
    monkeypatch.setattr(lm_scoring, "UNIT_ENDINGS", 95 - 1)
    letters = "bcdfghjklm"
    filling = " ".join(f"w{a}{b}" for a in letters for b in letters for _ in range(12))  # their endings are the units
    trained = [k for k in range(200) if fold(k, 5) != 1][:40]
    one, other = [k for k in range(200) if fold(k, 5) == 1][:2]
    pairs = [(k, " ".join(["qxa zza qxb zzb"] * 5) + " " + filling) for k in trained]
    docs = make_docs(*pairs, (one, "qxa zza qxb zzb"), (other, "qxa zzb qxb zza"))
    rows = {r["doc_id"]: r for r in lm_scoring.score(docs, steps=30).filter("held_out").collect()}
    assert rows[one]["base_score"] == pytest.approx(rows[other]["base_score"])
    assert rows[one]["score"] > rows[other]["score"] + 0.1  # equal when units are all that is known


def test_the_model_beats_its_base_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    held = lm_scoring.score(docs).filter("held_out").collect()
    assert sum(r["score"] for r in held) > 0.97 * sum(r["base_score"] for r in held)
    assert sum(r["score"] > r["base_score"] for r in held) > 0.9 * len(held)


def test_scores_of_nothing(make_docs):
    assert lm_scoring.score(make_docs(), steps=5).collect() == []
    held = next(k for k in range(100) if fold(k, 5) == 1)
    (row,) = lm_scoring.score(make_docs((held, "only held out")), steps=5).collect()
    assert (row["n_known"], row["train_tokens"], row["base_score"]) == (0, 0, 0.0)


class Shared:
    def __init__(self, value):
        self.value = value


def test_sums_of_runs_equal_sums_one_by_one():
    rng = np.random.default_rng(5)
    for size, ids in ((1, 1), (50, 3), (5000, 900), (5000, 4000)):
        at = np.minimum(rng.zipf(1.4, size), ids)
        values = rng.normal(size=(size, lm_scoring.DIMENSIONS))
        want = np.zeros((ids + 1, lm_scoring.DIMENSIONS))
        np.add.at(want, at, values)
        found, order, starts, n = lm_scoring._runs(at)
        assert sorted(found) == sorted(set(at.tolist())) and n.tolist() == np.bincount(at)[found].tolist()
        assert lm_scoring._sums(values[order], starts, n) == pytest.approx(want[found])


def test_tokens_are_counted_and_meet_leaves_batch_by_batch(monkeypatch):
    texts = [b"The KING, sang: thing!", None, b"", b" ...?! odd\x0bthing\tring.\n", "\xe9ng ng \u00e9.\" n ,".encode(), b"king " * 9, b"\xff\xfe, .\xff", b"the odd king"]
    want = Counter(w for t in texts for w in [*lm_scoring.tokens(t or b""), lm_scoring.END])
    kinds = sorted(want)
    units, decisions, _ = some_decisions(monkeypatch)
    assert lm_scoring._endings(pa.array(kinds)).to_pylist() == [lm_scoring.ending(w) for w in kinds]
    leaves = [decisions.leaves[w] for w in kinds]
    for name in ("tokens", "ending"):  # no call a token
        monkeypatch.setattr(lm_scoring, name, lambda _: 1 / 0)
    assert decisions.of_all(pa.array(kinds)).tolist() == leaves
    batches = [pa.RecordBatch.from_arrays([pa.array(part, pa.binary())], names=["t"]) for part in (texts[:3], texts[3:], [])]
    monkeypatch.setattr(lm_scoring, "BATCH_CHARS", 20)
    for gathered, counted in ((1000, 1000), (3, 1000), (3, 4)):
        monkeypatch.setattr(lm_scoring, "GATHERED", gathered)
        monkeypatch.setattr(lm_scoring, "COUNTED", counted)
        rows = [r for b in lm_scoring._count_tokens(iter(batches)) for r in b.to_pylist()]
        found = Counter()
        for r in rows:
            found[r["token"]] += r["n"]
        assert found == want
        assert (len(rows) == len(want)) == (counted == 1000)
    (none,) = lm_scoring._count_tokens(iter([]))
    assert none.to_pylist() == [{"token": lm_scoring.END, "n": 0}]


def test_moves_of_a_task_are_few_rows_of_small_numbers(monkeypatch):
    units, decisions, _ = some_decisions(monkeypatch)
    decisions.vectors = decisions.vectors.astype(np.float32)
    batch = pa.RecordBatch.from_arrays([pa.array([b"king ring the thing cat king odd"] * 20)], names=["t"])
    rows = pa.Table.from_batches(list(lm_scoring._train(Shared((units, decisions)))(iter([batch])))).to_pylist()
    moves = [r for r in rows if r["kind"] != lm_scoring._TRIPLES]
    assert [r["kind"] for r in moves] == [lm_scoring._DECISIONS, lm_scoring._CONTEXTS]  # one block each, not a row an id
    for r in moves:
        ids = len(r["ids"]) // 2
        assert ids > 1 and len(r["moves"]) == 2 * lm_scoring.DIMENSIONS * ids
        assert sum(len(r[c]) for c in ("ids", "n", "moves")) <= 38 * ids


def test_blocks_sum_to_the_mean_by_occurrences():
    rng, n_ids, d = np.random.default_rng(6), 3 * lm_scoring.BLOCK, lm_scoring.DIMENSIONS
    total, moved, rows = np.zeros(n_ids), np.zeros((n_ids, d)), []
    for _ in range(4):
        ids = np.sort(rng.choice(n_ids, 700, replace=False))
        n, moves = rng.integers(1, 1 << 33, 700), rng.normal(size=(700, d)).astype(np.float16).astype(np.float32)
        total[ids] += n
        moved[ids] += moves * n[:, None].astype(float)
        rows += lm_scoring._blocks(lm_scoring._CONTEXTS, ids, n, moves)
    table = pd.DataFrame(rows, columns=["kind", "block", "ids", "n", "moves"])
    found = pd.concat([lm_scoring._summed(part) for _, part in table.groupby(["kind", "block"])])
    ids = lm_scoring._ids(found)
    assert ids.tolist() == np.flatnonzero(total).tolist()
    assert np.frombuffer(b"".join(found["n"]), "<i8").tolist() == total[ids].tolist()
    mean = np.frombuffer(b"".join(found["moves"]), "<f4").reshape(-1, d)
    assert mean == pytest.approx(moved[ids] / total[ids, None], abs=1e-6)
