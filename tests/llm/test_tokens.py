"""Encoding, token files, packing and token counts against the tokenizers themselves."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from arrearscope.llm import hilbert, packing, token_counts, token_files
from arrearscope.llm.encoding import Encoder
from arrearscope.llm.queries import BYTE_END, BYTE_TOKENIZER, PIECES, WORD_END, WORD_TOKENIZER
from arrearscope.session import scratch_path
from tests.llm.conftest import ODD_TEXTS

PATHS = {name: public_tokenizers.path(name) for name in (WORD_TOKENIZER, BYTE_TOKENIZER)}
ENCODERS = {name: Encoder(path) for name, path in PATHS.items()}


def plain(name: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(PATHS[name])
    tokenizer.encode_special_tokens = True
    return tokenizer


WHOLE = {name: plain(name) for name in PATHS}


def whole_ids(name: str, text: str | None) -> list[int]:
    return WHOLE[name].encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list(" \n\t\r\x0b\x0c\x1c\x85\xa0  　aB's.,!09éÉİΣ世🙂́") + ["'re", "  ", "the"]), max_size=16))
def test_pieces_encode_as_the_whole_text(parts):
    text = "".join(parts)
    for name, encoder in ENCODERS.items():
        (found,) = encoder.encode([text])
        assert np.frombuffer(found, encoder.dtype).tolist() == whole_ids(name, text)


def test_words_and_marks_encode_as_the_whole_text(small_docs):
    words = {w for r in small_docs.limit(120).collect() for w in r["text"].split()}
    words |= {"Ärger,", "ÉTÉ", "ß", "ÿ!!", "don't.", "x_y", "a1b", "µm", "ª", "ÅNGSTRÖM###", "Œuvre", "'s", "word's", "é́", "K"}
    for name, encoder in ENCODERS.items():
        for form in ("{0}", " {0}", "x {0} y", "{0}\n{0}"):
            texts = [form.format(w) for w in sorted(words)]
            for text, ids in zip(texts, encoder.encode(texts)):
                assert np.frombuffer(ids, encoder.dtype).tolist() == whole_ids(name, text), text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=300))
def test_boundaries_round_trip_and_select(lengths):
    ends = np.cumsum(lengths)
    width, low, upper, samples = token_files.pack_boundaries(ends)
    bounds = token_files.Boundaries(len(ends), width, low, upper, samples)
    assert bounds.all().tolist() == ends.tolist()
    assert [bounds.select(i) for i in range(len(ends))] == ends.tolist()


def test_boundaries_take_few_bits():
    ends = np.arange(1, 10_001) * 500
    _, low, upper, samples = token_files.pack_boundaries(ends)
    assert (len(low) + len(upper) + len(samples)) * 8 / len(ends) < 12


def test_token_files_hold_every_document_in_order(spark, make_docs, small_docs):
    odd = make_docs(*ODD_TEXTS, (3, "a again"), (None, "no id"), (3, "a again"))
    for docs in (odd, small_docs):
        path = scratch_path(spark, "test-token-files")
        token_files.write(docs, path, PATHS[WORD_TOKENIZER], WORD_END)
        found = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in found] == sorted((r["doc_id"] for r in docs.collect()), key=lambda k: (k is not None, k))
        at = 0
        for r in found:
            assert r["start"] == at
            at += len(r["ids"]) // 4
        want = sorted(zlib.crc32(np.array(whole_ids(WORD_TOKENIZER, r["text"]) + [WORD_END], "<u4")) for r in docs.collect())
        assert sorted(zlib.crc32(r["ids"]) for r in found) == want


def test_a_block_is_closed_and_a_long_document_kept_whole(spark, make_docs, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 50)
    run = token_files._blocks(PATHS[WORD_TOKENIZER], WORD_END)
    import pyarrow as pa

    monkeypatch.setattr(token_files.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 7})()))
    texts = ["one two three"] * 40 + ["word " * 500] + [None] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["k", "t"])
    blocks = list(run(iter([batch])))
    assert len(blocks) > 3
    sizes = [n for b in blocks for n in np.diff(np.concatenate(([0], token_files.unpack_block(b.column(5)[0].as_py())[0].all())))]
    assert sizes == [len(whole_ids(WORD_TOKENIZER, t)) + 1 for t in texts]


def test_empty_tables(spark, make_docs):
    empty = make_docs()
    path = scratch_path(spark, "test-token-files")
    token_files.write(empty, path, PATHS[WORD_TOKENIZER], WORD_END)
    assert token_files.read(spark, path).collect() == []
    assert packing.sequences(empty, PATHS[BYTE_TOKENIZER], BYTE_END).collect() == []
    assert token_counts.count(empty, public_tokenizers.path(PIECES)).collect() == []


def test_a_word_is_encoded_once_whatever_marks_and_line_feeds_stand_by_it(monkeypatch):
    encoder = Encoder(PATHS[BYTE_TOKENIZER])
    asked, whole = [], []
    plain_word, plain_ids = encoder._word_ids, encoder._ids
    monkeypatch.setattr(encoder, "_word_ids", lambda word: asked.append(word) or plain_word(word))
    monkeypatch.setattr(encoder, "_ids", lambda pieces: whole.extend(pieces) or plain_ids(pieces))
    text = "Anf lor, lor. lor; lor.\nAnf lor.\nÖlat lor"
    (found,) = encoder.encode([text])
    assert np.frombuffer(found, encoder.dtype).tolist() == whole_ids(BYTE_TOKENIZER, text)
    assert sorted(asked) == [" lor", "Anf", "Ölat"]
    assert sorted(whole) == ["\n", ",", ".", ";"]  # no piece that reaches over a line feed
    for odd in ("a\n\n\nb", "a \nb", "a\n b\n", "\n\na\nb", "a\n\tb"):
        (found,) = encoder.encode([odd])
        assert np.frombuffer(found, encoder.dtype).tolist() == whole_ids(BYTE_TOKENIZER, odd)


def test_pieces_are_words_without_what_stands_by_them(monkeypatch):
    for name in PATHS:
        encoder, whole = Encoder(PATHS[name]), []
        plain_ids = encoder._ids
        monkeypatch.setattr(encoder, "_ids", lambda pieces, plain=plain_ids: whole.extend(pieces) or plain(pieces))
        texts = ["lor, \tlor\n\nlor!", "", " lor  ", None, " ", "\n lor;", "Öl.\r\nÖl", "  "]
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [whole_ids(name, t) for t in texts]
        assert not [x for x in whole if any(map(str.isalpha, x))]
        words = {x for x in encoder.known if any(map(str.isalpha, x))}
        assert {x.strip(" ").lower() for x in words} == {"lor", "öl"}  # none with a mark or a line feed


def test_texts_of_a_batch_stay_apart():
    rng = random.Random(8)
    parts = [" ", "\n", "\t", "\xa0", "a", "Öl", ",", "'s", "7", "\u0301", "世", "\0"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 4))) for _ in range(3000)]
    for name, encoder in ENCODERS.items():
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [whole_ids(name, t) for t in texts]


def test_sums_stay_in_falling_order():
    rng = random.Random(9)
    for _ in range(30):
        sizes = [rng.randint(1, 256) for _ in range(rng.randint(1, 200))]
        groups = packing.difference(sizes, rng.randint(1, 60))
        sums = [sum(sizes[i] for i in g) for g in groups]
        assert sums == sorted(sums, reverse=True)
        assert sorted(i for g in groups for i in g) == list(range(len(sizes)))


def test_differencing_balances():
    rng = random.Random(5)
    sizes = [rng.randint(1, 256) for _ in range(500)]
    groups = packing.difference(sizes, 60)
    sums = [sum(sizes[i] for i in g) for g in groups]
    assert sorted(i for g in groups for i in g) == list(range(500))
    assert max(sums) - min(sums) <= 8


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 256), max_size=80))
def test_packed_windows_hold_the_capacity(sizes):
    groups = packing.pack(sizes, 256)
    assert sorted(i for g in groups for i in g) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in g) <= 256 for g in groups)


def test_sequences_hold_every_id_once(make_docs, small_docs):
    docs = make_docs(*ODD_TEXTS, "long " * 9000, (2, ODD_TEXTS[2]))
    for table in (docs, small_docs):
        found = packing.sequences(table, PATHS[BYTE_TOKENIZER], BYTE_END).collect()
        want: dict = {}
        for r in table.collect():
            want.setdefault(r["doc_id"], []).append(whole_ids(BYTE_TOKENIZER, r["text"]) + [BYTE_END])
        pieces: dict = {}
        for r in found:
            ids = np.frombuffer(r["ids"], "<u4").tolist()
            assert len(ids) == r["length"]
            pieces.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
        for key, texts in want.items():
            if len(texts) == 1:
                parts = sorted(pieces[key])
                assert [p[0] for p in parts] == np.cumsum([0] + [len(p[1]) for p in parts])[:-1].tolist()
                assert sum((p[1] for p in parts), []) == texts[0]
                assert all(p[2] == len(texts[0]) for p in parts)
            else:
                assert sum(len(p[1]) for p in pieces[key]) == sum(map(len, texts))
        windows: dict = {}
        for r in found:
            windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for parts in windows.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= packing.CAPACITY
    total = sum(r["length"] for r in found)
    assert len(windows) * packing.CAPACITY < 1.06 * total


def test_token_counts_equal_the_unigram_model(make_docs, small_docs):
    scores = token_counts.piece_scores(public_tokenizers.path(PIECES))
    model = models.Unigram([("<unk>", 0.0), *scores.items()], 0, False)
    known = set(scores)

    def counted(word: str) -> int:
        return sum(1 if t.value in known else len(t.value.encode()) for t in model.tokenize(token_counts.MARK + word))

    for docs in (make_docs(*ODD_TEXTS, "ab" * 200), small_docs.select("doc_id", "text").limit(60)):
        found = {r["doc_id"]: r for r in token_counts.count(docs.select("doc_id", "text"), public_tokenizers.path(PIECES)).collect()}
        for r in docs.collect():
            parts = (r["text"] or "").split()
            assert found[r["doc_id"]]["n_pretokens"] == len(parts)
            assert found[r["doc_id"]]["n_tokens"] == sum(map(counted, parts))


def test_the_trie_starts_afresh_with_equal_counts(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_NODES", 20)
    scores = token_counts.piece_scores(public_tokenizers.path(PIECES))
    trie, texts = token_counts.Trie(scores), ["the tree trembles", "those trees trembled", "unrelated words entirely"]
    first = [c for t in texts for c in trie.counts([t])]
    assert first == list(token_counts.Trie(scores).counts(texts))


def test_counts_outlive_the_nodes(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_NODES", 5)
    trie = token_counts.Trie(token_counts.piece_scores(public_tokenizers.path(PIECES)))
    first = list(trie.counts(["the trees, the trees"]))
    monkeypatch.setattr(trie, "insert", lambda word: 1 / 0)  # nothing is scored twice
    assert list(trie.counts(["the trees, the trees"])) == first
    assert trie.endings["s"] is not None and "he" in trie.endings


def test_clashing_columns_give_way(make_docs):
    docs = make_docs("a").withColumnRenamed("source", "n_tokens").withColumnRenamed("lang", "slot")
    [row] = token_counts.count(docs, public_tokenizers.path(PIECES)).collect()
    assert row["n_tokens"] == row["n_pretokens"] == 1 and "slot" in row
    assert hilbert.assign(docs, ["n_chars"]).select("slot").collect() == [(0,)]
