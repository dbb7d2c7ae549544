"""Near copies of the pipeline against all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import corpus_pipeline

from arrearscope.llm import near_copies, simhash
from tests.llm.conftest import ODD_TEXTS, lower, prose, words


def plain_set(text: str | None) -> frozenset:
    w = words(lower(text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def alike(a: frozenset, b: frozenset) -> bool:
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def plain_kept(docs: list[tuple]) -> list:
    sets = {k: plain_set(t) for k, t in docs}
    root = {k: k for k in sets}
    for a, b in combinations(sorted(sets), 2):
        if alike(sets[a], sets[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {k: low if r == high else r for k, r in root.items()}
    return sorted(set(root.values()))


def changed(rng: random.Random, text: str, n: int) -> str:
    w = text.split()
    for at in rng.sample(range(len(w)), n):
        w[at] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def test_copies_alike_to_four_fifths_go(spark, make_docs, small_docs):
    rng = random.Random(21)
    texts = [*ODD_TEXTS, "one two three four", "One two  three\nfour"]
    for size in (40, 150, 600):
        for n in range(0, 1 + size // 25):
            base = prose(rng, size, 5000)
            texts += [base, changed(rng, base, n), changed(rng, base, max(1, n // 2))]
    family = prose(rng, 200, 5000)
    texts += [changed(rng, family, rng.choice((1, 2, 3, 6))) for _ in range(60)]
    rng.shuffle(texts)
    for docs in (make_docs(*texts), small_docs):
        want = plain_kept([(r["doc_id"], r["text"]) for r in docs.collect()])
        kept = corpus_pipeline.near_duplicates(spark, docs, "")
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_equal_rows_and_null_keys(spark, make_docs):
    base = prose(random.Random(22), 100, 5000)
    docs = make_docs((4, base), (4, base), (None, base), (None, f"{base} end"), (None, "alone"), (9, None), (8, ""))
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(0, "alone"), (4, base), (8, "")]


def test_links_beside_the_smallest_of_a_band_are_kept(spark, make_docs):
    """A document alike to its band's smallest one is linked to others of the band, too."""
    rng = random.Random(23)
    texts = []
    for _ in range(40):
        w = prose(rng, 55, 5000).split()
        # 40, 50 and 51 shingles: the first and the last are not alike, the second is to both
        texts += [" ".join(w[6:50]), " ".join(w[1:]), " ".join(w)]
    rng.shuffle(texts)
    docs = make_docs(*texts)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    want = plain_kept([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(r["doc_id"] for r in kept.collect()) == want and len(want) == 40


def test_candidates_come_from_the_grid(make_docs):
    """Texts within two bits of SimHash meet there."""
    rng = random.Random(24)
    base = prose(rng, 2000, 5000)
    texts = [base, f"{base} end", prose(rng, 300, 5000), ""]
    sets = [(str(i).encode(), simhash.majority(near_copies.shingles(t.encode()))) for i, t in enumerate(texts)]
    spark = make_docs().sparkSession
    pairs = near_copies._on_grid(spark.createDataFrame(sets, "node binary, sketch long")).collect()
    assert [(bytes(r["a"]), bytes(r["node"])) for r in pairs] == [(b"0", b"1")]
