"""Near duplicates, repeated passages, benchmark windows, rules and shards against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from arrearscope.llm import decontamination, hilbert, line_dedup, quality, simhash
from arrearscope.llm.components import components
from arrearscope.llm.queries import QUERIES
from tests.llm.conftest import ODD_TEXTS, lower, prose, words


def plain_fingerprint(text: str | None) -> int:
    w = words(lower(text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict) -> dict:
    parent = {k: k for k in prints}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {k: root(k) for k in prints}


def near_copies(rng: random.Random, n: int) -> list[str]:
    base = prose(rng, 300).split()
    out = []
    for _ in range(n):
        w = list(base)
        w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        out.append(" ".join(w))
    return out


def test_simhash_equals_all_pairs(make_docs, small_docs):
    rng = random.Random(1)
    texts = [*ODD_TEXTS, *near_copies(rng, 40), *near_copies(rng, 25), *[prose(rng, 60) for _ in range(30)]]
    texts += texts[:20]
    for docs in (make_docs(*texts), small_docs):
        want = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
        found = simhash.link(docs).collect()
        assert {r["key"]: r["fp"] & (2**64 - 1) for r in found} == want
        assert {r["key"]: r["chosen_key"] for r in found} == plain_components(want)
        assert len(found) == len(want)


def test_links_within_two_bits_are_all_found(spark):
    rng = random.Random(2)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(40):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    signed = {p - 2**64 if p >= 2**63 else p for p in prints}
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.links(table)).collect()}
    plain = plain_components({p: p & (2**64 - 1) for p in signed})
    groups = Counter(plain.values())
    assert set(roots) == {p for p in signed if groups[plain[p]] > 1}
    assert len({(roots[p], plain[p]) for p in roots}) == len(set(roots.values())) == sum(n > 1 for n in groups.values())


def test_components_of_a_long_chain(spark):
    order = list(range(300))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame([*zip(order, order[1:]), (1000, 1001), (1001, 1001)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(300)}, 1000: 1000, 1001: 1000}
    assert components(edges.limit(0)).collect() == []


def test_one_document_of_each_group_stays(make_docs):
    rng = random.Random(4)
    copies = near_copies(rng, 3)
    docs = make_docs((5, "same text here"), (4, "same text here"), (4, "same text here"), (None, "same text here"), (9, None), (8, ""), (1, copies[0]), (2, copies[0]))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 8]
    only_null = make_docs((None, "alone in the world"), (None, "another one entirely"))
    assert simhash.keep_one(only_null).count() == 2
    assert simhash.keep_one(make_docs()).count() == 0


def plain_dedup(docs: list[tuple], least: int) -> dict:
    """Lines of runs that stand earlier, by trying every run."""
    lines = {k: [(i, line) for i, line in enumerate((t or "").split("\n")) if words(line)] for k, t in docs}
    seen: dict = {}
    gone: dict = {k: set() for k, _ in docs}
    for k in sorted(lines):
        for a in range(len(lines[k])):
            for b in range(a + 1, len(lines[k]) + 1):
                run = tuple(x for _, x in lines[k][a:b])
                if sum(len(words(x)) for x in run) < least:
                    continue
                if run in seen and seen[run] < (k, a):
                    gone[k] |= {i for i, _ in lines[k][a:b]}
                    # every line between the first and the last of the run goes with it
                    gone[k] |= set(range(lines[k][a][0], lines[k][b - 1][0] + 1))
                seen.setdefault(run, (k, a))
    return {k: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k]) for k, t in docs}


def test_line_dedup_equals_all_runs(make_docs):
    rng = random.Random(6)
    pool = [prose(rng, rng.choice((1, 2, 4, 9, 14)), 30) for _ in range(12)]
    docs = []
    for k in range(40):
        lines = []
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(len(pool))
            lines += rng.choice((pool[at : at + rng.randint(1, 5)], [prose(rng, rng.randint(1, 9), 500)], [""]))
        docs.append((k, "\n".join(lines)))
    docs += [(100 + i, t) for i, t in enumerate(ODD_TEXTS)]
    for least in (6, 20):
        found = line_dedup.dedup(make_docs(*docs), min_words=least)
        assert {r["doc_id"]: r["text"] for r in found.collect()} == plain_dedup(docs, least)


def test_equal_rows_stay_alike_and_columns_are_kept(make_docs):
    passage = prose(random.Random(7), 60)
    docs = make_docs((2, f"{passage}\nown"), (2, f"{passage}\nown"), (1, passage), (None, None))
    found = line_dedup.dedup(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_removed"]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in found.collect() if r["text"]) == [(1, passage), (2, "own"), (2, "own")]
    assert line_dedup.dedup(make_docs()).count() == 0


def plain_scan(text: str | None, items: list[tuple]) -> tuple:
    def cut(t):
        return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or "")) if w]

    w, hit, ids = cut(text), set(), set()
    for item, body in items:
        b = cut(body)
        size = min(10, len(b))
        grams = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)} if b else set()
        for i in range(len(w) - size + 1):
            if size and tuple(w[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def test_decontamination_equals_all_windows(spark, make_docs):
    rng = random.Random(8)
    items = [(1, prose(rng, 30, 20)), (2, prose(rng, 12, 20)), (10, "Ärger, im B-Haus!"), (3, None), (4, "..."), (5, prose(rng, 10, 20)), (5, "Zwei Worte"), (11, None)]
    items.append((6, items[0][1]))
    texts = [*ODD_TEXTS]
    for _ in range(40):
        parts = [prose(rng, rng.randint(0, 15), 20)]
        for _ in range(rng.randint(0, 3)):
            source = rng.choice(items)[1] or ""
            parts += [source, rng.choice(("", "ärger im b haus", "zwei, worte", prose(rng, 4, 20)))]
        texts.append(" - ".join(parts))
    texts += ["ÄRGER im b haus", "ärger im b haus", texts[20]]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for size in (decontamination.BROADCAST_WINDOWS, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(decontamination, "BROADCAST_WINDOWS", size)
            found = decontamination.scan(make_docs(*texts), benchmark).collect()
        assert len(found) == len(texts)
        for r in found:
            assert (r["n_words"], r["n_hit"], r["items"]) == plain_scan(texts[r["doc_id"]], items)
            assert sum(s["len"] for s in r["spans"]) == r["n_hit"]


def test_decontamination_removes_documents_or_spans(spark, make_docs):
    rng = random.Random(9)
    item = prose(rng, 14)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = make_docs("clean words only", f"before {item} after", None, f"before {item} after", "", item)
    assert sorted(r["doc_id"] for r in decontamination.remove_documents(docs, benchmark).collect()) == [0, 2, 4]
    cut = decontamination.remove_spans(docs, benchmark)
    assert cut.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {
        0: "clean words only", 1: "before after", 2: None, 3: "before after", 4: "", 5: "",
    }
    nothing = benchmark.limit(0)
    assert decontamination.remove_documents(docs, nothing).count() == 6
    assert decontamination.scan(make_docs(), benchmark).count() == 0


def plain_measures(text: str | None) -> dict:
    w, body = words(text), text or ""
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    lines = [x for x in body.split("\n") if words(x)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in body),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len({i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}),
        "n_stop_words": sum(x in quality.STOP_WORDS for x in w), "n_upper": sum("A" <= c <= "Z" for x in w for c in x),
    }


def test_measures_equal_plain_ones(make_docs, small_docs):
    rng = random.Random(10)
    texts = [*ODD_TEXTS, "a a a a", "a b c a b c", *[prose(rng, n, 6) for n in (3, 10, 80)], "The END of it\nThe END of it"]
    for docs in (make_docs(*texts), small_docs):
        by_id = {r["doc_id"]: r["text"] for r in docs.collect()}
        for r in quality.score(docs).collect():
            want = plain_measures(by_id[r["doc_id"]])
            assert {m: r[m] for m in quality.MEASURES} == want
            failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
            assert r["base_failed"] == failed
            assert not (failed and r["kept"])


def test_rules_fail_on_what_is_missing(make_docs):
    docs = make_docs(prose(random.Random(11), 60), None)
    rule = quality.Rule("no words at all", "n_symbols / nullif(n_stop_words, 0)", None, 1.0)
    assert quality.score(docs, rules=(rule,)).filter("kept").count() == 0
    assert [r["doc_id"] for r in quality.score(docs, rules=()).filter("kept").collect()] == [0]
    assert quality.keep(docs, rules=()).columns == docs.columns
    clashing = docs.withColumnRenamed("lang", "kept").withColumnRenamed("source", "N_words")
    assert [f.dataType.simpleString() for f in quality.score(clashing).schema if f.name.lower() in ("kept", "n_words")] == ["bigint", "boolean"]
    assert quality.keep(clashing, rules=()).columns == clashing.columns
    assert quality.score(make_docs()).count() == 0


def curve_points(bits: int, n: int) -> list[tuple]:
    side = range(1 << bits)
    if n == 2:
        return [(x, y) for x in side for y in side]
    return [(x, y, z) for x in side for y in side for z in side]


@pytest.mark.parametrize(("n", "bits"), [(2, 4), (3, 3)])
def test_the_curve_visits_every_cell_by_single_steps(spark, n, bits):
    points = curve_points(bits, n)
    names = "xyz"[:n]
    table = spark.createDataFrame(points, ", ".join(f"{c} int" for c in names))
    rows = table.select(*names, hilbert.curve_index([F.col(c) for c in names], bits).alias("h")).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(len(points)))
    path = [tuple(r[c] for c in names) for r in rows]
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def test_shards_are_even_and_slots_gapless(make_docs, small_docs, monkeypatch):
    monkeypatch.setattr(hilbert, "BUCKET_ROWS", 7)
    for docs in (make_docs(*ODD_TEXTS, *ODD_TEXTS[:3], (None, "x"), (None, None), (3, "a b")), small_docs):
        rows = hilbert.assign(docs, ["source", "lang", "n_chars"]).collect()
        assert len(rows) == docs.count()
        slots: dict = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        sizes = [len(slots.get(s, [])) for s in range(40)]
        assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(40))
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        ranked = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
        assert [r["curve"] for r in ranked] == sorted(r["curve"] for r in rows)
    assert hilbert.assign(make_docs(), ["source"]).collect() == []


def test_shards_prune(small_docs):
    rows = hilbert.assign(small_docs, ["source", "lang", "n_chars"], shards=20)
    spans = rows.groupBy("shard").agg(F.countDistinct("source").alias("s"), F.countDistinct("lang").alias("l"))
    average = spans.agg(F.avg("s"), F.avg("l")).first()
    assert average[0] < 0.6 * small_docs.select("source").distinct().count()


def test_digest_of_no_item(spark):
    rows = QUERIES["op3_decontamination"](spark, "/root/testdata/sf0.001").filter("n_items = 0").limit(1).collect()
    assert all(r["items_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)


def test_grid_cells_are_points_one_step_away(spark):
    def counts(value, ones):
        return tuple(bin(value >> i & 3).count("1") if ones else value >> i & 3 for i in range(0, 64, 2))

    values = [0, -1, 1 << 62, -(1 << 63), 0x1B1B1B1B1B1B1B1B, -0x123456789ABCDEF]
    points = spark.createDataFrame([(v,) for v in values], "fp long").select("fp", simhash.segment_counts(F.col("fp")).alias("point"))
    for row in points.select("fp", simhash._cells("point").alias("cells")).collect():
        here = counts(row.fp % 2**64, True)
        steps = {here[:i] + (c + d,) + here[i + 1 :] for i, c in enumerate(here) for d in (-1, 1) if 0 <= c + d <= 2}
        assert sorted(counts(c % 2**64, False) for c in row.cells) == sorted({here, *steps})
