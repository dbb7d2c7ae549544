"""Shards along the curve against a plain quantiser and curve."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from arrearscope.llm import hilbert
from tests.llm.conftest import ODD_TEXTS

DIMENSIONS = ["source", "lang", "n_chars"]


def plain_levels(values: list, bits: int) -> list[int]:
    steps = 1 << bits
    ordered = sorted(values, key=lambda v: (v is not None, v if v is not None else 0))
    edges = [ordered[math.ceil(j * len(values) / steps) - 1] for j in range(1, steps)]
    return [0 if v is None else sum(e is not None and e < v for e in edges) for v in values]


def plain_index(levels: tuple[int, ...], bits: int) -> int:
    n, state, h = len(levels), 0, 0
    table = hilbert.curve_steps(n)
    for bit in reversed(range(bits)):
        corner = sum(((level >> bit) & 1) << j for j, level in enumerate(levels))
        rank, state = table[(state << n) + corner]
        h = (h << n) + rank
    return h


def plain_curve(rows, dimensions: list[str], bits: int) -> list[int]:
    columns = [plain_levels([r[d] for r in rows], bits) for d in dimensions]
    return [plain_index(levels, bits) for levels in zip(*columns)]


def law_rows(rows, shards: int) -> None:
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)


def along_the_curve(rows) -> None:
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in ordered] == sorted(r["curve"] for r in rows)


def test_curve_of_every_row(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").drop("text").withColumn("text", F.lit(""))
    rows = hilbert.assign(docs, DIMENSIONS).collect()
    assert [r["curve"] for r in rows] == plain_curve(rows, DIMENSIONS, hilbert.BITS)
    assert len({r["curve"] for r in rows}) > 300
    law_rows(rows, hilbert.SHARDS)
    along_the_curve(rows)


def test_odd_rows_and_long_common_prefixes(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "BUCKET_ROWS", 4)
    rng = random.Random(2)
    rows = []
    for i in range(300):
        source = rng.choice([None, "https://a-long-prefix/" + "abcdefgh"[i % 8], "", "Ä", "z" * 70_000, "hot", "hot", "hot"])
        number = rng.choice([None, 0, -5, 2**40, i])
        rows.append((rng.choice([None, 7, i, i]), rng.choice(ODD_TEXTS), rng.choice([None, "en", "de"]), source, number))
    rows += rows[:40]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    found = hilbert.assign(docs, DIMENSIONS, shards=7, bits=3).collect()
    assert Counter(r[:5] for r in found) == Counter(rows)
    assert [r["curve"] for r in found] == plain_curve(found, DIMENSIONS, 3)
    law_rows(found, 7)
    along_the_curve(found)
    prefixed = {r["source"] for r in found if (r["source"] or "").startswith("https")}
    assert len({hilbert_level for s, hilbert_level in zip([r["source"] for r in found], plain_levels([r["source"] for r in found], 3)) if s in prefixed}) > 1


def test_other_kinds_of_dimensions(spark):
    docs = spark.range(64).selectExpr(
        "id AS doc_id", "'' AS text", "date_add(date'2024-01-01', cast(id % 9 AS int)) AS day", "id % 3 = 0 AS flag",
        "cast(id % 5 AS double) / 0.5 AS x", "cast(cast(id % 4 AS string) AS binary) AS b",
    )
    dimensions = ["day", "flag", "x", "b"]
    rows = hilbert.assign(docs, dimensions, shards=5, bits=2).collect()
    assert [r["curve"] for r in rows] == plain_curve(rows, dimensions, 2)
    law_rows(rows, 5)


def test_filters_skip_most_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang", "source", "n_chars", F.lit("").alias("text"))
    rows = hilbert.assign(docs, DIMENSIONS).collect()
    shuffled = [r["shard"] for r in rows]
    random.Random(1).shuffle(shuffled)

    def mean_of(dimension: str, shards: list[int]) -> float:
        inside = defaultdict(set)
        for r, shard in zip(rows, shards):
            inside[shard].add(r[dimension])
        return sum(map(len, inside.values())) / len(inside)

    own = [r["shard"] for r in rows]
    sources = len({r["source"] for r in rows})
    assert mean_of("source", shuffled) == sources and mean_of("source", own) <= sources / 2
    assert mean_of("lang", shuffled) == 4 and mean_of("lang", own) < 3
    lengths = defaultdict(list)
    for r in rows:
        lengths[r["shard"]].append(r["n_chars"])
    widths = sorted(max(v) - min(v) for v in lengths.values())
    assert widths[len(widths) // 2] < max(r["n_chars"] for r in rows) / 2


def test_empty_and_clashing(make_docs):
    docs = make_docs(*ODD_TEXTS)
    assert hilbert.assign(docs.limit(0), DIMENSIONS).columns[-3:] == ["curve", "shard", "slot"]
    names = ("curve", "shard", "slot", "row", "h", "bucket", "buckets", "n", "value", "part")
    rows = hilbert.assign(docs.select("*", *[F.lit("x").alias(c) for c in names]), DIMENSIONS, shards=4).collect()
    law_rows(rows, 4)
    assert {r["bucket"] for r in rows} == {"x"}
