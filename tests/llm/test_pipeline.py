"""The pipeline's stages in a row, on planted cases and odd rows."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from arrearscope.llm import decontamination, quality
from arrearscope.session import scratch_path
from tests.llm.conftest import DOC_SCHEMA, ODD_TEXTS


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(("the", "of", "and", f"w{rng.randrange(5000)}", f"v{rng.randrange(5000)}")) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(12)
    item = sentence(rng, 20)
    passage = sentence(rng, 60)
    base = sentence(rng, 200)
    texts = {
        0: sentence(rng, 120), 1: base, 2: base, 3: f"{sentence(rng, 80)}\n{passage}\n{sentence(rng, 80)}",
        4: f"{sentence(rng, 90)}\n{passage}", 5: f"{sentence(rng, 70)} {item} {sentence(rng, 70)}", 6: "### " * 100, 7: sentence(rng, 3000),
    }
    texts[8] = f"{texts[7].rsplit(' ', 1)[0]} changed"
    rows = [(k, t, "en", "s", len(t)) for k, t in texts.items()]
    rows += [(100 + i, t, None, None, None) for i, t in enumerate(ODD_TEXTS)] + [(None, sentence(rng, 100), "en", "s", 1)]
    folder = scratch_path(spark, "test-tables")
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, passage


def test_decisions_take_effect(spark, planted):
    folder, texts, passage = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids, seen = docs.columns, [], {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        ids.append(sorted(k for k in seen[name] if k is not None))
    assert ids == [[0, 1, 2, 3, 4, 5, 7, 8], [0, 1, 3, 4, 5, 7], [0, 1, 3, 4, 5, 7], [0, 1, 3, 4, 7]]
    assert all(None in s for s in seen.values())
    kept = seen["line_dedup"]
    assert kept[3] == texts[3] and passage not in kept[4] and kept[0] == texts[0]


def test_run_packs_what_is_kept(spark, planted):
    folder, _, _ = planted
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == {None, 0, 1, 3, 4, 7}
    for key in (0, 1, 3, 4, 7):
        parts = [r for r in rows if r["doc_id"] == key]
        assert sum(r["length"] for r in parts) == parts[0]["doc_tokens"]


def test_an_empty_table_passes_all_stages(spark, planted):
    folder, _, _ = planted
    empty = scratch_path(spark, "test-tables")
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_stages_keep_clashing_columns(spark, make_docs, tmp_path):
    text = " ".join(f"the word{i} of line{i}" for i in range(30))
    docs = make_docs(text, text, "a " + text)
    names = ["_n_lines", "n_removed", "kept", "n_words", "_hash", "_again", "_runs", "_spans", "_measures", "_row", "text_hash", "_key"]
    for n in names:
        docs = docs.withColumn(n, F.lit(7))
    spark.createDataFrame([("x", "nothing of this stands anywhere at all in any document here")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns, name
        assert kept.count() >= 1 and kept.filter(" AND ".join(f"`{n}` = 7" for n in names)).count() == kept.count(), name
    assert decontamination.remove_spans(docs, spark.read.parquet(f"{tmp_path}/benchmark.parquet")).count() == 3


def test_stop_words_are_looked_up_in_a_hash_set(make_docs):
    docs = make_docs("the cat and Der hund la la", "none", None)
    rows = {r["doc_id"]: r["n_stop_words"] for r in quality.score(docs).collect()}
    assert rows == {0: 4, 1: 0, 2: 0}
    plan = docs.select(quality.measures(F.col("text")).alias("m"))._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan and "array_contains" not in plan
