"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from arrearscope.llm import merkle
from tests.llm.conftest import ODD_TEXTS


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(*values) -> str:
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves: list[str], arity: int) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(below[i : i + arity])) for i in range(0, len(below), arity)])
    return levels


def plain_path(levels: list[list[str]], i: int, arity: int) -> list[tuple[str, str]]:
    path = []
    for level in levels[:-1]:
        run = i - i % arity
        path.append(("".join(level[run:i]), "".join(level[i + 1 : run + arity])))
        i //= arity
    return path


def plain_manifest(rows, arity: int) -> list[tuple]:
    groups: dict = {}
    for r in rows:
        leaf = plain_leaf(r.doc_id, r.source, r.lang, r.n_chars, r.text)
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([leaf for _, _, leaf in sorted(groups[g])], arity) for g in names}
    top = plain_tree([trees[g][-1][0] for g in names], arity)
    return sorted(
        (not has, key, leaf, trees[g][-1][0], top[-1][0], tuple(plain_path(trees[g], i, arity) + plain_path(top, at, arity)))
        for at, g in enumerate(names)
        for i, (has, key, leaf) in enumerate(sorted(groups[g]))
    )


def found(rows) -> list[tuple]:
    return sorted(
        (r.doc_id is None, r.doc_id or 0, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.path)) for r in rows
    )


@pytest.mark.parametrize(("arity", "levels"), [(2, 8), (2, 2), (3, 1), (5, 2)])
def test_paths_equal_a_plain_tree(small_docs, arity, levels):
    rows = merkle.manifest(small_docs, arity=arity, levels=levels).collect()
    assert found(rows) == plain_manifest(small_docs.collect(), arity)


def test_odd_rows(spark, make_docs):
    docs = make_docs(*ODD_TEXTS, (None, "no id"), (None, None), (3, "again"), (3, "again"), (3, "other"), (99, "y" * 3_000_000))
    more = spark.createDataFrame([(7, "t", "", "s", 1), (8, "t", "é", "s", 1), (9, None, "z", None, None)], docs.schema)
    docs = docs.unionByName(more)
    rows = merkle.manifest(docs, levels=1).collect()
    assert len(rows) == docs.count()
    assert found(rows) == plain_manifest(docs.collect(), 2)


def test_one_group_may_hold_most_rows(spark):
    rows = [(i // 3, "same" if i % 2 else None, "en", "s", 4) for i in range(700)] + [(1, "t", "de", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert found(merkle.manifest(docs, levels=3).collect()) == plain_manifest(docs.collect(), 2)


def test_every_change_is_found(small_docs):
    changed = merkle.leaf([F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [F.concat("text", F.lit("."))])
    rows = merkle.manifest(small_docs, carried={"changed": changed})
    folds = rows.select(
        (merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("same"),
        (merkle.fold(F.col("changed"), F.col("path")) == F.col("root")).alias("other"),
    ).distinct().collect()
    assert [(r.same, r.other) for r in folds] == [(True, False)]


def test_nulls_are_no_texts(spark, make_docs):
    rows = {r.doc_id: r.leaf for r in merkle.manifest(make_docs((1, None), (3, "-"), (5, ""))).collect()}
    assert rows == {1: plain_leaf(1, None, "en", None, None), 3: plain_leaf(3, None, "en", 1, "-"), 5: plain_leaf(5, None, "en", 0, "")}
    assert len(set(rows.values())) == 3


def test_empty_single_and_clashing(make_docs):
    docs = make_docs((1, "one"))
    assert merkle.manifest(docs.limit(0)).collect() == []
    [row] = merkle.manifest(docs).collect()
    assert row.leaf == row.subroot == row.root and row.path == []
    names = ("g", "h", "i", "n", "key", "body", "part", "path", "leaf", "root", "subroot", "members", "levels", "r")
    clashing = docs.select("*", *[F.lit("x").alias(c) for c in names])
    assert merkle.manifest(clashing).collect() == [row]
    with pytest.raises(ValueError, match="n_chars"):
        merkle.manifest(docs.drop("n_chars"))
