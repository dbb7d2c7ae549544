from __future__ import annotations

import random
import re

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Texts that every operator must take: null, empty, blank, short, repeated, odd characters.
ODD_TEXTS = [
    None, "", " \n\t ", "a", "a b", "a b c", "Ärger ÄRGER straße", "x" * 5000, "one " * 400, "\n".join(["same line here"] * 30),
    "### $$$ %%%", "日本語 テキスト 🙂", "tab\tand\x0bvertical\x0cfeed\rreturn", "<|endoftext|> plain", "́combining first",
]


def words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs or from texts numbered from 0."""

    def build(*texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en" if i is None or i % 2 else None, None, None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOC_SCHEMA)

    return build


@pytest.fixture(scope="session")
def small_docs(spark):
    """The smallest table of documents."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
