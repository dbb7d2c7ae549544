"""Quality rules: a table of thresholds compiled into one projection.

``RULES`` lists measures with the range that a good document keeps to. The
measures are built-in expressions over a text's words and lines, the rules one
conjunction over them; nothing is shuffled and no user function runs.

A document is kept if it passes the base rules (at least 50 words, at most half of
them in three-word windows that come again) and every rule of the table.

Defined results: null and empty texts have no words, fail and are not kept; texts of
fewer than three words have no repeated window; three words are compared by a 64-bit
hash within a text; repeated rows get one result each; an empty table gives no rows;
columns named like those that are added give way to them, ``keep`` keeps all.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearscope.llm.texts import SPACE, free_name, let, need, split_words, without

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"

#: Function words of the four languages of the corpus; fixed values.
STOP_WORDS = (
    "the of and to in a is that it for on was as with be by are this at from "
    "der die das und ist von den mit zu des im ein eine nicht auf für sich "
    "le la les de et des un une est pour que dans par sur avec "
    "el los las del que y en se por con para su al lo"
).split()


class Rule(NamedTuple):
    """A measure and the closed range of good documents; None leaves a side open."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: The threshold table. Ratios are null without a word, and a null fails.
RULES = (
    Rule("mean word length", "try_divide(word_chars, n_words)", 2.0, 15.0),
    Rule("symbols per word", "try_divide(n_symbols, n_words)", None, 0.3),
    Rule("stop words", "try_divide(n_stop_words, n_words)", 0.03, None),
    Rule("upper-case share", "try_divide(n_upper, word_chars)", None, 0.5),
    Rule("repeated lines", "try_divide(n_dup_lines, n_lines)", None, 0.5),
    Rule("words in repeated windows", "try_divide(n_repeat_words, n_words)", None, 0.5),
)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window which stands twice or more in the text."""
    grams = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(placed: Column) -> Column:
        # sorted by window, equal windows are neighbours
        twins = F.transform(
            placed,
            lambda e, i: F.when(
                (F.get(placed, i - 1)["g"] == e["g"]) | (F.get(placed, i + 1)["g"] == e["g"]), e["i"]
            ),
        )
        starts = F.array_sort(F.filter(twins, lambda p: p.isNotNull()))
        none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            starts,
            none,
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).cast("long").alias("n"), p.alias("last")),
            lambda acc: acc["n"],
        )

    def count(g: Column) -> Column:
        placed = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(let(placed, covered))

    return let(grams, count)


def measures(text: Column) -> Column:
    """All measures of a text as one struct; its words and lines are cut once."""
    body = F.coalesce(text, F.lit(""))

    def removed(value: Column, pattern: str) -> Column:
        return F.char_length(value) - F.char_length(F.regexp_replace(value, pattern, ""))

    def counted(x: Column) -> Column:
        words, lines, joined = x["words"], x["lines"], F.array_join(x["words"], "")
        values = {
            "n_words": F.size(words),
            "word_chars": F.char_length(joined),
            "n_symbols": removed(body, SYMBOLS),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": let(words, _repeated_words),
            "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))),  # a hash set in the plan
            "n_upper": removed(joined, "[A-Z]"),
        }
        return F.named_struct(*[part for k, v in values.items() for part in (F.lit(k), v.cast("long"))])

    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(F.named_struct(F.lit("words"), split_words(body, SPACE), F.lit("lines"), lines), counted)


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules as one condition; a measure that is null fails."""
    tests = []
    for rule in rules:
        if rule.least is not None:
            tests.append(f"coalesce({rule.measure} >= {rule.least!r}D, false)")
        if rule.most is not None:
            tests.append(f"coalesce({rule.measure} <= {rule.most!r}D, false)")
    return F.expr(" AND ".join(tests) or "true")


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_upper")


def score(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns, with the measures, ``base_failed`` and ``kept``."""
    need(docs, text)
    others = without(docs.columns, *MEASURES, "base_failed", "kept")
    found = free_name(docs.columns, "_measures")
    rows = docs.select(*[F.col(f"`{c}`") for c in others], measures(F.col(f"`{text}`")).alias(found))
    rows = rows.withColumns({m: F.col(found)[m] for m in MEASURES}).drop(found)
    return rows.withColumn("base_failed", _base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def _base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with their own columns only."""
    need(docs, text)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    measured = docs.select(row, measures(F.col(f"`{text}`")).alias("_measures")).select("_row", "_measures.*")
    return measured.filter(~_base_failed() & verdict(rules)).select("_row.*")
