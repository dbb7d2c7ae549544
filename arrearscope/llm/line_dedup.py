"""Repeated passages of lines, found by winnowing over line hashes.

A passage is a run of whole lines with at least ``min_words`` words together.
Around every line two smallest passages are looked at: from the line onwards and
up to the line. The smallest line hash in such a window is its fingerprint, so
equal passages are sure to share one. Fingerprints that stand at two places or
more are joined back to their windows; windows that are equal as a whole are
compared with the first place where they stand, and those further on are repeats.
Neighbouring repeats run together to the full repeated passage, both ways, and its
lines are deleted. So a line goes if and only if it lies in a run of lines of at
least ``min_words`` words which also stands earlier: in a document with a smaller
key, or further up. A passage that a third of all documents share is one group that
is reduced before the shuffle, and each copy is compared with the first one only.

Defined results: lines are parted by line feeds and compared as they are; lines
without a word are never part of a passage and stay; rows equal in key and text are
one document and stay alike; documents of one key are ordered by text hash; null
keys come first; null and empty texts stay; a document may end with an empty text;
other columns stay, those named like the added ones give way to them; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.llm.texts import free_name, let, need, split_words, without
from arrearscope.session import written

MIN_WORDS = 50


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_hash, pos, h, h2, words) per distinct line with a word; two hashes make 128 bits."""
    body = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(body).alias("text_hash"),
        F.posexplode(F.split(F.coalesce(body, F.lit("")), "\n")).alias("pos", "line"),
    )
    measured = rows.select(
        "key", "text_hash", "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2"),
        F.size(split_words(F.col("line"))).alias("words"),
    ).filter("words > 0")
    together = measured.repartition("key", "text_hash")
    return together.dropDuplicates(["key", "text_hash", "pos", "h", "h2", "words"])


def windows(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, text_hash, first, last, fingerprint, print_pos, w1, w2) of the smallest passages around lines."""
    doc = Window.partitionBy("key", "text_hash")
    summed = lines.withColumn("until", F.sum("words").over(doc.orderBy("pos")))
    summed = summed.withColumn("before", F.col("until") - F.col("words"))
    # a line belongs to the window while fewer than min_words lie before it
    onwards = doc.orderBy("before").rangeBetween(0, min_words - 1)
    upwards = doc.orderBy("until").rangeBetween(-(min_words - 1), 0)

    def frame(side: Window, name: str) -> list[Column]:
        inner = F.struct("h", "pos", "h2")
        return [F.collect_list(inner).over(side).alias(name), F.sum("words").over(side).alias(f"{name}_words")]

    framed = summed.select("key", "text_hash", *frame(onwards, "a"), *frame(upwards, "b"))
    both = F.array(F.struct(F.col("a").alias("w"), F.col("a_words").alias("n")), F.struct(F.col("b").alias("w"), F.col("b_words").alias("n")))
    rows = framed.select("key", "text_hash", F.inline(both)).filter(F.col("n") >= min_words)
    return rows.select(
        "key", "text_hash",
        F.get("w", F.lit(0))["pos"].alias("first"), F.element_at("w", -1)["pos"].alias("last"),
        F.array_min("w")["h"].alias("fingerprint"), F.array_min("w")["pos"].alias("print_pos"),
        F.xxhash64(F.col("w")["h"]).alias("w1"), F.xxhash64(F.col("w")["h2"], F.size("w")).alias("w2"),
    )


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(key, text_hash, runs): per document the line ranges that stand earlier, as sorted (first, last)."""
    need(docs, key, text)
    found = written(windows(lines_of(docs, key, text), min_words), "line-windows")
    # fingerprints that stand at more than one line
    at = F.struct("key", "text_hash", "print_pos")
    prints = found.groupBy("fingerprint").agg(F.min(at).alias("a"), F.max(at).alias("b"))
    prints = written(prints.filter("a <> b").select("fingerprint"), "line-fingerprints")
    candidates = found.join(prints, "fingerprint", "left_semi")
    place = F.struct("key", "text_hash", "first")
    groups = candidates.groupBy("w1", "w2").agg(F.min(place).alias("origin"), F.max(place).alias("furthest"))
    groups = written(groups.filter("origin < furthest").drop("furthest"), "line-groups")
    later = found.join(groups, ["w1", "w2"]).filter(place > F.col("origin"))
    lines = later.select("key", "text_hash", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
    doc = Window.partitionBy("key", "text_hash").orderBy("pos")
    islands = lines.withColumn("island", F.col("pos") - F.row_number().over(doc))
    runs = islands.groupBy("key", "text_hash", "island").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    return runs.groupBy("key", "text_hash").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def _without(lines: Column, runs: Column) -> Column:
    """Lines outside sorted runs: the gaps between them, one slice each."""
    starts = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["last"] + 1))
    ends = F.concat(F.transform(runs, lambda r: r["first"]), F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a)))


def dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    added: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    """All columns, the text without repeated passages, and two counts named ``added``."""
    found = written(repeats(docs, key, text, min_words), "line-repeats")
    runs = free_name(docs.columns, "_runs")
    found = found.select(F.col("key").alias("_key"), F.col("text_hash").alias("_hash"), F.col("runs").alias(runs))
    body = docs[f"`{text}`"]
    same = docs[key].eqNullSafe(found["_key"]) & (F.xxhash64(docs[text]) == found["_hash"])
    lines = F.split(body, "\n")
    cut = let(lines, lambda x: F.array_join(_without(x, F.col(runs)), "\n"))
    removed = F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    # one plan at every size: few repeats on small tables are no reason to count on few
    return docs.join(found.hint("merge"), same, "left").select(
        *[F.when(F.col(runs).isNull(), body).otherwise(cut).alias(c) if c == text else docs[f"`{c}`"] for c in without(docs.columns, *added)],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(added[0]),
        F.coalesce(removed, F.lit(0)).alias(added[1]),
    )
