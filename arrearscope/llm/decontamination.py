"""Benchmark decontamination by a broadcast hash set of test n-grams.

Windows of ten normalised words of every benchmark item (shorter items: the whole
item) are a set keyed by a 64-bit hash. Documents' windows are looked up in it and
hits are compared as text, so a hash collision is no hit. Every document sends one
row of its own beside its hits through the only shuffle; windows without a hit
never leave their task. The set is broadcast after its size is checked; a larger
one is joined by a shuffle with the same result.

Defined results: null and empty texts have no words; items without a word have no
window; items without an id lend their windows but are not listed; rows equal in
key and text are reported as often as they stand; an empty benchmark hits nothing;
other columns of the tables are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearscope.llm.texts import ascii_lower, free_name, let, need, split_words

#: Anything but digits, letters a-z and characters beyond ASCII parts words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Windows and bytes up to which the test set is broadcast.
BROADCAST_WINDOWS, BROADCAST_BYTES = 2_000_000, 256 << 20


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(text), SEPARATORS)


def _windows(words: Column, length: int) -> Column:
    """(pos, len, h) of all windows of a length; shorter arrays have none."""
    starts = F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        starts,
        lambda i: F.struct(
            i.alias("pos"), F.lit(length).alias("len"), F.xxhash64(F.slice(words, i + 1, F.lit(length))).alias("h")
        ),
    )


def _gram(words: Column, pos: Column, length: Column) -> Column:
    # the greatest() keeps the position legal in a document's own row
    return F.array_join(F.slice(words, F.greatest(pos, F.lit(0)) + 1, length), " ")


def test_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(h, len, gram, items) per distinct window of the benchmark."""
    need(benchmark, item, text)
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), words_of(F.col(f"`{text}`")).alias("words"))
    items = items.filter(F.size("words") > 0).withColumn("len", F.least(F.size("words"), F.lit(window)))
    placed = items.select("item", "words", "len", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("len"))).alias("pos"))
    grams = placed.select(
        "item", "len", F.xxhash64(F.slice("words", F.col("pos") + 1, F.col("len"))).alias("h"),
        _gram(F.col("words"), F.col("pos"), F.col("len")).alias("gram"),
    )
    return grams.groupBy("h", "len", "gram").agg(F.collect_set("item").alias("items"))


test_windows.__test__ = False  # not a test


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    window: int = WINDOW,
) -> DataFrame:
    """(key, text_hash, n_words, n_hit, items, spans) per document row.

    ``items`` are the ids of items with a window in the document, as sorted strings;
    ``spans`` the hit stretches of words as (pos, len), in order and not touching.
    """
    need(docs, key, text)
    grams = test_windows(benchmark, item, "text", window)
    size = grams.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.octet_length("gram") + F.size("items") * 24), F.lit(0)).alias("b"),
        F.sort_array(F.collect_set("len")).alias("lengths"),  # at most ``window`` values
    ).first()
    test = grams.select(F.col("h").alias("test_h"), F.col("len").alias("test_len"), "gram", "items")
    if size["n"] <= BROADCAST_WINDOWS and size["b"] <= BROADCAST_BYTES:
        test = F.broadcast(test)
    body = F.col(f"`{text}`")
    cut = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(body).alias("text_hash"), words_of(body).alias("words"))
    # a row of the document's own, position -1, then its windows
    own = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(0).alias("len"), F.lit(0).cast("long").alias("h")))
    found = [_windows(F.col("words"), n) for n in size["lengths"]]
    rows = cut.select("key", "text_hash", "words", F.size("words").alias("n_words"), F.inline(F.concat(own, *found)))
    hit = rows.join(
        test,
        (F.col("h") == F.col("test_h")) & (F.col("len") == F.col("test_len"))
        & (F.col("gram") == _gram(F.col("words"), F.col("pos"), F.col("len"))) & (F.col("pos") >= 0),
        "left",
    ).filter((F.col("pos") < 0) | F.col("gram").isNotNull())
    placed = F.when(F.col("pos") >= 0, F.struct("pos", "len"))
    per_doc = hit.groupBy("key", "text_hash", "n_words").agg(
        F.count_if(F.col("pos") < 0).cast("int").alias("copies"),
        F.collect_set(placed).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return per_doc.select(
        "key", "text_hash", F.col("n_words").cast("long").alias("n_words"), "items", _spans(F.col("hits")).alias("spans"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"),
    ).select(
        F.col("key").alias(key), "text_hash", "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["len"]).alias("n_hit"), "items", "spans",
    )


def _spans(hits: Column) -> Column:
    """Merged stretches of (pos, len) hits: runs of neighbouring hit words."""
    covered = F.array_sort(
        F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["pos"], h["pos"] + h["len"] - 1))))
    )

    def runs(p: Column) -> Column:
        first = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
        last = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) != x + 1))
        return F.zip_with(first, last, lambda a, b: F.named_struct(F.lit("pos"), a, F.lit("len"), b - a + 1))

    return let(covered, runs)


def remove_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark window stands."""
    found = scan(docs, benchmark, key, text).filter("n_hit > 0").select(
        F.col(key).alias("_hit_key"), F.col("text_hash").alias("_hit_hash")
    ).distinct()
    same = docs[key].eqNullSafe(found["_hit_key"]) & (F.xxhash64(docs[text]) == found["_hit_hash"])
    return docs.join(found, same, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with hit documents cut down to their normalised words outside hits."""
    spans = free_name(docs.columns, "_spans")
    found = scan(docs, benchmark, key, text).filter("n_hit > 0").select(
        F.col(key).alias("_hit_key"), F.col("text_hash").alias("_hit_hash"), F.col("spans").alias(spans)
    ).dropDuplicates(["_hit_key", "_hit_hash"])
    same = docs[key].eqNullSafe(found["_hit_key"]) & (F.xxhash64(docs[text]) == found["_hit_hash"])
    # what is kept lies between the end of one stretch and the start of the next
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["pos"] + s["len"]))

    def outside(words: Column) -> Column:
        ends = F.concat(F.transform(spans, lambda s: s["pos"]), F.array(F.size(words)))
        return F.array_join(F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(words, a + 1, b - a))), " ")

    body = docs[f"`{text}`"]
    cut = F.when(F.col(spans).isNull(), body).otherwise(let(words_of(body), outside)).alias(text)
    return docs.join(found, same, "left").select(*[cut if c == text else docs[f"`{c}`"] for c in docs.columns])
