"""Merkle manifest of a table: leaves per row, a tree per group, one root over the groups.

Rows are reduced to a digest each before anything is shuffled. A group's leaves are
numbered in key order by ranges: rows are cut into ranges of (group, key, leaf),
counted, and numbered inside their range only, so a group with most rows is many
ranges. Runs of ``ARITY ** BLOCK_LEVELS`` leaves are aligned blocks. A block keeps every
level of its tree as one string of hex digests: parents are digests of fixed-width
substrings, and the siblings of a node are the substrings that flank it in its run.
Blocks' roots are the nodes of the next tree, up to one root per group, and those are
the nodes of the tree over the groups. Siblings go down the same way: a block gets the
path of its root once and hands it on to its rows.

Defined results: a null value counts as ``-`` and is told from every text; rows with a
null key come first, a null group is a group and comes first; repeated keys stand in the
order of their leaves, repeated rows are a leaf each; a table of one row has its leaf as
root; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.llm.texts import need
from arrearscope.session import written

#: Children of a node.
ARITY = 2
#: Levels of a block; 256 leaves at two children.
BLOCK_LEVELS = 8
#: Hex digits of a digest.
WIDTH = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(values: list[Column]) -> Column:
    """Digest of the values in order, each with its length in bytes in front."""
    parts = []
    for value in values:
        shown = value.cast("string")
        framed = F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown)
        parts.append(F.coalesce(framed, F.lit("-")))
    return digest(F.concat(*parts))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, s: digest(F.concat(s["before"], node, s["after"])))


def siblings(path: Column) -> Column:
    """All digests of a path as one string, from the leaf's run up."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def numbered(nodes: DataFrame) -> DataFrame:
    """``nodes`` (g, key, h, r, body) with ``i``, the place in its group, and ``n``, the group's size."""
    order = [F.col("key").asc_nulls_first(), F.col("h"), F.col("r")]
    cut = nodes.repartitionByRange(F.col("g"), *order).withColumn("part", F.spark_partition_id())
    cut = written(cut, "manifest-ranges")
    counts = cut.groupBy("part", "g").agg(F.count("*").alias("rows"))
    group = Window.partitionBy("g")
    before = F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part", "g", F.coalesce(before, F.lit(0)).alias("start"), F.sum("rows").over(group).alias("n"))
    place = F.row_number().over(Window.partitionBy("part", "g").orderBy(*order)) - 1
    return cut.join(starts, ["part", "g"]).select("g", (F.col("start") + place).alias("i"), "n", "h", "body")


def _parents(level: str, arity: int) -> str:
    run = arity * WIDTH
    nodes = f"sequence(0, cast((octet_length({level}) - 1) DIV {run} AS int))"
    return f"array_join(transform({nodes}, k -> sha2(substring({level}, k * {run} + 1, {run}), 256)), '')"


def _blocks(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """(g, b, n, members, levels): blocks with all levels of their trees."""
    size = arity**levels
    # a group of one block ends at its root, all others have whole blocks' levels
    steps = " ".join(f"WHEN n <= {arity**s}L THEN {s}" for s in range(levels))
    grown = f"concat(done, array({_parents('element_at(done, -1)', arity)}))"
    rows = nodes.groupBy("g", F.expr(f"i DIV {size}L").alias("b"), "n").agg(
        F.sort_array(F.collect_list(F.struct("i", "h", "body"))).alias("members")
    )
    first = "array(array_join(transform(members, m -> m.h), ''))"
    up = f"slice(sequence(1, {levels}), 1, CASE {steps} ELSE {levels} END)"
    return rows.withColumn("levels", F.expr(f"aggregate({up}, {first}, (done, step) -> {grown})"))


def _flanks(arity: int, levels: int) -> str:
    """Siblings of the member at place p of a block, on each level below its root."""
    powers = f"array({', '.join(str(arity**s) for s in range(levels))})"
    at = f"cast(p DIV {powers}[s] AS int)"
    run = f"({at} - {at} % {arity})"
    before = f"substring(level, {run} * {WIDTH} + 1, ({at} - {run}) * {WIDTH})"
    after = f"substring(level, ({at} + 1) * {WIDTH} + 1, ({run} + {arity} - 1 - {at}) * {WIDTH})"
    return f"transform(slice(levels, 1, size(levels) - 1), (level, s) -> struct({before} AS before, {after} AS after))"


def climb(nodes: DataFrame, arity: int = ARITY, levels: int = BLOCK_LEVELS, over_groups: bool = True) -> DataFrame:
    """(h, body, subroot, root, path) of every node (g, i, n, h, body).

    ``path`` lists the siblings per level, from the node's own run to the last root.
    The rounds grow with the logarithm of the nodes; each writes its blocks.
    """
    size = arity**levels
    blocks = written(_blocks(nodes, arity, levels), "manifest-blocks")
    tops = blocks.select("g", "b", "n", F.expr("element_at(levels, -1)").alias("top"))
    owner = F.struct("g", "b").alias("body")
    whole = tops.filter(F.col("n") > size).isEmpty()
    if not whole:
        count = F.expr(f"(n + {size - 1}L) DIV {size}L")
        above = tops.select("g", F.col("b").alias("i"), count.alias("n"), F.col("top").alias("h"), owner)
        above = climb(above, arity, levels, over_groups).select("body.*", "subroot", "root", "path")
    elif over_groups:
        groups = tops.select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("top").alias("h"), F.lit(0).alias("r"), owner)
        above = climb(numbered(groups), arity, levels, False).select("body.*", F.col("h").alias("subroot"), "root", "path")
    else:
        nothing = F.expr("cast(array() AS array<struct<before:string,after:string>>)")
        above = tops.select("g", "b", F.col("top").alias("subroot"), F.col("top").alias("root"), nothing.alias("path"))
    rows = blocks.select("g", "b", "members", "levels").join(above, ["g", "b"])
    members = f"transform(members, (m, p) -> struct(m.h AS h, m.body AS body, {_flanks(arity, levels)} AS own))"
    listed = rows.selectExpr("subroot", "root", "path AS rest", f"inline({members})")
    return listed.select("h", "body", "subroot", "root", F.concat("own", "rest").alias("path"))


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    key: str = "doc_id",
    group: str = "lang",
    carried: dict[str, Column] | None = None,
    arity: int = ARITY,
    levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """(key, carried..., leaf, subroot, root, path) of every row.

    ``carried`` are further expressions over the rows, such as the leaf of another version.
    """
    need(docs, *fields, key, group)
    column = {c: F.col(f"`{c}`") for c in (*fields, key, group)}
    carried = carried or {}
    name = F.coalesce(F.concat(F.lit("="), column[group].cast("string")), F.lit("-"))
    body = F.struct(column[key].alias("key"), *[value.alias(f"c{i}") for i, value in enumerate(carried.values())])
    leaves = docs.select(
        name.alias("g"), column[key].alias("key"), leaf([column[c] for c in fields]).alias("h"),
        # equal rows have to differ, or their order would not be one
        F.monotonically_increasing_id().alias("r"), body.alias("body"),
    )
    found = climb(numbered(written(leaves, "manifest-leaves")), arity, levels)
    kept = [F.col(f"body.c{i}").alias(c) for i, c in enumerate(carried)]
    return found.select(F.col("body.key").alias(key), *kept, F.col("h").alias("leaf"), "subroot", "root", "path")
