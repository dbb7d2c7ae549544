"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"
_NOT_SPACE = r"[^\x20\x09-\x0D]"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _normal_words(table: str, key: str) -> str:
    return f"""
    SELECT {key}, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SEPARATORS}'), lambda x: x <> '') AS words FROM {table}"""


_DECONTAMINATION = f"""
WITH d AS ({_normal_words("documents", "doc_id")}),
b AS ({_normal_words("benchmark", "item_id")}),
bw AS (SELECT item_id, words, least(len(words), 10) AS l, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
  FROM b WHERE len(words) > 0),
grams AS (SELECT DISTINCT item_id, l, array_to_string(words[i:i + l - 1], ' ') AS gram FROM bw),
lengths AS (SELECT DISTINCT l FROM grams),
dw AS (SELECT doc_id, words, l, unnest(range(1, len(words) - l + 2)) AS i FROM d, lengths WHERE len(words) >= l),
dg AS (SELECT doc_id, l, i, array_to_string(words[i:i + l - 1], ' ') AS gram FROM dw),
hits AS (SELECT DISTINCT doc_id, i, l, item_id FROM dg JOIN grams USING (l, gram)),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM hits GROUP BY doc_id),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN items USING (doc_id) LEFT JOIN covered USING (doc_id)
"""

_QUALITY = f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body,
  list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_NOT_SPACE}')) AS lines FROM documents),
t AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT rid, i, word || ' ' || lead(word, 1) OVER doc || ' ' || lead(word, 2) OVER doc AS gram FROM t
  WINDOW doc AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g WHERE gram IS NOT NULL),
c AS (SELECT rid, count(DISTINCT i + step) AS n FROM r, (VALUES (0), (1), (2)) AS s(step) WHERE n >= 2 GROUP BY rid),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
  (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(words, lambda x: x IN ({{stop}})))::BIGINT AS n_stop_words,
  (length(array_to_string(words, '')) - length(regexp_replace(array_to_string(words, ''), '[A-Z]', '', 'g')))::BIGINT AS n_upper
  FROM w LEFT JOIN c USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({{rules}}, false) AS kept
FROM f
"""

#: The rules and words of the quality operator, written out once more.
_STOP = (
    "the of and to in a is that it for on was as with be by are this at from "
    "der die das und ist von den mit zu des im ein eine nicht auf für sich "
    "le la les de et des un une est pour que dans par sur avec "
    "el los las del que y en se por con para su al lo"
).split()
_RULES = (
    "word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.3 AND n_stop_words / n_words >= 0.03 "
    "AND n_upper / word_chars <= 0.5 AND n_dup_lines / n_lines <= 0.5 AND n_repeat_words / n_words <= 0.5"
)

_LINES = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
w AS (SELECT *, len(list_filter(regexp_split_to_array(line, '{_SPACE}'), lambda x: x <> '')) AS words FROM l),
s AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS until FROM w WHERE words > 0),
b AS (SELECT *, until - words AS before FROM s),
p AS (
  SELECT doc_id, min(pos) OVER onwards AS first, max(pos) OVER onwards AS last, sum(words) OVER onwards AS n,
    list(line) OVER onwards AS passage FROM b
  WINDOW onwards AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT doc_id, min(pos) OVER upwards, max(pos) OVER upwards, sum(words) OVER upwards, list(line) OVER upwards FROM b
  WINDOW upwards AS (PARTITION BY doc_id ORDER BY until RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
k AS (SELECT doc_id, first, last, md5(array_to_string(passage, chr(10))) AS passage FROM p WHERE n >= 50),
o AS (SELECT passage, min({{place}}) AS origin FROM k GROUP BY passage),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS pos FROM k JOIN o USING (passage) WHERE {{place}} > origin),
within AS (SELECT g.doc_id, g.pos FROM gone g),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS text,
  count(*) AS n_lines, count(g.pos) AS n_removed FROM l LEFT JOIN within g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE n_lines END AS n_lines, n_removed
FROM documents d JOIN kept USING (doc_id)
"""

_SEARCH = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v AS q JOIN v AS c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of a string's UTF-8 bytes, a byte at a time, over rows joined with ``crc``."""
    data = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i::INT + 1, 2))::UBIGINT)"
    start = "list_prepend(4294967295::UBIGINT, %s)" % data
    step = f"lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255)::INT + 1])"
    return f"xor(list_reduce({start}, {step}), 4294967295::UBIGINT)::BIGINT"


_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(
  list_prepend(n::UBIGINT, list_transform(range(8), lambda s: 0::UBIGINT)),
  lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS entries)"""

_SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
found AS (SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS named, count(*) AS n FROM runs GROUP BY run, doc_id),
hashed AS (SELECT run, n, {_crc32("named")} AS h FROM found, crc),
words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
  ELSE run END AS word, sum(n)::BIGINT AS n FROM hashed GROUP BY 1),
v AS (SELECT word, n, length(word) AS l FROM words WHERE length(word) >= 6 AND n >= 5),
cut AS (SELECT word, n, l, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT *, unnest(range(1, l + 1))::INT AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut AS a JOIN cut AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut AS a JOIN v AS b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut AS a JOIN v AS b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
formed AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form,
  CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM v LEFT JOIN best USING (word)),
way(word, root) AS (SELECT word, word FROM formed
  UNION ALL SELECT way.word, formed.form FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NOT NULL),
last AS (SELECT way.word, way.root FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN last USING (word)
"""


def _leaf(n_chars: str = "n_chars") -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    shown = [f"coalesce(octet_length(encode(({c})::VARCHAR)) || ':' || ({c})::VARCHAR, '-')" for c in fields]
    return f"sha256({' || '.join(shown)})"


def _levels(name: str, source: str, key: str) -> str:
    """A recursive table of all levels of the trees whose leaves ``source`` lists."""
    return f"""{name}({key}, level, nodes) AS (SELECT {key}, 0, nodes FROM {source}
  UNION ALL SELECT {key}, level + 1, list_transform(range((len(nodes) + 1) // 2),
    lambda k: sha256(nodes[2 * k + 1] || coalesce(nodes[2 * k + 2], ''))) FROM {name} WHERE len(nodes) > 1)"""


_MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (SELECT *, {_leaf()} AS leaf, {_leaf("n_chars + 1")} AS other FROM documents),
placed AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '-') AS g, leaf,
  CASE WHEN {_crc32("doc_id::VARCHAR")} % 7 = 0 THEN other ELSE leaf END AS tampered,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves, crc),
groups AS (SELECT g, list(leaf ORDER BY i) AS nodes FROM placed GROUP BY g),
{_levels("low", "groups", "g")},
subroots AS (SELECT g, nodes[1] AS subroot, level AS height, row_number() OVER (ORDER BY encode(g)) - 1 AS i
  FROM low WHERE len(nodes) = 1),
tops AS (SELECT 0 AS t, list(subroot ORDER BY i) AS nodes FROM subroots),
{_levels("high", "tops", "t")},
roots AS (SELECT nodes[1] AS root FROM high WHERE len(nodes) = 1),
path AS (
  SELECT rid, level, p.i >> level AS place, coalesce(nodes[(xor(p.i >> level, 1) + 1)::INT], '') AS sibling
    FROM placed AS p JOIN low USING (g) WHERE len(nodes) > 1
  UNION ALL SELECT rid, height + level, s.i >> level, coalesce(nodes[(xor(s.i >> level, 1) + 1)::INT], '')
    FROM placed AS p JOIN subroots AS s USING (g), high WHERE len(nodes) > 1),
steps AS (SELECT rid, list({{'place': place, 'sibling': sibling}} ORDER BY level) AS steps,
  string_agg(sibling, '' ORDER BY level) AS siblings FROM path GROUP BY rid),
folding(rid, step, node, steps) AS (SELECT rid, 0, tampered, coalesce(steps, []) FROM placed LEFT JOIN steps USING (rid)
  UNION ALL SELECT rid, step + 1, CASE WHEN steps[step + 1].place % 2 = 0 THEN sha256(node || steps[step + 1].sibling)
    ELSE sha256(steps[step + 1].sibling || node) END, steps FROM folding WHERE step < len(steps)),
folded AS (SELECT rid, node AS folded_root FROM folding WHERE step = len(steps))
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (g) JOIN roots ON true LEFT JOIN steps USING (rid) JOIN folded USING (rid)
"""


ORACLE = {
    "op3_decontamination": _DECONTAMINATION,
    "op8_quality_rules": _QUALITY.format(stop=", ".join(f"'{w}'" for w in _STOP), rules=_RULES),
    "op10_line_dedup": _LINES.format(place="row(doc_id, first)"),
    "op11_vector_search": _SEARCH,
    "op12_spelling_variants": _SPELLING,
    "op13_merkle_manifest": _MERKLE,
}
