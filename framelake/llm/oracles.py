"""DuckDB statements of the results that SQL can express, one per query."""

from __future__ import annotations

_GAPS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"[^\x20\x09-\x0D]+"

_CONTROL = r"<\|turn\|>|<\|says\|>|<\|done\|>|<\|endoftext\|>|<\|startoftext\|>|<\|im_start\|>|<\|im_end\|>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<s>|</s>"
# Escaping adds a character for each backslash and each control string; the three marks of a turn have 24.
_ESCAPED = rf"length({{0}}) * 2 - length(replace({{0}}, chr(92), '')) + len(regexp_extract_all({{0}}, '{_CONTROL}'))"

OP3 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
  sum(24 + {_ESCAPED.format("role")} + {_ESCAPED.format("text")}) AS chars FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(chars AS BIGINT) AS formatted_chars FROM g
"""

OP4 = """
WITH rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
r AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
u AS (SELECT DISTINCT host, path FROM p),
j AS (SELECT u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
  arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY ALL)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN j ON p.host = j.host AND p.path = j.path
"""

OP6 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS pos FROM b WHERE len(w) > 0)),
t AS (SELECT r, size, unnest(range(1, len(w) - size + 2)) AS pos, w FROM d, (SELECT DISTINCT size FROM i) WHERE len(w) >= size),
x AS (SELECT r, pos, t.size, item_id FROM t JOIN i ON t.size = i.size AND i.win = array_to_string(list_slice(w, pos, pos + t.size - 1), ' ')),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + size)) AS p FROM (SELECT DISTINCT r, pos, size FROM x)) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM x) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r)
"""

OP8 = rf"""
WITH d AS (SELECT doc_id, source, coalesce('=' || source, '') AS key, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
  CAST(coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, key, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY ALL),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
  source_size * 2.0::DOUBLE AS stop FROM s),
l AS (SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS words, stop / weight AS quotient,
  coalesce(sum(stop) OVER (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS before,
  sum(weight) OVER (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w),
f AS (SELECT *, before + quotient * open <= words AS is_full FROM l),
t AS (SELECT key, source_size, CASE WHEN is_full THEN stop ELSE
  (words - coalesce(sum(stop) FILTER (is_full) OVER (), 0.0::DOUBLE)) * weight / sum(weight) FILTER (NOT is_full) OVER () END AS target FROM f),
k AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS expected,
  row_number() OVER (PARTITION BY key ORDER BY size, digest) AS rank,
  CAST('0x' || substr(md5('17:' || key), 1, 7) AS BIGINT) / 268435456.0::DOUBLE AS start FROM d JOIN t USING (key))
SELECT doc_id, size, source_size, target,
  CAST(size * least(floor(rank * expected + start) - floor((rank - 1) * expected + start), ceil(expected)) AS BIGINT) AS taken FROM k
"""

_SLACK = {"symbols": (60, None), "dup_lines": (400, None), "repeats": (350, None), "capitals": (350, None), "word_length": (600, 250)}
_REACH = "3 * (quantile_disc(bin, 0.75) - quantile_disc(bin, 0.25))"
_ENDS = f"""count(*) AS n, quantile_disc(bin, 0.75) + greatest({_REACH}, CASE any_value(measure) {" ".join(f"WHEN '{k}' THEN {up}" for k, (up, _) in _SLACK.items())} END) AS above,
  greatest(quantile_disc(bin, 0.25) - greatest({_REACH}, 250), 0) AS below"""
QUALITY = rf"""
a AS (SELECT *, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
b AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: trim(x, {_GAPS}) <> '') AS l,
  [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] AS g FROM a),
c AS (SELECT *, list_histogram(g) AS h FROM b),
e AS (SELECT * EXCLUDE (t, w, l, g, h), CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(t, {_GAPS}, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  CAST(len(list_filter(range(1, len(w) + 1), lambda i: (i <= len(g) AND h[g[i]] > 1) OR (i > 1 AND i - 1 <= len(g) AND h[g[i - 1]] > 1)
    OR (i > 2 AND i - 2 <= len(g) AND h[g[i - 2]] > 1))) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
  length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals FROM c),
q AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 1000 * n_symbols // greatest(word_chars, 1) AS symbols,
  1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines, 1000 * n_repeat_words // greatest(n_words, 1) AS repeats,
  1000 * n_capitals // greatest(word_chars, 1) AS capitals, 100 * word_chars // greatest(n_words, 1) AS word_length FROM e),
m AS (SELECT lang, source, measure, CAST(value AS BIGINT) AS value FROM (SELECT * FROM q WHERE NOT base_failed)
  UNPIVOT (value FOR measure IN (symbols, dup_lines, repeats, capitals, word_length))),
n AS (SELECT *, (value >> greatest(length(bin(value)) - 10, 0)) << greatest(length(bin(value)) - 10, 0) AS bin FROM m),
o AS (SELECT lang, source, measure, {_ENDS} FROM n GROUP BY ALL),
o1 AS (SELECT lang, measure, {_ENDS} FROM n GROUP BY ALL),
o2 AS (SELECT measure, {_ENDS} FROM n GROUP BY ALL),
th AS (SELECT o.lang, o.source, o.measure, {", ".join(f"(o.n * o.{e} + 100 * ((o1.n * o1.{e} + 100 * o2.{e}) // (o1.n + 100))) // (o.n + 100) AS {e}" for e in ("above", "below"))}
  FROM o JOIN o1 ON o.lang IS NOT DISTINCT FROM o1.lang AND o.measure = o1.measure JOIN o2 ON o.measure = o2.measure),
fence AS (SELECT lang, source, {", ".join(f"max(CASE WHEN measure = '{k}' THEN above END) AS {k}_max" for k in _SLACK)},
  max(CASE WHEN measure = 'word_length' THEN below END) AS word_length_min FROM th GROUP BY lang, source),
judged AS (SELECT q.*, coalesce(NOT base_failed AND {" AND ".join(f"q.{k} <= {k}_max" for k in _SLACK)} AND q.word_length >= word_length_min, false) AS kept
  FROM q LEFT JOIN fence f ON q.lang IS NOT DISTINCT FROM f.lang AND q.source IS NOT DISTINCT FROM f.source)
"""
OP9 = f"WITH {QUALITY.strip()}\nSELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"

# CRC-32 of an ASCII string, reflected, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, [CAST(ascii(ch) AS BIGINT) FOR ch IN string_split({0}, '')]), lambda c, b:
  list_reduce(list_prepend(xor(c, b), [0, 1, 2, 3, 4, 5, 6, 7]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP11 = rf"""
WITH RECURSIVE t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS i FROM conversations),
s AS (SELECT c, CAST(c AS VARCHAR) AS name FROM (SELECT DISTINCT c FROM t)),
h AS (SELECT c, {_CRC32.format("name")} % 9 AS h FROM s),
r AS (SELECT h.c, t.i, t.role, t.text FROM h JOIN t ON t.c = h.c - h.c % 5 AND t.i < h.h
  UNION ALL SELECT h.c, 100 + t.i, t.role, t.text FROM h JOIN t ON t.c = h.c AND t.i >= h.h),
p AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS d, list(sha256(role) || sha256(text)) OVER (PARTITION BY c ORDER BY i) AS seq,
  strlen(text) AS bytes, count(*) OVER (PARTITION BY c) AS n FROM r),
o AS (SELECT c, d, sha256(array_to_string(seq, '')) AS node, CASE WHEN d > 1 THEN sha256(array_to_string(seq[:d - 1], '')) ELSE '' END AS up, bytes, n = d AS ends FROM p
  UNION ALL SELECT c, 0, '', NULL, 0, c NOT IN (SELECT c FROM p) FROM h),
n AS (SELECT node, d, up, bytes, min(c) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM o GROUP BY ALL),
k AS (SELECT up AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY up),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children, n_children IS NULL AS leaf FROM n LEFT JOIN k USING (node)),
below AS (SELECT node AS top, node, d FROM w UNION ALL SELECT b.top, w.node, w.d FROM below b JOIN w ON w.up = b.node AND w.d = b.d + 1),
g AS (SELECT top AS node, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * bytes) AS saved FROM below JOIN w USING (node) GROUP BY top)
SELECT w.conv_id, w.d AS depth, a.conv_id AS parent_conv_id, w.n_convs, w.n_children, g.n_leaves, CAST(g.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN g USING (node) LEFT JOIN w a ON w.up = a.node
"""

OP12 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS (SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 1 THEN w ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS g FROM d),
e AS (SELECT r, len(g) AS n, unnest(g) AS x FROM s),
l AS (SELECT a.r AS a, b.r AS b FROM e a JOIN e b ON a.x = b.x AND a.r <> b.r AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
c AS (SELECT r AS a, r AS b FROM s UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a),
m AS (SELECT c.a AS r, min(doc_id) AS component_id FROM c JOIN s ON c.b = s.r GROUP BY c.a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM s JOIN m USING (r)
"""

_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _FIELD + ")"

OP13 = f"""
WITH RECURSIVE l AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_LEAF.format("text")} AS leaf,
  {_LEAF.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered, CAST(doc_id AS VARCHAR) AS name,
  row_number() OVER (PARTITION BY coalesce('=' || lang, '') ORDER BY doc_id NULLS FIRST) - 1 AS pos FROM documents),
low AS (SELECT tree, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS size FROM l
  UNION ALL SELECT tree, max(level) + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), max(size + 7) // 8 FROM low WHERE size > 1 GROUP BY tree, pos // 8),
sub AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM low WHERE size = 1),
high AS (SELECT '/' AS tree, 0 AS level, pos, subroot AS digest, count(*) OVER () AS size FROM sub
  UNION ALL SELECT tree, max(level) + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), max(size + 7) // 8 FROM high WHERE size > 1 GROUP BY tree, pos // 8),
runs AS (SELECT tree, level, pos // 8 AS run, list(digest ORDER BY pos) AS nodes FROM (FROM low UNION ALL FROM high) WHERE size > 1 GROUP BY ALL),
walk AS (SELECT doc_id, pos AS leaf_pos, tree AS lang, tree, 0 AS level, pos, '' AS proof, CASE WHEN {_CRC32.format("name")} % 3 = 0 THEN lowered ELSE leaf END AS folded FROM l
  UNION ALL SELECT doc_id, leaf_pos, lang, w.tree, w.level + 1, w.pos // 8, proof || array_to_string(nodes[:w.pos % 8] || nodes[w.pos % 8 + 2:], ''),
    sha256(array_to_string(nodes[:w.pos % 8] || [folded] || nodes[w.pos % 8 + 2:], '')) FROM walk w JOIN runs r ON r.tree = w.tree AND r.level = w.level AND r.run = w.pos // 8),
subs AS (SELECT w.* FROM walk w JOIN (SELECT tree, max(level) AS level FROM low GROUP BY tree) t ON w.lang = t.tree AND w.level = t.level),
up AS (SELECT doc_id, leaf_pos, lang, 0 AS level, s.pos, proof, folded, subroot FROM subs JOIN sub s ON s.tree = lang
  UNION ALL SELECT doc_id, leaf_pos, lang, u.level + 1, u.pos // 8, proof || array_to_string(nodes[:u.pos % 8] || nodes[u.pos % 8 + 2:], ''),
    sha256(array_to_string(nodes[:u.pos % 8] || [folded] || nodes[u.pos % 8 + 2:], '')), subroot FROM up u JOIN runs r ON r.tree = '/' AND r.level = u.level AND r.run = u.pos // 8),
top AS (SELECT max(level) AS level, max(digest) FILTER (size = 1) AS root FROM high)
SELECT u.doc_id, l.leaf, u.subroot, t.root, sha256(u.proof) AS proof_sha256, u.folded AS folded_root, u.folded = t.root AS verified
FROM up u JOIN top t ON u.level = t.level JOIN l ON l.tree = u.lang AND l.pos = u.leaf_pos
"""
