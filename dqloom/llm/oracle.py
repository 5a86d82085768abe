"""SQL for the queries of this subpackage that have an equivalent.

The line labels, the classifier, the hashes that order shards and the tokenizer have none;
tests hold those queries against brute force.
"""

WORD = r"[^\x20\x09-\x0D]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{CAPITALS}', '{SMALL}')"


ORACLE: dict[str, str] = {}

ORACLE["op1_substring_dedup"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
firsts AS (SELECT s, min(doc_id) AS f FROM windows GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM windows JOIN firsts USING (s), unnest(range(13)) AS r(j) WHERE f < doc_id),
words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS k FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

ORACLE["op2_benchmark_decontamination"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_lowered("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_lowered("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
patterns AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
windows AS (SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS s
  FROM d, (SELECT DISTINCT m FROM patterns) AS l, unnest(range(1, len(w) - m + 2)) AS t(i)),
found AS (SELECT doc_id, i, m, item_id FROM windows JOIN patterns USING (m, s)),
hits AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM found, unnest(range(m)) AS r(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) AS x GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLE["op4_jaccard_join"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_lowered("text")}, '{WORD}') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s, len(w) < 5 AS short
  FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sets AS a JOIN sets AS b ON a.s = b.s AND a.short = b.short
  AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes AS p ON p.doc_id = x JOIN sizes AS q ON q.doc_id = y
  WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT node, y FROM reach JOIN links ON x = seen)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) AS r USING (doc_id)"""

ORACLE["op5_mixing"] = rf"""
WITH quality AS (SELECT doc_id, max(quality) AS label FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS text_key, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
  CASE label WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM documents LEFT JOIN quality USING (doc_id)),
keyed AS (SELECT *, -ln((CAST(CAST('0x' || substr(md5(concat_ws('/', '7', coalesce(CAST(doc_id AS VARCHAR), ''), text_key)), 1, 13) AS BIGINT) AS DOUBLE)
  + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / weight AS key FROM d),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
ranked AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM per),
ordered AS (SELECT *, 3.0::DOUBLE * source_size / w AS cap FROM ranked),
levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(source_size) OVER before, 0) * 3.0::DOUBLE)
  / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level FROM ordered
  WINDOW before AS (ORDER BY cap, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (SELECT *, max(level) OVER () AS share FROM levels),
aims AS (SELECT source, source_size, CASE WHEN cap <= share THEN 3.0::DOUBLE * source_size ELSE share * w END AS target FROM shares),
placed AS (SELECT k.*, source_size, target, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS epochs,
  CAST(coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, text_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
  FROM keyed AS k JOIN aims AS a ON k.source IS NOT DISTINCT FROM a.source),
fit AS (SELECT *, target - epochs * source_size AS rest, ahead + size <= target - epochs * source_size AND size > 0 AS fits FROM placed),
gaps AS (SELECT source, max(rest) - sum(CASE WHEN fits THEN size ELSE 0 END) AS gap FROM fit GROUP BY source),
edges AS (SELECT f.source, f.doc_id, f.text_key, row_number() OVER (PARTITION BY f.source ORDER BY abs(size - gap), key, f.doc_id, f.text_key) AS nth
  FROM fit AS f JOIN gaps AS g ON f.source IS NOT DISTINCT FROM g.source WHERE NOT fits AND size > 0 AND abs(size - gap) < gap)
SELECT f.doc_id, size, source_size, target, (epochs + CASE WHEN fits OR e.nth IS NOT NULL THEN 1 ELSE 0 END) * size AS taken
FROM fit AS f LEFT JOIN edges AS e ON e.nth = 1 AND NOT fits AND f.source IS NOT DISTINCT FROM e.source AND f.doc_id = e.doc_id AND f.text_key = e.text_key"""

ORACLE["op7_line_dedup"] = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, p, l[p] AS line, regexp_replace({_lowered("l[p]")}, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS key
  FROM d, unnest(range(1, len(l) + 1)) AS t(p)),
firsts AS (SELECT key, min(doc_id) AS f FROM lines WHERE length(key) >= 10 GROUP BY key),
kept AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS k
  FROM lines LEFT JOIN firsts USING (key) WHERE f IS NULL OR f = doc_id GROUP BY doc_id)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

ORACLE["op9_suffix_dedup"] = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS s FROM d, unnest(range(0, CAST(length(h) // 2 - 99 AS BIGINT))) AS t(i)),
firsts AS (SELECT s, min((doc_id, i)) AS f FROM strings GROUP BY s),
late AS (SELECT doc_id, i FROM strings JOIN firsts USING (s) WHERE f <> (doc_id, i)),
steps AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM late),
runs AS (SELECT doc_id, i, sum(CASE WHEN step <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, run),
parts AS (SELECT doc_id, a, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1,
  2 * (a - coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0))) AS part FROM spans JOIN d USING (doc_id)),
cut AS (SELECT doc_id, string_agg(part, '' ORDER BY a) AS head FROM parts GROUP BY doc_id),
totals AS (SELECT doc_id, count(*) AS n, sum(b - a) AS removed, max(b) AS last FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN totals USING (doc_id) LEFT JOIN cut USING (doc_id)"""

ORACLE["op11_exact_dedup"] = rf"""
WITH d AS (SELECT doc_id, {_lowered("text")} AS t FROM documents),
groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN groups USING (t)"""

# The polynomial of crc32, and the remainders of all bytes, made from it.
CRC_TABLE = """SELECT list(r ORDER BY n) AS remainders FROM (
  SELECT n, list_reduce([n] || list_transform(range(8), lambda s: 0), lambda v, s: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END) AS r
  FROM (SELECT unnest(range(256)) AS n))"""


def _crc32(numbers: str) -> str:
    """crc32 of a list of bytes, with ``remainders`` in scope."""
    return f"""xor(list_reduce([CAST(4294967295 AS BIGINT)] || {numbers},
  lambda v, b: xor(v // 256, remainders[CAST(xor(v % 256, b) AS INTEGER) + 1])), 4294967295)"""


# Letters of a word as bytes of UTF-8: those beyond ASCII are two.
_BYTES = r"""flatten(list_transform(string_split({}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
  ELSE [CAST(195 AS BIGINT), CAST(unicode(x) - 64 AS BIGINT)] END))"""

ORACLE["op12_spelling_variants"] = rf"""
WITH RECURSIVE crc AS MATERIALIZED ({CRC_TABLE}),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
  unnest(regexp_extract_all({_lowered("text")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) AS x WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32(_BYTES.format("doc_id || ':' || run"))} AS h FROM runs, crc),
typed AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS part FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
near AS (SELECT DISTINCT * FROM (
  SELECT a.word, b.word AS other, b.n AS m FROM less AS a JOIN less AS b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT a.word, b.word, b.n FROM less AS a JOIN words AS b ON a.part = b.word
  UNION ALL SELECT b.word, a.word, a.n FROM less AS a JOIN words AS b ON a.part = b.word) AS x),
ranked AS (SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS nth FROM near),
found AS MATERIALIZED (SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
  FROM words AS w LEFT JOIN (SELECT * FROM ranked WHERE nth = 1) AS r USING (word)),
walk AS (SELECT word, coalesce(form, word) AS root, form IS NULL AS last FROM found
  UNION ALL SELECT w.word, coalesce(f.form, w.root), f.form IS NULL FROM walk AS w JOIN found AS f ON f.word = w.root WHERE NOT w.last)
SELECT f.word, form, root, n, n_near, form_n FROM found AS f JOIN walk AS w ON w.word = f.word AND w.last"""


def _part(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(_part(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _levels(name: str, source: str) -> str:
    """All levels of the trees of ``source`` (k, i, node, n)."""
    return f"""{name} AS (SELECT k, 0 AS level, i, node, n FROM {source}
  UNION ALL SELECT k, level + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY k, level, i // 2, n)"""


ORACLE["op13_merkle_manifest"] = rf"""
WITH RECURSIVE crc AS MATERIALIZED ({CRC_TABLE}),
leaves AS MATERIALIZED (SELECT doc_id, coalesce('+' || lang, '') AS k, {_leaf()} AS node,
  CASE WHEN {_crc32("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT))")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf()} END AS tried
  FROM documents, crc),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, node) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM leaves),
{_levels("trees", "placed")},
nodes AS MATERIALIZED (SELECT * FROM trees),
subroots AS MATERIALIZED (SELECT k AS lang, '' AS k, node, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_levels("uppers", "subroots")},
tops AS MATERIALIZED (SELECT * FROM uppers),
heights AS (SELECT k, max(level) AS height FROM nodes GROUP BY k),
-- the ways up, level by level: the lower tree's levels, then those of the upper one
lower AS (SELECT p.doc_id, p.k, p.i AS leaf_i, 0 + x.level AS step, x.i % 2 AS side, y.node AS other
  FROM placed AS p JOIN nodes AS x ON x.k = p.k AND x.n > 1 AND x.i = p.i // CAST(pow(2, x.level) AS BIGINT)
  LEFT JOIN nodes AS y ON y.k = x.k AND y.level = x.level AND y.i = xor(x.i, 1)),
upper AS (SELECT s.lang, x.level AS step, x.i % 2 AS side, y.node AS other
  FROM subroots AS s JOIN tops AS x ON x.n > 1 AND x.i = s.i // CAST(pow(2, x.level) AS BIGINT)
  LEFT JOIN tops AS y ON y.level = x.level AND y.i = xor(x.i, 1)),
ways AS (SELECT doc_id, k, leaf_i, step, side, other FROM lower
  UNION ALL SELECT p.doc_id, p.k, p.i, height + step, side, other FROM placed AS p JOIN upper ON lang = p.k JOIN heights AS t ON t.k = p.k),
listed AS (SELECT k, leaf_i, list(struct_pack(side := side, other := other) ORDER BY step) AS way, sha256(coalesce(string_agg(other, '' ORDER BY step), '')) AS proof
  FROM ways GROUP BY k, leaf_i),
results AS (SELECT p.doc_id, p.node AS leaf, s.node AS subroot, t.node AS root, coalesce(proof, sha256('')) AS proof_sha256,
  list_reduce([struct_pack(side := CAST(0 AS BIGINT), other := p.tried)] || coalesce(way, []), lambda a, b: struct_pack(side := CAST(0 AS BIGINT),
    other := sha256(CASE WHEN b.other IS NULL THEN a.other WHEN b.side = 1 THEN b.other || a.other ELSE a.other || b.other END))).other AS folded_root
  FROM placed AS p JOIN subroots AS s ON s.lang = p.k JOIN (SELECT node FROM tops WHERE n = 1) AS t ON true
  LEFT JOIN listed AS l ON l.k = p.k AND l.leaf_i = p.i)
SELECT *, folded_root = root AS verified FROM results"""
