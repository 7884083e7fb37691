"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

# Words of a text: runs without ASCII white space.
WORDS = "list_filter(regexp_split_to_array({0}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 3),
           lambda i: array_to_string(ws[i:i + 4], ' ')))) END AS sh FROM w),
n AS (SELECT doc_id, sh, CAST(len(sh) AS BIGINT) AS n FROM s),
u AS MATERIALIZED (SELECT doc_id, n, unnest(sh) AS x FROM n),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n
      HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS d, doc_id AS x FROM n UNION SELECT r.d, p.b FROM r JOIN p ON r.x = p.a),
c AS (SELECT d, min(x) AS component_id FROM r GROUP BY d),
k AS (SELECT sh, count(*) AS c FROM n WHERE n > 0 GROUP BY sh)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, CAST(coalesce(k.c, 0) AS BIGINT) AS n_copies
FROM n JOIN c ON c.d = n.doc_id LEFT JOIN k ON k.sh = n.sh
"""

SQL = {"op3_jaccard_join": OP3}

_BOILER = " OR ".join(f"contains(low, '{x}')" for x in (
    "all rights reserved", "back to top", "click here", "cookie", "copyright", "follow us",
    "javascript", "log in", "lorem ipsum", "newsletter", "powered by", "privacy policy",
    "read more", "share this", "sign in", "sign up", "skip to content", "subscribe to",
    "terms of service", "terms of use"))


def _count(column: str, chars: str) -> str:
    """Number of characters of ``column`` that are in the class ``chars``."""
    return f"length(regexp_replace({column}, '[^{chars}]', '', 'g'))"


_VISIBLE = "length(regexp_replace({0}, '[\\x20\\x09-\\x0D]', '', 'g'))"

OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT doc_id, t, {WORDS.format("t")} AS ws FROM d),
tri AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i,
  unnest(list_transform(range(1, len(ws) - 1),
    lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS x FROM w WHERE len(ws) >= 3),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c
        FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY doc_id),
l0 AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
        generate_subscripts(string_split(t, chr(10)), 1) AS k FROM w),
l1 AS (SELECT doc_id, line, k, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) > 1 AS again,
        {LOWER.format("line")} AS low, len({WORDS.format("line")}) AS n,
        {_VISIBLE.format("line")} AS chars FROM l0),
l2 AS (SELECT *, n > 0 AND (again
        OR ({_count("line", "|>")} >= 3 AND 5 * {_count("line", "|>")} >= n)
        OR 100 * {_count("line", "#*$%&|<>!?")} > 15 * chars
        OR (n < 8 AND {_count("line", ".!?;:")} = 0)
        OR (n <= 40 AND ({_BOILER}))) AS fail FROM l1),
l3 AS (SELECT doc_id, CAST(sum(chars) AS BIGINT) AS word_chars,
        CAST(sum(CASE WHEN fail THEN 0 ELSE chars END) AS BIGINT) AS kept_chars,
        count(*) FILTER (n > 0) AS n_lines, count(*) FILTER (fail) AS n_failed_lines,
        count(*) FILTER (n > 0 AND again) AS n_dup_lines FROM l2 GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, l3.word_chars,
        CAST({_count("t", "#*$%&|<>")} AS BIGINT) AS n_symbols, l3.n_dup_lines,
        CAST(coalesce(rep.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        l3.n_lines, l3.n_failed_lines, l3.kept_chars
      FROM w JOIN l3 USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND 100 * kept_chars >= 50 * word_chars AS kept
FROM m
"""
SQL["op4_quality_rules"] = OP4

_ADDED = "length(regexp_replace({0}, '[^\\\\<\\[\\]]', '', 'g'))"

OP5 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS a,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS l,
  CAST(sum(4 + length(role) + {_ADDED.format("role")} + 2 + length(text) + {_ADDED.format("text")} + 5)
       AS BIGINT) AS formatted_chars FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(a) AS turns_sha256, CAST(length(l) AS BIGINT) AS loss_chars,
  sha256(l) AS loss_sha256, formatted_chars FROM g
"""
SQL["op5_chat_format"] = OP5

# Every diagonal on which enough words are equal, without any seeds.
OP10 = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {WORDS.format("lower(coalesce(text, ''))")} AS a FROM documents),
b AS MATERIALIZED (SELECT item_id, {WORDS.format("lower(coalesce(text, ''))")} AS b FROM benchmark),
n AS (SELECT item_id, b, len(b) AS n_words, least(20, len(b)) AS w,
  CASE WHEN len(b) < 9 THEN 100 ELSE 80 END * least(20, len(b)) AS needed FROM b WHERE len(b) > 0),
dw AS MATERIALIZED (SELECT doc_id, unnest(a) AS x, unnest(range(0, len(a))) AS p FROM d),
bw AS MATERIALIZED (SELECT item_id, unnest(b) AS x, unnest(range(0, len(b))) AS i FROM b),
h AS MATERIALIZED (SELECT doc_id, item_id, p - i AS g FROM dw JOIN bw USING (x) JOIN n USING (item_id)
  GROUP BY doc_id, item_id, p - i, needed HAVING 100 * count(*) >= needed),
e AS (SELECT doc_id, item_id, g, n_words, w, needed,
  list_transform(range(0, len(b)), lambda i: CASE WHEN i + g >= 0 AND i + g < len(a)
    AND b[i + 1] = a[i + g + 1] THEN 1 ELSE 0 END) AS q
  FROM h JOIN d USING (doc_id) JOIN n USING (item_id)),
s AS (SELECT doc_id, item_id, g, n_words, needed, list_sum(q) AS n_equal,
  list_max(list_transform(range(1, n_words - w + 2), lambda x: list_sum(q[x:x + w - 1]))) AS best FROM e)
SELECT doc_id, item_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_equal AS BIGINT) AS n_equal,
  CAST(best AS BIGINT) AS best, CAST(g AS BIGINT) AS diagonal FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY best DESC, n_equal DESC, g) AS r
    FROM s WHERE 100 * best >= needed) WHERE r = 1
"""
SQL["op10_decontaminate"] = OP10

OP13 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang,
  coalesce(source, '') AS source, regexp_extract_all({LOWER.format("coalesce(text, '')")},
  '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
o AS MATERIALIZED (SELECT k, lang, source, unnest(ts) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS c FROM o GROUP BY lang, term
  HAVING count(DISTINCT k) >= 3),
l AS MATERIALIZED (SELECT lang, count(*) AS v, CAST(sum(c) AS BIGINT) AS n FROM kept GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS c FROM o SEMI JOIN kept USING (lang, term)
  GROUP BY lang, source, term),
n AS (SELECT lang, source, CAST(sum(c) AS BIGINT) AS n FROM c GROUP BY lang, source),
p AS MATERIALIZED (
  SELECT lang, source, term, coalesce(c.c, 0) AS c,
    1 + 1000000000 * (coalesce(c.c, 0) + 1) // (coalesce(n.n, 0) + l.v) AS p
  FROM g JOIN kept USING (lang) JOIN l USING (lang)
  LEFT JOIN c USING (lang, source, term) LEFT JOIN n USING (lang, source)),
q AS (SELECT lang, term, 1 + 1000000000 * (kept.c + 1) // (l.n + l.v) AS q
  FROM kept JOIN l USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item,
    CAST(sum(CAST(a.p - b.p AS HUGEINT) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(CAST(p - q AS HUGEINT) * (p - q) // q AS BIGINT)
  FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 200
"""
SQL["op13_source_audit"] = OP13


def _crc_table() -> list[int]:
    """The 256 steps of the reflected CRC-32 polynomial."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


# Code points up to U+00FF as UTF-8 bytes, then the CRC byte by byte.
OP12 = f"""
WITH RECURSIVE t AS MATERIALIZED (SELECT {_crc_table()}::BIGINT[] AS steps),
r0 AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
  {LOWER.format("text")}, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
r1 AS MATERIALIZED (SELECT id, run, count(*) AS n FROM r0 GROUP BY id, run),
r2 AS (SELECT id, run, n, flatten(list_transform(string_split(id || ':' || run, ''),
  lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
       ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END)) AS bs FROM r1),
r3 AS (SELECT id, run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bs),
  lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]))) AS h FROM r2, t),
r4 AS (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
  ELSE run END AS word FROM r3),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM r4 GROUP BY word
  HAVING sum(n) >= 3 AND length(word) >= 5),
d AS MATERIALIZED (SELECT word, n, length(word) AS l, unnest(range(1, length(word) + 1)) AS i,
  unnest(list_transform(range(1, length(word) + 1), lambda i: substr(word, 1, i - 1) || substr(word, i + 1))) AS x FROM v),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS other_n FROM d a JOIN d b USING (l, i, x) WHERE a.word <> b.word
  UNION ALL SELECT DISTINCT d.word, v.word, v.n FROM d JOIN v ON d.x = v.word
  UNION ALL SELECT DISTINCT v.word, d.word, d.n FROM d JOIN v ON d.x = v.word),
b AS (SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
  CASE WHEN most >= 2 * v.n THEN (SELECT min(other) FROM near WHERE near.word = v.word AND other_n = most) END AS form,
  CASE WHEN most >= 2 * v.n THEN most END AS form_n FROM v LEFT JOIN b USING (word)),
up AS (SELECT word, word AS top, 0 AS k FROM f
  UNION ALL SELECT up.word, f.form, k + 1 FROM up JOIN f ON f.word = up.top WHERE f.form IS NOT NULL)
SELECT f.word, form, arg_max(top, k) AS root, n, n_near, form_n
FROM f JOIN up USING (word) GROUP BY f.word, form, n, n_near, form_n
"""
SQL["op12_spelling_variants"] = OP12

# The same sets as OP3's, of four words; one row says which document stays.
OP11 = f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 2),
           lambda i: array_to_string(ws[i:i + 3], ' ')))) END AS sh FROM w),
n AS (SELECT doc_id, sh, CAST(len(sh) AS BIGINT) AS n FROM s),
u AS MATERIALIZED (SELECT doc_id, n, unnest(sh) AS x FROM n),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n
      HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS d, doc_id AS x FROM n UNION SELECT r.d, p.b FROM r JOIN p ON r.x = p.a),
c AS (SELECT d, min(x) AS component_id FROM r GROUP BY d)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN c ON c.d = n.doc_id
"""
SQL["op11_minhash_dedup"] = OP11
