"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from adlens.llm.licenses import TEMPLATES

_NOTICES = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in TEMPLATES)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b, k = x.n AND k = y.n AS twin FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)),
degrees AS MATERIALIZED (SELECT a, count(*) AS n_links, count(*) FILTER (twin) AS twins FROM links GROUP BY a),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM words
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT r.a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r.b) AS component_id,
       coalesce(any_value(twins), 0) + 1 AS class_size, coalesce(any_value(n_links), 0) AS n_links
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.a LEFT JOIN degrees d ON d.a = r.a
GROUP BY r.a
""",
    "op3_line_dedup": """
WITH lines AS MATERIALIZED (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
spots AS MATERIALIZED (
  SELECT doc_id, pos, l[pos + 1:pos + 3] AS w
  FROM (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS pos FROM lines)
  WHERE trim(array_to_string(l[pos + 1:pos + 3], ''), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
later AS (
  SELECT doc_id, pos
  FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS nth FROM spots)
  WHERE nth > 1),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, pos + k AS pos FROM later, (SELECT unnest([0, 1, 2]) AS k)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS text
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS pos FROM lines) ANTI JOIN gone USING (doc_id, pos)
  GROUP BY doc_id)
SELECT a.doc_id, CASE WHEN a.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(len(a.l), 0) AS n_lines, coalesce(len(a.l), 0) - coalesce(k.n, 0) AS n_removed
FROM lines a LEFT JOIN kept k USING (doc_id)
""",
    "op9_exact_top_k": """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0)
SELECT query_id, nth::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth FROM scored)
WHERE nth <= 10
""",
    "op6_license_scan": f"""
WITH texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
  FROM documents),
notices AS (
  SELECT template, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
  FROM (VALUES {_NOTICES}) AS t(template, text)),
parts AS MATERIALIZED (
  SELECT DISTINCT template, array_to_string(w[i + 1:i + 5], ' ') AS shingle
  FROM (SELECT template, w, unnest(range(0, len(w) - 4)) AS i FROM notices)),
sizes AS (SELECT template, count(*) AS n FROM parts GROUP BY template),
spots AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 4)) AS i FROM texts)),
hits AS (
  SELECT doc_id, template, n, i, shingle, unnest([i // n, i // n - 1]) AS region
  FROM spots JOIN parts USING (shingle) JOIN sizes USING (template)),
regions AS (
  SELECT doc_id, template, region, count(DISTINCT shingle) / any_value(n) AS containment, min(i) AS first_word
  FROM hits WHERE region >= 0 GROUP BY ALL)
SELECT doc_id, template, max(containment) AS containment, arg_min(first_word, (-containment, first_word)) AS first_word
FROM regions WHERE containment >= 0.75 GROUP BY doc_id, template
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE byte AS (  -- the table of the checksum, from its rule
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1
                THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS t
  FROM range(256) AS r(b)),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n, length(run) AS len
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'),
                                                 '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
sums AS MATERIALIZED (
  SELECT doc_id, run, n, len, xor(list_reduce(
    flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128
            THEN [unicode(x)::BIGINT] ELSE [(192 + unicode(x) // 64)::BIGINT, (128 + unicode(x) % 64)::BIGINT] END)),
    lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM runs, byte),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, h % len) || substr(run, h % len + 2) ELSE run END AS word FROM sums)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS MATERIALIZED (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
pairs AS MATERIALIZED (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS MATERIALIZED (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
         CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain(word, head) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.head WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.head AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms last ON last.word = c.head AND last.form IS NULL
""",
}
