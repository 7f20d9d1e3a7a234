"""SQL for DuckDB of the corpus queries that SQL can say."""

ORACLES: dict[str, str] = {}

ORACLES["op6_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), groups AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM texts JOIN groups USING (text_sha256)
"""

ORACLES["op7_top_products"] = r"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::double))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::bigint AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLES["op2_near_dedup"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(list_transform(
    range(1, greatest(len(words) - 3, least(len(words), 1) + 1)),
    lambda i: array_to_string(words[i : i + 4], ' '))) AS shingles
  FROM texts
), sizes AS (
  SELECT doc_id, len(shingles) AS n FROM sets
), shingled AS (
  SELECT doc_id, unnest(shingles) AS shingle FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reached.a, both_ways.b FROM reached JOIN both_ways ON both_ways.a = reached.b
), smallest AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN smallest USING (doc_id)
"""

ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), phrases AS (
  SELECT lang, unnest(flatten([
    list_transform(range(1, len(w) + 1), lambda i: w[i : i]),
    list_transform(range(1, len(w)), lambda i: w[i : i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2])])) AS p
  FROM worded
), counted AS (
  SELECT lang, p, count(*)::hugeint AS f FROM phrases GROUP BY lang, p
), totals AS (
  SELECT lang, sum(f) AS n FROM counted WHERE len(p) = 1 GROUP BY lang
), candidates AS (
  SELECT lang, p, f AS a FROM counted WHERE len(p) > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r, (1000000 * c.a * c.a) // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
  JOIN counted x ON x.lang = c.lang AND x.p = c.p[1 : k]
  JOIN counted y ON y.lang = c.lang AND y.p = c.p[k + 1 :]
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), covering AS (
  SELECT lang, p, max(a) AS longer FROM (
    SELECT lang, p[1 : 2] AS p, a FROM candidates WHERE len(p) = 3
    UNION ALL SELECT lang, p[2 : 3], a FROM candidates WHERE len(p) = 3
  ) GROUP BY lang, p
), ranked AS (
  SELECT w.lang, array_to_string(w.p, ' ') AS phrase, w.a, w.l, w.r, w.score,
    row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, array_to_string(w.p, ' ')) AS rank
  FROM weakest w LEFT JOIN covering c ON c.lang = w.lang AND c.p = w.p
  WHERE c.longer IS NULL OR 100 * c.longer < 50 * w.a
)
SELECT lang, rank::bigint AS rank, phrase, a::bigint AS a, l::bigint AS l, r::bigint AS r, n::bigint AS n, score::bigint AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

# CRC-32 by its table, which is made here from the reversed polynomial; runs have code points below 256.
ORACLES["op13_variants"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda v: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v::bigint)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents
), per_document AS (
  SELECT doc_id, run, count(*) AS times FROM runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(flatten(list_transform(
      string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::bigint] ELSE [195::bigint, unicode(c)::bigint - 64] END)),
    lambda crc, b: xor(crc >> 8, t[xor(crc & 255, b) + 1]), 4294967295::bigint)) AS h
  FROM per_document, crc_table
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, sum(times)::bigint AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND n >= 3
), holed AS (
  SELECT word, n, i, word[: i - 1] AS head, word[i + 1 :] AS tail FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n
  FROM holed a JOIN holed b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holed a JOIN words b ON b.word = a.head || a.tail
  UNION SELECT b.word, a.word, a.n FROM holed a JOIN words b ON b.word = a.head || a.tail
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
), ends AS (
  SELECT c.word, c.root FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

ORACLES["op3_secrets"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), kinds(kind, name, pattern, least) AS (
  VALUES
    (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 12),
    (1, 'access', '(AKIA)([A-Z0-9]{14,})', 0),
    (2, 'hex', '([0-9a-f]{16})([0-9a-f]*)', 0),
    (3, 'entropy', '([A-Za-z0-9+/_-]{20,})(={0,2})', 0)
), found AS (
  SELECT row_number() OVER () AS row, doc_id, k.kind, k.name, k.least,
    list_transform(string_split_regex(t, k.pattern), lambda x: length(x)) AS gaps,
    regexp_extract_all(t, k.pattern, 0) AS matches, regexp_extract_all(t, k.pattern, 2) AS parts
  FROM texts, kinds k
), spans AS (
  SELECT doc_id, row, kind, name, match, length(part) >= least AS long_enough,
    list_sum(gaps[1 : i]) + coalesce(list_sum(list_transform(matches[1 : i - 1], lambda x: length(x))), 0) AS first, length(match) AS n
  FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i, unnest(matches) AS match, unnest(parts) AS part FROM found)
), base AS (
  SELECT doc_id, kind, name, first, first + n AS stop FROM spans WHERE kind < 3 AND long_enough
), apart AS (
  SELECT * FROM spans s WHERE kind = 3
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = s.doc_id AND b.first < s.first + s.n AND s.first < b.stop)
    AND NOT regexp_full_match(match, '[0-9]+|[+/_=-]+|[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[0-9]{4}-[0-9]{2}-[0-9]{2}[0-9_-]*')
    AND NOT regexp_matches(match, '(?i)example|placeholder|changeme|dummy|your_|xxxx|abcdefgh|01234567')
), windows AS (
  SELECT doc_id, row, first, n, match, list_max(list_transform(range(1, n - 18),
    lambda i: list_aggregate(string_split(match[i : i + 19], ''), 'entropy'))) AS bits
  FROM apart
), extra AS (
  SELECT doc_id, 3 AS kind, 'entropy' AS name, first, first + n AS stop FROM windows
  WHERE bits >= CASE WHEN regexp_full_match(match, '[0-9a-f]+') THEN 2.9
    WHEN regexp_full_match(match, '[a-z]+|[A-Z]+|[A-Z]?[a-z]+') THEN 4.25
    WHEN regexp_full_match(match, '[A-Za-z0-9]+=*') THEN 3.6 ELSE 3.8 END
), of_base AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(name || ':' || first || ':' || stop, ',' ORDER BY first, kind) AS shown
  FROM base GROUP BY doc_id
), of_all AS (
  SELECT doc_id, string_agg(name || ':' || first || ':' || stop, ',' ORDER BY first, kind) AS spans
  FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(shown, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN of_base USING (doc_id) LEFT JOIN of_all USING (doc_id)
"""
