"""DuckDB SQL for the queries that SQL can express, independent of their code."""

#: Operator 2. The pieces that a pattern splits a text into give the places of
#: its matches. RE2 folds case beyond ASCII, so letters are spelled out.
_ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_KINDS = (
    ("assign", _ASSIGN, f"length(regexp_extract(s, '{_ASSIGN}', 2)) >= 8"),
    ("access", "AKIA[A-Z0-9]+", "length(s) >= 16"),
    ("hex", "[0-9a-f]+", "length(s) >= 32"),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"),
    ("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", "true"),
    ("prefixed", "(?:ghp|gho|ghs|ghu|ghr|glpat|xoxb|xoxp|sk_live)[_-][A-Za-z0-9_-]+", "length(s) >= 20"),
)
_MATCHES = " UNION ALL ".join(
    f"""SELECT doc_id, '{kind}' AS kind, {k} AS k, a, a + length(s) AS b FROM (
      SELECT doc_id, m[i] AS s, list_sum(list_transform(p[:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS a
      FROM (SELECT doc_id, m, p, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM texts)))
    WHERE {holds}"""
    for k, (kind, pattern, holds) in enumerate(_KINDS)
)
SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_MATCHES}),
joined AS (
  SELECT doc_id,
    count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(concat(kind, ':', CAST(a AS BIGINT), ':', CAST(b AS BIGINT)), ',' ORDER BY a, k) FILTER (k < 3) AS base,
    string_agg(concat(kind, ':', CAST(a AS BIGINT), ':', CAST(b AS BIGINT)), ',' ORDER BY a, k) AS spans
  FROM found GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN joined j ON j.doc_id = t.doc_id
"""

#: Operator 3: all pairs of documents that share a shingle, and what they reach.
NEAR_DUPLICATES = """
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM worded
), sizes AS (
  SELECT doc_id, count(s) AS n FROM worded LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), links AS (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s)
    WHERE a.doc_id <> b.doc_id GROUP BY 1, 2) p
  JOIN sizes nx ON nx.doc_id = x JOIN sizes ny ON ny.doc_id = y
  WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), reached AS (
  SELECT doc_id AS origin, doc_id AS seen FROM sizes
  UNION
  SELECT origin, y FROM reached JOIN links ON x = seen
)
SELECT s.doc_id, n AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sizes s JOIN (SELECT origin, min(seen) AS component_id FROM reached GROUP BY origin) r ON r.origin = s.doc_id
"""

#: Operator 4: every query against every row.
NEAREST = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
    list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v))) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

#: Operator 10. A side's turns after the common prefix are rendered with
#: running lengths, by joins and windows over single turns.
PREFERENCES = """
WITH turns AS (
  SELECT conv_id AS id, role, text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations) WHERE conv_id IS NOT NULL
), ends AS (
  SELECT id, coalesce(max(i) FILTER (role = 'assistant'), 0) AS last FROM turns GROUP BY id
), chosen AS (
  SELECT t.* FROM turns t JOIN ends e USING (id) WHERE last = 0 OR i <= last
), rejected AS (
  SELECT t.* FROM turns t JOIN ends e USING (id) WHERE last = 0 OR i < last
  UNION ALL
  SELECT e.id, o.role, o.text, e.last FROM ends e JOIN ends f ON f.id = xor(e.id, 1) JOIN turns o ON o.id = f.id AND o.i = f.last
  WHERE e.last > 0
), apart AS (
  SELECT coalesce(c.id, r.id) AS id, min(coalesce(c.i, r.i)) AS parted FROM chosen c FULL JOIN rejected r ON c.id = r.id AND c.i = r.i
  WHERE c.id IS NULL OR r.id IS NULL OR c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text GROUP BY 1
), sides AS (
  SELECT e.id, s.side, s.i, s.role, coalesce(a.parted, 2147483647) AS parted,
    concat('<|im_start|>', coalesce(s.role, 'unknown'), chr(10)) AS head,
    concat(replace(coalesce(s.text, ''), '<|', '< |'), '<|im_end|>') AS body
  FROM ends e
  JOIN (SELECT *, 'c' AS side FROM chosen UNION ALL SELECT *, 'r' AS side FROM rejected) s ON s.id = e.id
  LEFT JOIN apart a ON a.id = e.id
), placed AS (
  SELECT *, length(head) + coalesce(sum(length(head) + length(body) + 1) OVER (
    PARTITION BY id, side, i >= parted ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM sides
), joined AS (
  SELECT id, side, count(*) FILTER (i < parted) AS n,
    string_agg(concat(head, body, chr(10)), '' ORDER BY i) FILTER (i < parted) AS prompt,
    string_agg(concat(head, body, chr(10)), '' ORDER BY i) FILTER (i >= parted) AS rest,
    string_agg(concat(CAST(begins AS BIGINT), ':', CAST(begins + length(body) AS BIGINT)), ',' ORDER BY i)
      FILTER (i >= parted AND role = 'assistant') AS spans
  FROM placed GROUP BY id, side
)
SELECT e.id AS pair_id, coalesce(c.n, 0) AS prefix_turns, coalesce(c.prompt, '') AS prompt, coalesce(c.rest, '') AS chosen,
  coalesce(r.rest, '') AS rejected, coalesce(c.spans, '') AS chosen_spans, coalesce(r.spans, '') AS rejected_spans
FROM ends e LEFT JOIN joined c ON c.id = e.id AND c.side = 'c' LEFT JOIN joined r ON r.id = e.id AND r.side = 'r'
"""

#: Operator 11. CRC-32 by its table, made from the polynomial; near words by
#: the strings that are left when one letter is deleted.
_CRC_TABLE = """
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
"""
SPELLING = """
WITH crc AS (""" + _CRC_TABLE + """), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) AS run FROM documents)
  GROUP BY 1, 2
), sums AS (
  SELECT run, n, xor(list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END))),
    lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc
), spelt AS (
  SELECT CASE WHEN h % 97 = 0 THEN concat(left(run, CAST(h % length(run) AS INTEGER)), substr(run, CAST(h % length(run) AS INTEGER) + 2))
    ELSE run END AS word, n FROM sums
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
  SELECT word, n, i, concat(left(word, i - 1), substr(word, i + 1)) AS rest
  FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word
), found AS (
  SELECT w.word, CASE WHEN other_n >= 2 * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), ways AS (
  WITH RECURSIVE way AS (
    SELECT word, word AS reached, 0 AS steps FROM found
    UNION ALL
    SELECT way.word, f.form, steps + 1 FROM way JOIN found f ON f.word = way.reached WHERE f.form IS NOT NULL
  )
  SELECT word, first(reached ORDER BY steps DESC) AS root FROM way GROUP BY word
)
SELECT f.word, form, root, n, n_near, form_n FROM found f JOIN ways w ON w.word = f.word
"""

#: Operator 12: all scores as sums of products.
HARD_NEGATIVES = """
WITH used AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])), 0) AS BIGINT) AS score
  FROM used a JOIN used b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)
), positives AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, p
  FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS p FROM scored WHERE same) WHERE p <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.r, p.p ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.r = p.r AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
WHERE rank <= 10
"""

#: Operator 13: lines by position, put together again.
LINES = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT r, doc_id, i, parts[i] AS line,
    translate(trim(parts[i], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM texts)
), common AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), kept AS (
  SELECT r, l.doc_id, i, line, c.key IS NOT NULL AND l.doc_id <> keeper AS lost FROM lines l LEFT JOIN common c ON c.key = l.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM kept GROUP BY r, doc_id
"""

#: Operator 5, base columns: places in 3-word windows that are found twice.
QUALITY_COUNTS = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), worded AS (
  SELECT r, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM texts
), windows AS (
  SELECT r, i, w[i:i + 2] AS three FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM worded WHERE len(w) >= 3)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM worded LEFT JOIN repeated USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
"""

#: Operator 6, base columns: word counts of the training documents.
UNIGRAM_SCORES = """
WITH crc AS (""" + _CRC_TABLE + """), texts AS (
  SELECT row_number() OVER () AS r, doc_id, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CAST(unicode(c) AS BIGINT))),
      lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) % 5 = 1 AS held_out,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
      lambda w: w <> '') AS w
  FROM documents, crc
), tokens AS (
  SELECT r, held_out, unnest(w) AS word, 0 AS is_end FROM texts UNION ALL SELECT r, held_out, '', 1 FROM texts
), counts AS (
  SELECT word, is_end, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY word, is_end
), sums AS (
  SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n, count(*) AS v FROM counts
), scored AS (
  SELECT r, count(*) AS n_tokens, count(c) AS n_known, sum(log10((coalesce(c, 0) + 0.5) / (s.n + 0.5 * (s.v + 1)))) AS base
  FROM tokens t LEFT JOIN counts k ON k.word = t.word AND k.is_end = t.is_end CROSS JOIN sums s GROUP BY r
)
SELECT doc_id, held_out, n_tokens, n_known, (SELECT n FROM sums) AS train_tokens, round(base, 6) AS base_score
FROM texts JOIN scored USING (r)
"""

#: Operator 7, targets: sources that reach their cap are set aside, the rest
#: is shared out again, until none does.
MIX_TARGETS = """
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))) AS BIGINT) AS source_size,
    count(*) AS docs
  FROM documents GROUP BY source
), weighed AS (
  SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS k FROM sizes
), rounds AS (
  SELECT 0 AS round, CAST([] AS BIGINT[]) AS full_ones
  UNION ALL
  SELECT round + 1, list_concat(full_ones, over) FROM (
    SELECT r.round, r.full_ones, (
      SELECT coalesce(list(w.k), []) FROM weighed w WHERE NOT list_contains(r.full_ones, w.k)
        AND w.weight * (
          (SELECT 1.5 * sum(source_size) FROM weighed) - (SELECT coalesce(sum(2.0 * f.source_size), 0) FROM weighed f WHERE list_contains(r.full_ones, f.k)))
          / (SELECT sum(o.weight) FROM weighed o WHERE NOT list_contains(r.full_ones, o.k)) >= 2.0 * w.source_size) AS over
    FROM rounds r) WHERE len(over) > 0
), ended AS (
  SELECT full_ones FROM rounds ORDER BY round DESC LIMIT 1
), rest AS (
  SELECT 1.5 * sum(source_size) - coalesce(sum(2.0 * source_size) FILTER (list_contains(full_ones, k)), 0) AS left_over,
    sum(weight) FILTER (NOT list_contains(full_ones, k)) AS weights
  FROM weighed, ended
)
SELECT source, source_size, docs, round(CAST(CASE WHEN list_contains(full_ones, k) THEN 2.0 * source_size ELSE weight * left_over / weights END AS DOUBLE), 3) AS target
FROM weighed, ended, rest
"""
