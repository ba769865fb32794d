"""DuckDB counterparts of the queries, where SQL can express them."""

OP1 = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM t
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ASC NULLS LAST)
"""

OP3 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
places AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
),
firsts AS (SELECT x, min(doc_id) AS first_id FROM places GROUP BY x),
removed AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM places JOIN firsts USING (x) WHERE first_id < doc_id
),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept_text, count(*) AS n_kept
  FROM words ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
wide AS (SELECT item, w, least(len(w), 13) AS k FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS x
  FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM wide)
),
places AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS x
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM windows))
),
found AS (SELECT doc_id, item, i, p.k FROM places p JOIN windows USING (k, x)),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS word FROM found) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items,
         array_to_string(list_sort(list(DISTINCT item)), ',') AS names
  FROM found GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: All pairs that share a shingle; classes by spreading the ids along the links.
OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 5 * n_both >= 4 * (p.n + q.n - n_both)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
class AS (SELECT a AS doc_id, min(b) AS class_id, count(*) AS class_size FROM reach GROUP BY a),
counts AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, class_id, class_size, coalesce(n_links, 0) AS n_links
FROM class LEFT JOIN counts USING (doc_id)
"""

OP9 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, strlen(html) AS payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER,
           1)), '') AS payload_digest
  FROM p
),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

#: All pairs in double precision; components by spreading the least id along the links.
OP12 = r"""
WITH RECURSIVE e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
),
u AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS norm FROM e),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
    ON a.vec_id <> b.vec_id AND list_inner_product(a.v, b.v) >= 0.9 * a.norm * b.norm
),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

OP13 = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    text,
    xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                       lambda c: ascii(c)::BIGINT)),
      lambda c, b: list_reduce(
        list_concat([xor(c, b)], range(8)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 3 = 0 AS altered
  FROM documents
),
leaves AS (
  SELECT doc_id, lang, altered,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || translate(
      text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered
  FROM f
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
),
nodes AS (
  SELECT 0 AS level, lang, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT level + 1, lang, pos // 8,
         CAST(ceil(max(n) / 8) AS BIGINT), sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, lang, pos // 8
),
subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
),
upper_nodes AS (
  SELECT 0 AS level, pos, n, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, CAST(ceil(max(n) / 8) AS BIGINT), sha256(string_agg(h, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 8
),
steps AS (
  SELECT a.level, a.lang, a.pos,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b
    ON a.level = b.level AND a.lang IS NOT DISTINCT FROM b.lang AND a.pos // 8 = b.pos // 8
  WHERE a.n > 1 GROUP BY a.level, a.lang, a.pos
),
upper_steps AS (
  SELECT a.level, a.pos,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM upper_nodes a JOIN upper_nodes b ON a.level = b.level AND a.pos // 8 = b.pos // 8
  WHERE a.n > 1 GROUP BY a.level, a.pos
),
climb AS (
  SELECT doc_id, lang, 0 AS level, pos, CASE WHEN altered THEN lowered ELSE leaf END AS h, '' AS s
  FROM placed
  UNION ALL
  SELECT doc_id, c.lang, c.level + 1, c.pos // 8, sha256(l || c.h || r), c.s || l || r
  FROM climb c JOIN steps
    ON c.level = steps.level AND c.lang IS NOT DISTINCT FROM steps.lang AND c.pos = steps.pos
),
tops AS (
  SELECT doc_id, lang, h, s FROM climb
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1
),
upper_climb AS (
  SELECT doc_id, 0 AS level, r.pos, t.h, t.s FROM tops t JOIN subroots r ON t.lang IS NOT DISTINCT FROM r.lang
  UNION ALL
  SELECT doc_id, c.level + 1, c.pos // 8, sha256(l || c.h || r), c.s || l || r
  FROM upper_climb c JOIN upper_steps u ON c.level = u.level AND c.pos = u.pos
),
ends AS (
  SELECT doc_id, h, s FROM upper_climb
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1
)
SELECT doc_id, leaf, r.h AS subroot, t.h AS root,
       sha256(s) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM ends e JOIN placed p USING (doc_id) JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
JOIN upper_nodes t ON t.n = 1
"""

ORACLE_SQL = {
    "op1_exact_dedup": OP1,
    "op3_substring_dedup": OP3,
    "op4_decontaminate": OP4,
    "op8_jaccard_join": OP8,
    "op9_warc": OP9,
    "op12_embed_dedup": OP12,
    "op13_merkle": OP13,
}
