"""DuckDB SQL of the queries that SQL can express (views: documents, pages, benchmark, ...)."""

from __future__ import annotations

OP1 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
     g AS (SELECT doc_id, unnest(range(1, len(words) - 11)) AS i, words FROM w WHERE len(words) >= 13),
     h AS (SELECT doc_id, i, list_slice(words, i, i + 12) AS win FROM g),
     f AS (SELECT win, min(doc_id) AS first_doc FROM h GROUP BY win HAVING count(*) > 1),
     r AS (SELECT DISTINCT h.doc_id, unnest(range(h.i, h.i + 13)) AS p FROM h JOIN f ON h.win = f.win WHERE f.first_doc < h.doc_id),
     k AS (SELECT doc_id, list(p) AS gone FROM r GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN words
              ELSE list_transform(list_filter(range(1, len(words) + 1), lambda x: NOT list_contains(gone, x)), lambda x: words[x]) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""

OP2 = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h FROM documents),
     g AS (SELECT doc_id, unnest(range(1, length(h) // 2 - 98)) AS i, h FROM d WHERE length(h) >= 200),
     s AS (SELECT doc_id, i, md5_number(h[2 * i - 1 : 2 * i + 198]) AS m FROM g),
     r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS k FROM s) WHERE k > 1),
     n AS (SELECT doc_id, i, CASE WHEN i > 100 + coalesce(max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1000) THEN 1 ELSE 0 END AS fresh FROM r),
     q AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM n),
     p AS (SELECT doc_id, span, min(i) AS a, max(i) + 100 AS z FROM q GROUP BY doc_id, span),
     k AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, list(a ORDER BY a) AS starts, list(z ORDER BY a) AS ends FROM p GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN starts IS NULL THEN h ELSE
              array_to_string(list_transform(range(1, len(starts) + 2), lambda x:
                substr(h, 2 * (CASE WHEN x = 1 THEN 1 ELSE ends[x - 1] END) - 1,
                       2 * ((CASE WHEN x = len(starts) + 1 THEN length(h) // 2 + 1 ELSE starts[x] END) - (CASE WHEN x = 1 THEN 1 ELSE ends[x - 1] END)))), '') END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP6 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
     s AS (SELECT DISTINCT doc_id, md5_number(array_to_string(list_slice(words, i, i + 3), ' ')) AS g
           FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
     e AS MATERIALIZED (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
     u AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
     t(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT t.doc_id, u.y FROM t JOIN u ON t.seen = u.x),
     m AS (SELECT doc_id, min(seen) AS component_id FROM t GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)
"""

OP6_LINKS = OP6[: OP6.index("     t(doc_id, seen)")].rstrip().rstrip(",") + """,
     k AS (SELECT x AS doc_id, count(*) AS n_links FROM u GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(k.n_links, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""

OP9 = r"""
WITH crc AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, range(0, 8 * length(doc_id::VARCHAR))),
               lambda a, k: xor(xor(a, CASE WHEN k % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, (k // 8 + 1)::BIGINT, 1))::BIGINT ELSE 0 END) >> 1,
                 (xor(a, CASE WHEN k % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, (k // 8 + 1)::BIGINT, 1))::BIGINT ELSE 0 END) & 1) * 3988292384)), 4294967295::BIGINT) % 10 = 0 AS held_out FROM documents),
     w AS (SELECT doc_id, held_out, list_append(list_prepend('<start>', regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')), ' end ') AS words FROM documents JOIN crc USING (doc_id)),
     t AS (SELECT doc_id, held_out, CASE WHEN i = 3 THEN ' start ' WHEN i > 3 THEN words[i - 2] END AS h2, CASE WHEN i = 2 THEN ' start ' ELSE words[i - 1] END AS h, words[i] AS w FROM (SELECT doc_id, held_out, words, unnest(range(2, len(words) + 1)) AS i FROM w)),
     u AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
     g AS (SELECT h, count(*) AS c FROM t WHERE NOT held_out GROUP BY h),
     b AS (SELECT h, w, count(*) AS c FROM t WHERE NOT held_out GROUP BY h, w),
     b3 AS (SELECT h2, h, w, count(*) AS c FROM t WHERE NOT held_out AND h2 IS NOT NULL GROUP BY h2, h, w),
     g2 AS (SELECT h2, h, sum(c) AS c FROM b3 GROUP BY h2, h),
     z AS (SELECT sum(c) AS n, count(*) AS v FROM u),
     p AS (SELECT t.doc_id, t.held_out, coalesce(u.c, 0) AS c, (coalesce(u.c, 0) + 0.1::DOUBLE) / (z.n + 0.1::DOUBLE * (z.v + 1)) AS p, coalesce(g.c, 0) AS ch, coalesce(b.c, 0) AS cb, coalesce(g2.c, 0)::BIGINT AS cg, coalesce(b3.c, 0) AS ct, z.n
           FROM t LEFT JOIN u ON t.w = u.w LEFT JOIN g ON t.h = g.h LEFT JOIN b ON t.h = b.h AND t.w = b.w
           LEFT JOIN g2 ON t.h2 = g2.h2 AND t.h = g2.h LEFT JOIN b3 ON t.h2 = b3.h2 AND t.h = b3.h AND t.w = b3.w CROSS JOIN z),
     q AS (SELECT *, CASE WHEN ch > 0 THEN (cb + 1000.0::DOUBLE * p) / (ch + 1000.0::DOUBLE) ELSE p END AS s FROM p)
SELECT doc_id, held_out, count(*)::BIGINT AS n_tokens, count(*) FILTER (c > 0)::BIGINT AS n_known, max(n)::BIGINT AS train_tokens,
       round(sum(log10(p)), 6) AS base_score, round(sum(log10(CASE WHEN cg > 0 THEN (ct + 3.0::DOUBLE * s) / (cg + 3.0::DOUBLE) ELSE s END)), 6) AS score
FROM q GROUP BY doc_id, held_out
"""

OP8 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
     b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
     p AS (SELECT DISTINCT item_id, least(10, len(words)) AS n, array_to_string(list_slice(words, i, i + 9), ' ') AS win
           FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
     z AS (SELECT DISTINCT n FROM p),
     w AS (SELECT doc_id, i, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS win
           FROM (SELECT doc_id, n, words, unnest(range(1, len(words) - n + 2)) AS i FROM d, z WHERE len(words) >= n)),
     h AS (SELECT w.doc_id, w.i, w.n, p.item_id FROM w JOIN p ON w.win = p.win AND w.n = p.n),
     k AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM h) GROUP BY doc_id),
     s AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN s USING (doc_id)
"""

OP10 = """
WITH said AS (SELECT *, printf('call_%d_%d', conv_id, turn) AS cid, turn % 8 AS k FROM conversations WHERE role = 'assistant'),
     calls AS (SELECT conv_id, turn, cid, text,
                 CASE WHEN k = 3 THEN to_json({'limit': '5', 'text': text}) WHEN k = 5 THEN to_json({'limit': 5}) ELSE to_json({'limit': turn, 'text': text}) END AS arguments,
                 CASE WHEN k = 7 THEN 'count_lines' ELSE 'count_words' END AS name, k NOT IN (3, 5, 7) AS valid FROM said),
     results AS (SELECT conv_id, turn - CASE WHEN conv_id % 2 = 1 THEN 1 ELSE 0 END AS turn, turn AS call_turn, CASE WHEN conv_id % 7 = 0 THEN 'lost' ELSE cid END AS call_id,
                   len(string_split(text, ' '))::VARCHAR AS content, conv_id % 7 <> 0 AS linked FROM said)
SELECT conv_id, turn, role, 'content' AS kind, NULL::VARCHAR AS call_id, 0::BIGINT AS n_calls, 0::BIGINT AS n_valid, false AS linked, turn AS order_turn, 0::BIGINT AS order_step, 0::BIGINT AS order_call,
       to_json({'content': text, 'role': role})::VARCHAR AS json FROM conversations WHERE role <> 'assistant'
UNION ALL
SELECT conv_id, turn, 'assistant', 'calls', NULL, 1, valid::BIGINT, false, turn, 0, 0,
       to_json({'content': text, 'role': 'assistant', 'tool_calls': [{'arguments': arguments, 'id': cid, 'name': name, 'valid': valid}]})::VARCHAR FROM calls
UNION ALL
SELECT conv_id, turn, 'tool', 'result', call_id, 0, 0, linked, CASE WHEN linked THEN call_turn ELSE turn END, linked::BIGINT, 0,
       to_json({'content': content, 'role': 'tool', 'tool_call_id': call_id})::VARCHAR FROM results
"""

OP11 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS code
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                  list_sum(list_transform(range(1, len(a.code) + 1), lambda i: a.code[i] * b.code[i]))::BIGINT AS score
           FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM (SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
      WHERE 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
WHERE rank <= 10
"""

OP12 = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
     n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
     g AS (SELECT lang, m, array_to_string(list_slice(words, i, i + m - 1), ' ') AS phrase
           FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(words) >= m)),
     f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY lang, m, phrase HAVING count(*) >= 30),
     c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
     k AS (SELECT lang, phrase, a, k, array_to_string(list_slice(ws, 1, k), ' ') AS x, array_to_string(list_slice(ws, k + 1, m), ' ') AS y
           FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
     z AS (SELECT k.lang, k.phrase, a, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f))::BIGINT AS score
           FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.x JOIN f y ON y.lang = k.lang AND y.phrase = k.y
           QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k) = 1),
     i AS (SELECT lang, array_to_string(list_slice(ws, j, j + b - 1), ' ') AS phrase, max(a) AS longer
           FROM (SELECT *, unnest(range(1, m - b + 2)) AS j FROM (SELECT *, unnest(range(2, m)) AS b FROM c WHERE m > 2)) GROUP BY ALL),
     q AS (SELECT z.*, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, encode(z.phrase)) AS rank
           FROM z LEFT JOIN i ON i.lang = z.lang AND i.phrase = z.phrase WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT q.lang, rank, phrase, a, l, r, n, score FROM q JOIN n ON n.lang = q.lang WHERE rank <= 2000
"""

OP13 = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     l AS (SELECT doc_id, i, lines[i] AS line, translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
     g AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT l.doc_id, count(*) AS n_lines, count(g.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (g.k IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN g ON g.k = l.k GROUP BY l.doc_id
"""
