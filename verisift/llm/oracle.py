"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 8)),
twin AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
cov AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twin) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(l) AS BIGINT) AS n_lines,
         length(t) - length(regexp_replace(t, '\p{L}', '', 'g')) AS n_letters,
         length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id),
r AS (
  SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
    + 4 * (10 * n_symbols > n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
    + 16 * (2 * n_upper > n_letters)::INT
    + 32 * (word_chars < 2 * n_words OR word_chars > 25 * n_words)::INT AS BIGINT) AS failure_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failure_bits & 3) <> 0 AS base_failed, failure_bits = 0 AS kept, failure_bits FROM r
"""

OP2 = r"""
WITH d AS (
  SELECT doc_id, source, md5(concat_ws('/', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS pos,
         CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size
  FROM documents),
c AS (SELECT *, greatest(length(bin(size)) - 4, 0) AS shift FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY shift * 16 + (size >> CAST(shift AS BIGINT)), pos) AS rank FROM c),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight,
             row_number() OVER (ORDER BY source NULLS LAST) AS place, sum(source_size) OVER () AS whole FROM s),
k AS (SELECT *, coalesce(sum(2 * source_size) OVER o, 0) AS cap_before,
             sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS weight_left
      FROM w WINDOW o AS (ORDER BY 2 * source_size / CAST(weight AS DOUBLE), place
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 3 * whole - 2 * cap_before AS remaining,
             2 * source_size * 2 * weight_left <= weight * (3 * whole - 2 * cap_before) AS stops FROM k),
g AS (SELECT *, max(CASE WHEN NOT stops THEN {'a': CAST(weight_left AS BIGINT), 'b': CAST(remaining AS BIGINT)} END) OVER () AS free FROM f),
t AS (SELECT source, source_size,
             CASE WHEN stops THEN CAST(2 * source_size AS DOUBLE)
                  ELSE CAST(weight * free.b AS DOUBLE) / CAST(2 * free.a AS DOUBLE) END AS target,
             CAST(CAST('0x' || substr(md5('mix-1:' || coalesce('s' || source, '-')), 1, 8) AS BIGINT) AS DOUBLE)
               / 4294967296.0::DOUBLE AS u FROM g),
x AS (SELECT r.doc_id, r.size, t.source_size, t.target,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate, u, rank
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(floor(rank * rate + u) - floor((rank - 1) * rate + u) AS BIGINT) AS copies,
       CAST(floor(rank * rate + u) - floor((rank - 1) * rate + u) AS BIGINT) * size AS taken FROM x
"""

OP5 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM p) WHERE place <= 20
"""

OP9 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
e AS MATERIALIZED (SELECT x, y FROM p UNION SELECT y, x FROM p),
reach(x, y) AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
c AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(c.y, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(c.y, d.doc_id)) AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.x
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (SELECT doc_id, i, hash(array_to_string(list_slice(w, i, i + 34), ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) > 34)),
twin AS MATERIALIZED (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY h) > 1),
span AS (SELECT doc_id, i, greatest(i, coalesce(max(i + 35) OVER (PARTITION BY doc_id ORDER BY i
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS a, i + 35 AS b FROM twin),
gone AS (SELECT doc_id, list(p) AS ps FROM (SELECT doc_id, unnest(range(a, b)) AS p FROM span) GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n, coalesce(len(ps), 0) AS m,
             array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_transform(list_filter(
               list_zip(w, range(1, len(w) + 1)), lambda z: NOT list_contains(ps, z[2])), lambda z: z[1]) END, ' ') AS t
      FROM d LEFT JOIN gone ON d.doc_id = gone.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(m AS BIGINT) AS n_removed, sha256(t) AS kept_sha256 FROM k
"""

# crc32 of the decimal id, bit by bit over its bytes
OP11 = r"""
WITH ids AS (
  SELECT DISTINCT conv_id,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
               lambda x, z: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))), CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations),
r AS (SELECT ids.conv_id, t.role, t.text, 0 AS own, t.i FROM ids JOIN t ON t.conv_id = ids.conv_id - ids.conv_id % 20 AND t.i <= h
      UNION ALL SELECT ids.conv_id, t.role, t.text, 1, t.i FROM ids JOIN t ON t.conv_id = ids.conv_id AND t.i > h),
s AS (SELECT ids.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY own, i) FILTER (role IS NOT NULL), []) AS turns
      FROM ids LEFT JOIN r ON ids.conv_id = r.conv_id GROUP BY ids.conv_id),
p AS MATERIALIZED (
  SELECT conv_id, depth, len(turns) AS turns, sha256(CAST(to_json(list_slice(turns, 1, depth)) AS VARCHAR)) AS node,
         CASE WHEN depth > 0 THEN sha256(CAST(to_json(list_slice(turns, 1, depth - 1)) AS VARCHAR)) END AS parent,
         CASE WHEN depth > 0 THEN len(list_filter(string_split_regex(turns[depth].text, '[\x20\x09-\x0D]+'), lambda x: x <> ''))
              ELSE 0 END AS words
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM s)),
n AS MATERIALIZED (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (turns = depth), '')) AS ends_sha256
  FROM p GROUP BY node, depth),
k AS MATERIALIZED (SELECT n.*, coalesce(c.n, 0) AS n_children FROM n LEFT JOIN
      (SELECT parent, count(*) AS n FROM n GROUP BY parent) c ON c.parent = n.node),
below AS (SELECT a.node, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved
          FROM (SELECT DISTINCT x.node, y.node AS under FROM p x JOIN p y ON x.conv_id = y.conv_id AND x.depth <= y.depth) a
          JOIN k b ON b.node = a.under GROUP BY a.node)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(k.n_convs AS BIGINT) AS n_convs,
       CAST(k.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN below ON below.node = k.node LEFT JOIN n u ON u.node = k.parent
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
own AS MATERIALIZED (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS MATERIALIZED (
  SELECT doc_id, i, own.n AS n, item_id FROM own JOIN win ON own.s = win.s AND own.n = win.n),
cov AS (SELECT doc_id, count(DISTINCT p) AS m FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS k, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(m, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(k, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(m, 0) > 0 AS contaminated
FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""

ORACLE_SQL: dict[str, str] = {"op1_quality_rules": OP1, "op2_source_mix": OP2, "op5_topk_search": OP5, "op9_minhash": OP9, "op10_substring_dedup": OP10, "op11_prefix_trie": OP11, "op12_decontaminate": OP12}
