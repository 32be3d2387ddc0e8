"""The same results in SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (
    SELECT item_id, w, least(13, len(w)) AS n,
           unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
    FROM item WHERE len(w) > 0
  )
), spot AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (
    SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
    FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n
  )
), found AS (
  SELECT doc_id, i, n, item_id FROM spot JOIN win USING (n, win)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY 1
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP6 = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM doc WHERE len(w) > 0)
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM shared JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)
), way AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT a AS doc_id, b AS node FROM way
  UNION
  SELECT reach.doc_id, way.b FROM reach JOIN way ON reach.node = way.a
), least AS (
  SELECT doc_id, min(node) AS node FROM reach GROUP BY 1
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(node, doc_id)) AS component_id
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)
"""

OP4 = """
WITH page AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digest AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM page
), best AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS largest FROM digest
), told AS (
  SELECT *, payload_bytes >= 1000 AND page_id < largest AS again FROM best
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN largest END AS refers_to
FROM told
"""

OP9 = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), word AS (
  SELECT doc_id, i, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS a
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM doc)
), one AS (
  SELECT c, count(*) AS n FROM word GROUP BY 1
), two AS (
  SELECT b, c, count(*) AS n FROM word WHERE i > 1 GROUP BY 1, 2
), three AS (
  SELECT a, b, c, count(*) AS n FROM word WHERE i > 2 GROUP BY 1, 2, 3
), scored AS (
  SELECT doc_id, CASE
    WHEN i > 2 THEN ln(CAST(three.n AS DOUBLE) / before_three.n)
    WHEN i > 1 THEN ln(CAST(two.n AS DOUBLE) / before_two.n)
    ELSE ln(CAST(one.n AS DOUBLE) / (SELECT count(*) FROM word))
  END AS s
  FROM word JOIN one ON one.c = word.c
  LEFT JOIN two ON two.b = word.b AND two.c = word.c LEFT JOIN one before_two ON before_two.c = word.b
  LEFT JOIN three ON three.a = word.a AND three.b = word.b AND three.c = word.c
  LEFT JOIN two before_three ON before_three.b = word.a AND before_three.c = word.b
), total AS (
  SELECT doc_id, count(*) AS n_words, sum(s) AS s FROM scored GROUP BY 1
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(s, 0), 4) AS log_score
FROM doc LEFT JOIN total USING (doc_id)
"""

# CRC-32 over the bytes of a text ``s``: the table of the reflected polynomial, then a step per byte.
_CRC_TABLE = """
SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, _:
  CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) ORDER BY i) AS t
FROM (SELECT unnest(range(256))::UBIGINT AS i)
"""


def _crc(s: str) -> str:
    data = f"list_transform(regexp_extract_all(hex({s}), '..'), lambda x: ('0x' || x)::UBIGINT)"
    step = "xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {data}), lambda a, b: {step}), 4294967295::UBIGINT)"


OP11 = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), run AS (
  SELECT doc_id, r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents)
  WHERE length(r) >= 7 GROUP BY 1, 2
), summed AS (
  SELECT r, n, ({_crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r")})::BIGINT AS h FROM run, crc
), word AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word,
         sum(n)::BIGINT AS n
  FROM summed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d
  FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM word)
), pair AS (
  SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.i = y.i AND x.d = y.d AND x.word <> y.word
  UNION
  SELECT cut.word, word.word FROM cut JOIN word ON cut.d = word.word
  UNION
  SELECT word.word, cut.word FROM cut JOIN word ON cut.d = word.word
), ranked AS (
  SELECT a, b, word.n AS m, count(*) OVER (PARTITION BY a) AS n_near,
         row_number() OVER (PARTITION BY a ORDER BY word.n DESC, b COLLATE "C") AS place
  FROM pair JOIN word ON word.word = b
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN m >= 10 * n THEN b END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM word LEFT JOIN ranked ON a = word AND place = 1
), way AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT way.word, formed.form FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NOT NULL
)
SELECT formed.word, formed.form, way.root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN way ON way.word = formed.word
JOIN formed ended ON ended.word = way.root AND ended.form IS NULL
"""

OP13 = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), own AS (
  SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, r, x) AS turns
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations)
  WHERE conv_id IS NOT NULL GROUP BY 1
), begun AS (
  SELECT o.conv_id, o.turns, b.turns AS taken, ({_crc("CAST(o.conv_id AS VARCHAR)")} % 9)::BIGINT AS h
  FROM crc, own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), rebuilt AS (
  SELECT conv_id, list_concat(coalesce(taken[1:h], []), turns[h + 1:]) AS s FROM begun
), prefix AS (
  SELECT conv_id, d, len(s) AS many, md5(CAST(s[1:d] AS VARCHAR)) AS own,
         CASE WHEN d > 0 THEN md5(CAST(s[1:d - 1] AS VARCHAR)) END AS above,
         CASE WHEN d > 0 THEN strlen(s[d].x) ELSE 0 END AS bytes
  FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT own, d, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (many = d), '')) AS ends
  FROM prefix GROUP BY 1, 2
), child AS (
  SELECT above, d - 1 AS d, count(*) AS n FROM node WHERE above IS NOT NULL GROUP BY 1, 2
), up AS (
  SELECT own, d, own AS top, d AS top_d FROM node
  UNION ALL
  SELECT up.own, up.d, node.above, node.d - 1 FROM up JOIN node ON node.own = up.top AND node.d = up.top_d WHERE node.d > 0
), under AS (
  SELECT top, top_d, count(*) FILTER (child.n IS NULL) AS leaves, sum((node.n_convs - 1) * node.bytes)::BIGINT AS saved
  FROM up JOIN node USING (own, d) LEFT JOIN child ON child.above = own AND child.d = up.d GROUP BY 1, 2
)
SELECT node.conv_id, node.d AS depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(child.n, 0) AS n_children,
       under.leaves AS n_leaves, under.saved AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN under ON under.top = node.own AND under.top_d = node.d
LEFT JOIN node parent ON parent.own = node.above AND parent.d = node.d - 1
LEFT JOIN child ON child.above = node.own AND child.d = node.d
"""
