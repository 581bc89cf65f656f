"""DuckDB SQL for the operators that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op7_exact_dedup"] = r"""
WITH clean AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id,
       min(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept,
       sha256(body) AS text_sha256
FROM clean WINDOW w AS (PARTITION BY body)
"""

ORACLES["op2_decontamination"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), item AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n,
         array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS line
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM item WHERE len(words) > 0)
), doc_window AS (
  SELECT doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') AS line
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(words) >= n)
), hit AS (
  SELECT doc_id, i, n, item_id FROM doc_window JOIN item_window USING (n, line)
), word AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES["op5_minhash_near_dedup"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM doc WHERE len(words) > 0)
), amount AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN amount m ON m.doc_id = a JOIN amount n ON n.doc_id = b
  WHERE 100 * n_both >= 80 * (m.n + n.n - n_both)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM doc
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.other = link.a
), smallest AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM doc JOIN smallest USING (doc_id) LEFT JOIN amount USING (doc_id)
"""

ORACLES["op8_warc"] = r"""
WITH page AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), ranked AS (
  SELECT page_id, h, strlen(body) AS payload_bytes, max(page_id) OVER (PARTITION BY body) AS response FROM page
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i: list_reduce(list_transform([15, 10, 5, 0],
         lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(h, (5 * i + 1)::INT, 5))::BIGINT >> k) & 31) + 1)::INT, 1)),
         lambda a, b: a || b)), '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM ranked
"""

ORACLES["op9_suffix_family"] = r"""
WITH doc AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), piece AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
  FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM doc WHERE n >= 50)
), hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS m FROM piece) WHERE m < doc_id
), mark AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true)::INT AS fresh FROM hit
), run AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM mark
), span AS (
  SELECT doc_id, r, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY doc_id, r
), before AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS p FROM span
), cut AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM before JOIN doc USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM doc LEFT JOIN cut USING (doc_id)
"""

# crc32 of a decimal number, byte by byte and bit by bit; 3988292384 is the standard's reversed polynomial.
_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

ORACLES["op11_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), every AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC.format(text="conv_id::VARCHAR")} % 6 AS h FROM own GROUP BY conv_id
), taken AS (
  SELECT e.conv_id, 0 AS half, o.pos, o.role, o.text FROM every e JOIN own o ON o.conv_id = e.base AND o.pos < e.h
  UNION ALL
  SELECT e.conv_id, 1, o.pos, o.role, o.text FROM every e JOIN own o ON o.conv_id = e.conv_id AND o.pos >= e.h
), placed AS (
  SELECT conv_id, row_number() OVER w AS depth, count(*) OVER (PARTITION BY conv_id) AS n, length(text) AS chars,
         sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, '')
           OVER (PARTITION BY conv_id ORDER BY half, pos ROWS UNBOUNDED PRECEDING)) AS node
  FROM taken WINDOW w AS (PARTITION BY conv_id ORDER BY half, pos)
), member AS (
  SELECT conv_id, depth, n, chars, node FROM placed
  UNION ALL
  SELECT e.conv_id, 0, coalesce(max(p.n), 0), 0, '' FROM every e LEFT JOIN placed p USING (conv_id) GROUP BY e.conv_id
), node AS (
  SELECT node, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM member GROUP BY node
), linked AS (
  SELECT n.*, p.node AS parent, up.conv_id AS parent_conv_id
  FROM node n LEFT JOIN member p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN node up ON up.node = p.node
), child AS (
  SELECT parent AS node, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent
), total AS (
  SELECT above.node, sum((c.n_children IS NULL)::BIGINT) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM node n LEFT JOIN child c USING (node) JOIN member above ON above.conv_id = n.conv_id AND above.depth <= n.depth
  GROUP BY above.node
)
SELECT l.conv_id, l.depth::BIGINT AS depth, l.parent_conv_id, l.n_convs, coalesce(c.n_children, 0) AS n_children,
       t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, l.ends_sha256
FROM linked l JOIN total t ON t.node = l.node LEFT JOIN child c ON c.node = l.node
"""
