"""The results of registered queries as DuckDB SQL, where SQL can express them."""

# The CRC-32 of an id: every digit is mixed in, followed by eight shifts.
MERKLE = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, lang, n_chars IS NOT NULL AS counted,
    list_reduce(flatten([[4294967295::BIGINT]] || list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                       WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384::BIGINT) ELSE crc >> 1 END) AS crc,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END AS f1,
    CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END AS f2,
    CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS f3,
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS f4,
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END AS f4_more,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS f5
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(f1 || f2 || f3 || f4 || f5) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN sha256(f1 || f2 || f3 || f4_more || f5) ELSE sha256(f1 || f2 || f3 || f4 || f5) END AS claimed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp
  FROM doc),
inner_tree AS (
  SELECT grp, 0 AS level, pos, n, leaf AS node FROM leaves
  UNION ALL
  SELECT grp, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM inner_tree
  WHERE n > 1 GROUP BY grp, level, pos // 2, n),
subroots AS (SELECT grp, node, count(*) OVER () AS n FROM inner_tree WHERE n = 1),
outer_tree AS (
  SELECT 0 AS level, grp AS pos, n, node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM outer_tree
  WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (
  SELECT l.doc_id, l.leaf, t.level, t.n, (l.pos >> t.level) & 1 AS odd, s.node AS sibling
  FROM leaves l JOIN inner_tree t ON t.grp = l.grp AND t.pos = l.pos >> t.level
  LEFT JOIN inner_tree s ON s.grp = l.grp AND s.level = t.level AND s.pos = xor(l.pos >> t.level, 1)
  WHERE t.n > 1
  UNION ALL
  SELECT l.doc_id, l.leaf, 1000 + t.level, t.n, (l.grp >> t.level) & 1, s.node
  FROM leaves l JOIN outer_tree t ON t.pos = l.grp >> t.level
  LEFT JOIN outer_tree s ON s.level = t.level AND s.pos = xor(l.grp >> t.level, 1)
  WHERE t.n > 1),
paths AS (
  SELECT doc_id, leaf, string_agg(coalesce(sibling, ''), '' ORDER BY level) AS proof,
    list((odd || coalesce(sibling, '')) ORDER BY level) AS path
  FROM steps GROUP BY doc_id, leaf),
ends AS (
  SELECT l.doc_id, l.leaf, s.node AS subroot, r.node AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
    list_reduce([l.claimed] || coalesce(p.path, []), lambda node, s: CASE WHEN s[1] = '1' THEN sha256(s[2:] || node)
      ELSE sha256(node || s[2:]) END) AS folded_root
  FROM leaves l LEFT JOIN paths p ON p.doc_id IS NOT DISTINCT FROM l.doc_id AND p.leaf = l.leaf
  JOIN subroots s ON s.grp = l.grp CROSS JOIN (SELECT node FROM outer_tree WHERE n = 1) r)
SELECT *, folded_root = root AS verified FROM ends
"""

DECONTAMINATION = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS k FROM item WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)),
found AS (SELECT doc_id, k, n, item_id FROM places JOIN phrases USING (n, phrase)),
hits AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS word FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
