"""Oracles in SQL of the corpus queries that need more than a line."""

#: The table of crc32 by byte; ``xor(crc >> 8, tab[...])`` takes a byte in.
CRC = """bits AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS tab
  FROM (SELECT unnest(range(256)) AS n))"""

CONVERSATION_TRIE = f"""
WITH {CRC},
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS body, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    substr(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), bits),
again AS (SELECT c.conv_id, 0 AS part, t.k, t.role, t.body FROM convs c JOIN turns t ON t.conv_id = c.base AND t.k <= c.h
  UNION ALL SELECT c.conv_id, 1, t.k, t.role, t.body FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.k > c.h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, k) AS d, sha256(length(role)::VARCHAR || ':' || role || body) AS turn_key,
    len(regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+')) AS words FROM again),
prefixes AS (SELECT conv_id, d, words, sha256(string_agg(turn_key, '') OVER (PARTITION BY conv_id ORDER BY d)) AS node,
    lag(1) OVER (PARTITION BY conv_id ORDER BY d DESC) IS NULL AS is_end FROM placed),
steps AS (SELECT conv_id, d, words, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY d), 'root') AS parent, is_end FROM prefixes
  UNION ALL SELECT conv_id, 0, 0, 'root', NULL, conv_id NOT IN (SELECT conv_id FROM placed) FROM convs),
nodes AS (SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256 FROM steps GROUP BY node),
fan AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
above AS (SELECT DISTINCT lower.node AS node, upper.node AS top FROM steps lower JOIN steps upper ON lower.conv_id = upper.conv_id AND upper.d <= lower.d),
sums AS (SELECT top AS node, count(*) FILTER (WHERE fan.n_children IS NULL) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM above JOIN nodes USING (node) LEFT JOIN fan USING (node) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(fan.n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.parent = p.node LEFT JOIN fan ON fan.node = n.node JOIN sums ON sums.node = n.node"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE {CRC},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
long_runs AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
keyed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(code)), lambda i: ('0x' || substr(hex(code), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, n, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS code FROM long_runs), bits),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM keyed)
  WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
cuts AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.rest = w.word),
best AS (SELECT near.word, count(*) AS n_near, first(other ORDER BY o.n DESC, other) AS other, max(o.n) AS other_n
  FROM near JOIN words o ON o.word = near.other GROUP BY 1),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at FROM forms UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""
