"""Oracle SQL of the corpus operators that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH src AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT CAST(item_id AS VARCHAR) AS item_id, len, array_to_string(w[i:i + len - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 13) AS len, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM src WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len AS k FROM win),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
grams AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, lens WHERE len(w) >= k)),
hits AS (SELECT g.r, g.i, g.k, x.item_id FROM grams g JOIN win x ON x.s = g.s AND x.len = g.k),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP6 = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
each AS (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
  14 + length(role) + length(text) + (length(role) - length(replace(role, '\', ''))) + (length(role) - length(replace(role, '#', '')))
  + (length(role) - length(replace(role, '<', ''))) + (length(role) - length(replace(role, ':', ''))) + (length(text) - length(replace(text, '\', '')))
  + (length(text) - length(replace(text, '#', ''))) + (length(text) - length(replace(text, '<', ''))) AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(CASE coalesce(before, '') WHEN '' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant'
    WHEN 'assistant' THEN role IN ('user', 'tool') WHEN 'tool' THEN role = 'assistant' ELSE false END
    AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM each GROUP BY conv_id
"""

OP11 = r"""
WITH cells AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS cell
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
aims AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
terms AS (SELECT r, unnest(w) AS word FROM docs),
hexes AS (SELECT word, hex(word) AS x FROM (SELECT word FROM terms UNION SELECT word FROM aims)),
codes AS (SELECT word, list_transform(range(0, length(x) // 2), lambda i: CAST(
    16 * (instr('0123456789ABCDEF', x[2 * i + 1 : 2 * i + 1]) - 1) + instr('0123456789ABCDEF', x[2 * i + 2 : 2 * i + 2]) - 1 AS BIGINT)) AS bytes FROM hexes),
hashed AS (SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b: xor(c >> 8, cell[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM codes, cells),
s AS (SELECT bucket, count(*) AS n FROM terms JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM aims JOIN hashed USING (word) GROUP BY bucket),
gains AS (SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
    / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT r, sum(gain) AS weight FROM terms JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r),
drawn AS (SELECT r, doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(range(1, 9),
    lambda i: CAST(instr('0123456789abcdef', sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[i : i]) - 1 AS BIGINT))), lambda a, d: a * 16 + d) AS h FROM docs LEFT JOIN weights USING (r)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM drawn),
ranks AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CAST(CASE WHEN rank <= n * 10 // 100 THEN rank END AS BIGINT) AS rank
FROM scored LEFT JOIN ranks USING (r)
"""

ORACLES = {"op1_decontaminate": OP1, "op6_chat": OP6, "op11_importance": OP11}
