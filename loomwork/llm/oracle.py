"""SQL that DuckDB can run for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN 0
         ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS n
  FROM documents),
cut AS (
  SELECT doc_id, CAST(piece AS INT) AS piece, piece * 2048 AS start, least(2048, n - piece * 2048) AS length
  FROM (SELECT doc_id, n, unnest(range(greatest(CAST(ceil(n / 2048.0) AS BIGINT), 1))) AS piece FROM sized) t),
counted AS (SELECT length, count(*) AS c FROM cut WHERE length > 0 GROUP BY length),
h AS (
  SELECT row_number() OVER (ORDER BY length) AS j, length,
         sum(c) OVER (ORDER BY length)::BIGINT AS rows_to, sum(c * length) OVER (ORDER BY length)::BIGINT AS tokens_to
  FROM counted
  UNION ALL SELECT 0, 0, 0, 0),
dp AS (
  SELECT 1 AS k, j, length * rows_to - tokens_to AS cost, 0::BIGINT AS came FROM h
  UNION ALL
  SELECT k, j, cost, came FROM (
    SELECT dp.k + 1 AS k, b.j AS j,
           dp.cost + b.length * (b.rows_to - a.rows_to) - (b.tokens_to - a.tokens_to) AS cost, a.j AS came,
           row_number() OVER (PARTITION BY b.j ORDER BY
             dp.cost + b.length * (b.rows_to - a.rows_to) - (b.tokens_to - a.tokens_to), a.j) AS r
    FROM dp JOIN h a ON a.j = dp.j JOIN h b ON b.j > a.j OR (b.j = 0 AND a.j = 0)
    WHERE dp.k < 16) t
  WHERE r = 1),
last AS (
  SELECT k, j, came FROM dp WHERE j = (SELECT max(j) FROM h) AND j > 0 ORDER BY cost, k LIMIT 1),
walk AS (
  SELECT k, j, came FROM last
  UNION ALL
  SELECT dp.k, dp.j, dp.came FROM walk JOIN dp ON dp.k = walk.k - 1 AND dp.j = walk.came WHERE walk.came > 0),
edges AS (SELECT h.length AS bucket, lag(h.length, 1, 0) OVER (ORDER BY h.length) AS over FROM walk JOIN h USING (j)),
blocks AS (SELECT greatest(1, CAST(ceil(sum(c) / 16384.0) AS BIGINT)) AS blocks FROM counted),
placed AS (
  SELECT doc_id, piece, start, length, bucket,
         ((((coalesce(doc_id, -1) % 2147483647) + 2147483647) % 2147483647) * 1103515245
          + piece * 747796405::BIGINT + 42) % 2147483647 AS mixed
  FROM cut LEFT JOIN edges ON length > over AND length <= bucket),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY mixed % blocks, mixed, doc_id, piece) - 1 AS rank
  FROM placed, blocks)
SELECT doc_id, piece, start, length, CAST(bucket AS INT) AS bucket,
       CASE WHEN bucket IS NOT NULL THEN rank // greatest(65536 // bucket, 1) END AS batch,
       CASE WHEN bucket IS NOT NULL THEN CAST(rank % greatest(65536 // bucket, 1) AS INT) END AS slot
FROM ranked
"""

OP3 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# the shards claim slots one at a time: 32 shards, a table of 4099
OP9 = """
WITH RECURSIVE shards AS (
  SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 2, '0') AS name FROM range(32) t(i)),
prefs AS (
  SELECT list(('0x' || substr(md5(name || '#offset'), 1, 15))::BIGINT % 4099 ORDER BY i) AS off,
         list(('0x' || substr(md5(name || '#skip'), 1, 15))::BIGINT % 4098 + 1 ORDER BY i) AS skip,
         list(name ORDER BY i) AS names
  FROM shards),
fill AS (
  SELECT CAST(0 AS BIGINT) AS step, list_transform(range(4099), lambda x: CAST(-1 AS BIGINT)) AS slots, CAST(-1 AS BIGINT) AS claimed
  UNION ALL
  SELECT step + 1,
         list_concat(list_slice(slots, 1, spot), [CAST(step % 32 AS BIGINT)], list_slice(slots, spot + 2, 4099)), spot
  FROM (
    SELECT step, slots,
           list_filter(list_transform(range(4099), lambda j: (off[step % 32 + 1] + j * skip[step % 32 + 1]) % 4099),
                       lambda s: slots[s + 1] = -1)[1] AS spot
    FROM fill, prefs WHERE step < 4099) t),
full_table AS (SELECT slots FROM fill WHERE step = 4099)
SELECT doc_id, CAST(slot AS INT) AS slot, names[slots[slot + 1] + 1] AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % 4099 AS slot
      FROM documents) d, full_table, prefs
"""

OP11 = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
controls AS (SELECT ['<s>', '</s>', '[INST]', '[/INST]', '[/ROLE]', '\'] AS c),
sized AS (
  SELECT conv_id, turn, role, text,
         length(text) + list_sum(list_transform(c, lambda x: (length(text) - length(replace(text, x, ''))) // length(x))) AS text_size,
         length(role) + list_sum(list_transform(c, lambda x: (length(role) - length(replace(role, x, ''))) // length(x))) AS role_size
  FROM given, controls)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(CASE WHEN role = 'assistant' THEN text_size + 4 ELSE 6 + role_size + 7 + text_size + 7 END) AS BIGINT)
         AS formatted_chars
FROM sized GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_packing": OP1, "op3_exact_dedup": OP3, "op9_sharding": OP9, "op11_chat_format": OP11}
