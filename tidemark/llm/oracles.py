"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import sharding

_UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_SHARDS = ", ".join(f"'{s}'" for s in sharding.SHARDS)
_N, _M = len(sharding.SHARDS), sharding.SLOTS

ORACLES: dict[str, str] = {}

ORACLES["op2_sharding"] = f"""
WITH RECURSIVE shards AS (
  SELECT i, [{_SHARDS}][i + 1] shard FROM range({_N}) r(i)
), preference AS (
  SELECT i, ('0x' || substr(md5('offset ' || shard), 1, 8))::BIGINT % {_M} start,
    ('0x' || substr(md5('stride ' || shard), 1, 8))::BIGINT % {_M - 1} + 1 stride
  FROM shards
), fill AS (
  SELECT 0::BIGINT turn, list_transform(range({_M}), lambda x: -1::BIGINT) slots
  UNION ALL
  SELECT turn + 1, list_concat(list_append(slots[:claimed], turn % {_N}), slots[claimed + 2:])
  FROM (
    SELECT turn, slots, list_filter(
      list_transform(range({_M}), lambda j: (start + j * stride) % {_M}),
      lambda s: slots[s + 1] < 0)[1] claimed
    FROM fill JOIN preference ON i = turn % {_N} WHERE turn < {_M}
  )
), lookup AS (
  SELECT unnest(range({_M})) slot, unnest(slots) i FROM fill WHERE turn = {_M}
), keyed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8))::BIGINT % {_M} slot
  FROM documents
)
SELECT doc_id, slot, shard FROM keyed JOIN lookup USING (slot) JOIN shards USING (i)
"""

ORACLES["op4_suffix_array"] = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), cut AS (
  SELECT doc_id, b, substr(h, 2 * b + 1, 2 * (256 + 199)) AS p, len(h) // 2 AS n
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199, 256)) AS b FROM bytes)
), named AS (
  SELECT doc_id, b + j AS i, md5(substr(p, 2 * j + 1, 400)) AS k
  FROM (SELECT doc_id, b, p, unnest(range(0, least(256, n - 199 - b))) AS j FROM cut)
), repeated AS (
  SELECT doc_id, i FROM named JOIN (SELECT k FROM named GROUP BY k HAVING count(*) > 1) USING (k)
), marked AS (
  SELECT *, coalesce(i > lag(i) OVER w + 200, true) AS opens FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, count_if(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked
), spans AS (
  SELECT doc_id, span, min(i) AS b, max(i) + 200 AS e FROM numbered GROUP BY doc_id, span
), gaps AS (
  SELECT doc_id, span, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS after FROM spans
), pieces AS (
  SELECT doc_id, string_agg(substr(h, 2 * after + 1, 2 * (b - after)), '' ORDER BY b) AS front,
    max(e) AS last, sum(e - b)::BIGINT AS n_removed, count(*) AS n_spans
  FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN pieces USING (doc_id)
"""

ORACLES["op9_recompression"] = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM split)
), first AS (
  SELECT k, min(doc_id) AS holder FROM windows GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos
  FROM windows JOIN first USING (k) WHERE doc_id > holder
), words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM split
), judged AS (
  SELECT w.doc_id, w.pos, word, g.pos IS NOT NULL AS lost
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos
), summed AS (
  SELECT doc_id, count(*) AS n_words, count_if(lost)::BIGINT AS n_removed,
    string_agg(word, ' ' ORDER BY pos) FILTER (NOT lost) AS kept
  FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN summed USING (doc_id)
"""

ORACLES["op5_url_filter"] = rf"""
WITH split AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {_UPPER_LOWER}) host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') path
  FROM pages
), keyed AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || rtrim(path, '/') entry,
    CASE WHEN host = 'example.org' OR host LIKE '%.example.org' THEN
      CASE WHEN starts_with(path, '/en/1') THEN 'example.org/en/1'
           WHEN starts_with(path, '/es/') THEN 'example.org/es/' END END first_rule,
    CASE WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END next_rule
  FROM split
), listed AS (
  SELECT DISTINCT entry FROM keyed WHERE regexp_matches(host, 'casino|bets|pills|track')
)
SELECT page_id, host, path, coalesce(first_rule, next_rule) AS rule,
  l.entry IS NOT NULL AS listed,
  CASE coalesce(first_rule, next_rule)
    WHEN 'org/' THEN 'allow' WHEN 'com/fr/' THEN 'allow'
    WHEN 'example.org/es/' THEN 'block' WHEN 'example.org/en/1' THEN 'block' WHEN 'com/de/' THEN 'block'
    ELSE CASE WHEN l.entry IS NOT NULL THEN 'block' ELSE 'allow' END END AS verdict
FROM keyed LEFT JOIN listed l ON keyed.host <> '' AND keyed.entry = l.entry
"""

ORACLES["op6_threshold_search"] = """
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) "rank" FROM scored
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
"""

ORACLES["op10_line_dedup"] = rf"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_UPPER_LOWER}) AS k
  FROM lines
), held AS (
  SELECT k, min(doc_id) AS holder FROM keyed WHERE length(k) >= 10 GROUP BY k
), judged AS (
  SELECT doc_id, pos, line, coalesce(holder <> doc_id, false) AS lost
  FROM keyed LEFT JOIN held USING (k)
)
SELECT doc_id, count(*) AS n_lines, count_if(lost)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
