"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from sessionrate.llm import quality, sharding

# the shards take turns: one recursion step per claim, the table as a list
_TABLE = """
{name}_pref AS (
  SELECT i, name, CAST('0x' || substr(md5(name || '/start'), 1, 12) AS BIGINT) % {size} AS start_at,
         CAST('0x' || substr(md5(name || '/stride'), 1, 12) AS BIGINT) % ({size} - 1) + 1 AS stride
  FROM (SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 2, '0') AS name FROM range({n}) r(i))),
{name}_perm AS (
  SELECT i, list((start_at + j * stride) % {size} ORDER BY j) AS slots
  FROM {name}_pref, range({size}) t(j) GROUP BY i),
{name}_turn AS (
  SELECT 0 AS step, list_transform(range({size}), lambda x: CAST(-1 AS BIGINT)) AS owner
  UNION ALL
  SELECT step + 1, owner[1:slot] || [CAST(i AS BIGINT)] || owner[slot + 2:]
  FROM (SELECT step, owner, i, list_filter(slots, lambda s: owner[s + 1] = -1)[1] AS slot
        FROM {name}_turn JOIN {name}_perm ON i = step % {n} WHERE step < {size}) q),
{name} AS (
  SELECT unnest(range({size})) AS slot, 'shard-' || lpad(CAST(unnest(owner) AS VARCHAR), 2, '0') AS shard
  FROM {name}_turn WHERE step = {size})
"""


OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
             sha256(body) AS strong FROM p),
newest AS (SELECT strong, max(page_id) AS newest FROM d WHERE payload_bytes >= 1000 GROUP BY strong)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN newest IS NOT NULL AND page_id IS DISTINCT FROM newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM d LEFT JOIN newest USING (strong)
"""

OP1 = "WITH RECURSIVE " + ",".join(
    _TABLE.format(name=name, n=n, size=sharding.TABLE_SIZE)
    for name, n in (("t_all", len(sharding.SHARDS)), ("t_fewer", len(sharding.SHARDS) - 1))) + f"""
SELECT doc_id, d.slot, t_all.shard AS shard, t_fewer.shard AS shard_with_one_fewer
FROM (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT)
             % {sharding.TABLE_SIZE} AS slot FROM documents) d
JOIN t_all USING (slot) JOIN t_fewer USING (slot)
"""

_W = r"[^\x20\x09-\x0D]+"
_STOCK = " OR ".join(f"contains(lower(line), '{x.decode()}')" for x in quality.BOILERPLATE)
_SEPARATORS = ", ".join(f"'{x.decode()}'" for x in sorted(quality.SEPARATORS))
OP3 = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS txt FROM documents),
b AS (SELECT r, doc_id, regexp_extract_all(txt, '{_W}') AS words,
             length(regexp_replace(txt, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(txt) - length(regexp_replace(txt, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM t),
win AS (SELECT r, i, words[i:i + 7] AS w FROM b, unnest(range(1, len(words) - 6)) u(i) WHERE len(words) >= 8),
again AS (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM win),
rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM again, range(8) q(k) WHERE n > 1 GROUP BY r),
ln AS (SELECT r, unnest(string_split(txt, chr(10))) AS line,
              unnest(range(len(string_split(txt, chr(10))))) AS i FROM t),
lw AS (SELECT r, i, line, regexp_extract_all(line, '{_W}') AS w,
              row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again FROM ln
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
fault AS (
  SELECT r, len(w) AS n, again, CASE
    WHEN 100 * len(list_filter(w, lambda x: x IN ({_SEPARATORS}))) >= 20 * len(w) THEN 'nav'
    WHEN 100 * (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) > 30 * len(w) THEN 'symbols'
    WHEN len(w) >= 3 AND 100 * len(list_filter(w, lambda x:
           regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) > 60 * len(w) THEN 'caps'
    WHEN NOT regexp_matches(line, '[.!?:;…。]["'')\]]*([ \t\x0b\x0c\r]|$)') THEN 'punct'
    WHEN {_STOCK} THEN 'boilerplate'
    WHEN len(w) >= 5 AND 100 * len(list_filter(range(2, len(w) + 1), lambda j: w[j] = w[j - 1])) > 50 * len(w)
      OR again THEN 'repeated' END AS rule
  FROM lw),
f AS (SELECT r, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(n) FILTER (rule IS NOT NULL), 0) AS words_lost,
             {", ".join(f"count(*) FILTER (rule = '{x}') AS lines_{x}" for x in quality.RULES)}
      FROM fault GROUP BY r),
a AS (SELECT doc_id, len(words) AS n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(words_lost, 0) AS words_lost,
             {", ".join(f"coalesce(lines_{x}, 0) AS lines_{x}" for x in quality.RULES)}
      FROM b LEFT JOIN rep USING (r) LEFT JOIN f USING (r)),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * words_lost <= 40 * n_words AS kept, CAST(words_lost AS BIGINT) AS words_lost,
       {", ".join(f"lines_{x}" for x in quality.RULES)}
FROM v
"""

OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(source, '') AS s, coalesce(CAST(doc_id AS VARCHAR), '') AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents),
src AS (SELECT s, CAST(sum(n_tokens) AS BIGINT) AS t FROM d GROUP BY s),
tot AS (SELECT sum(t)::DOUBLE AS total, 0.99 * ln(count(*)) - 1e-12 AS want FROM src WHERE t > 0),
p AS (SELECT t / total AS p, want FROM src, tot WHERE t > 0),
-- 32 halvings reach the 16**-8 grid of the operator
ent AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN h >= want THEN mid ELSE lo END, CASE WHEN h >= want THEN hi ELSE mid END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid FROM ent WHERE i < 32) e,
       LATERAL (SELECT ln(sum(pow(p, mid))) - mid * sum(pow(p, mid) * ln(p)) / sum(pow(p, mid)) AS h,
                       max(want) AS want FROM p) x),
flat AS (SELECT CASE WHEN (SELECT -sum(p * ln(p)) >= max(want) FROM p) OR (SELECT count(*) FROM p) < 2 THEN 1.0 ELSE lo END AS a
         FROM ent WHERE i = 32),
most AS (SELECT max(pow(p, a - 1)) / sum(pow(p, a)) > 4 * (1 + 1e-12) AS much FROM p, flat),
rep AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN much THEN mid ELSE lo END, CASE WHEN much THEN hi ELSE mid END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid FROM rep WHERE i < 32) e,
       LATERAL (SELECT max(pow(p, mid - 1)) / sum(pow(p, mid)) > 4 * (1 + 1e-12) AS much FROM p) x),
e AS (SELECT round(CASE WHEN much THEN greatest(a, least(1.0, lo + pow(16.0, -8))) ELSE a END, 6) AS a
      FROM flat, most, rep WHERE i = 32),
z AS (SELECT a, total, sum(pow(t / total, a)) AS z FROM src, tot, e WHERE t > 0 GROUP BY a, total),
q AS (SELECT s, t, CASE WHEN t = 0 THEN 0 ELSE CAST(round(pow(t / total, a) / z * total) AS BIGINT) END AS quota FROM src, z),
f AS (SELECT s, CASE WHEN t = 0 THEN 1 ELSE quota // t END AS n_full, CASE WHEN t = 0 THEN 0 ELSE quota % t END AS rest FROM q),
o AS (SELECT d.*, n_full, rest, sum(n_tokens) OVER (PARTITION BY s ORDER BY
             CAST('0x' || substr(md5('0:' || k || chr(31) || s || chr(31) || CAST(n_full AS VARCHAR)), 1, 13) AS BIGINT), k
             ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN f USING (s))
SELECT doc_id, source, n_tokens, CAST(n_full + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM o
"""

ORACLE = {
    "op3_line_first_quality": OP3,
    "op1_permutation_table_sharding": OP1,
    "op7_content_addressed_warc": OP7,
    "op8_temperature_mixing": OP8,
}
