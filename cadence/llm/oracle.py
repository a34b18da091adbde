"""DuckDB SQL for the queries that SQL can express, from their contracts."""

from __future__ import annotations


def _kind(name: str, pattern: str, group: int, least: int) -> str:
    """Spans of one kind: list of {s, k, e, n}. Ends of matches sum the text between them and the matches."""
    quoted = pattern.replace("'", "''")
    k = ("assign", "access", "hex").index(name)
    return f"""
    SELECT doc_id, rn, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
        's': list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
        'k': {k},
        'e': list_sum(list_transform(b[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))),
        'n': '{name}', 'g': length(g[i])}}), lambda x: x.g >= {least}) AS spans
    FROM (SELECT doc_id, rn, regexp_extract_all(t, '{quoted}', 0) AS m, regexp_extract_all(t, '{quoted}', {group}) AS g,
                 string_split_regex(t, '{quoted}') AS b FROM d)"""


_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

OP4 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rn, coalesce(text, '') AS t FROM documents),
a AS ({_kind('assign', _ASSIGN, 2, 6)}),
k AS ({_kind('access', 'AKIA[A-Z0-9]+', 0, 20)}),
h AS ({_kind('hex', '[0-9a-f]{24,}', 0, 24)}),
j AS (SELECT a.doc_id, len(a.spans) AS n_assign, len(k.spans) AS n_access, len(h.spans) AS n_hex,
             array_to_string(list_transform(list_sort(list_concat(a.spans, k.spans, h.spans)), lambda x: x.n || ':' || x.s::BIGINT || ':' || x.e::BIGINT), ',') AS spans
      FROM a JOIN k USING (rn) JOIN h USING (rn))
SELECT doc_id, n_assign, n_access, n_hex, sha256(spans) AS base_sha256, spans FROM j
"""

OP8 = r"""
WITH p AS (
  SELECT page_id, row_number() OVER () AS rn, lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)) AS host,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>|<!--.*?-->', ' ', 'g'),
      '(?i)</?(?:p|div|li|ul|ol|br|h[1-6]|tr|td|table|nav|article|section|header|footer|title|body|head|html)(?:\s[^>]*)?/?>', chr(10), 'g'),
      '<[^>]*>', '', 'g'), '[ \t\r\f]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g') AS text
  FROM pages),
l AS (SELECT rn, page_id, host, i, trim(s[i], ' ') AS line, s[i] AS raw
      FROM (SELECT rn, page_id, host, string_split(text, chr(10)) AS s FROM p), unnest(range(1, len(s) + 1)) u(i)),
o AS (SELECT host, text, min(rn) AS rn FROM p GROUP BY host, text),
q AS (SELECT host, rn, line, length(line) AS n, min(i) AS i FROM l WHERE line <> '' AND rn IN (SELECT rn FROM o) GROUP BY host, rn, line),
f AS (SELECT host, line, count(*) AS n FROM q GROUP BY host, line),
t AS (SELECT host, count(*) AS pages FROM o GROUP BY host),
c AS (SELECT f.host, f.line FROM f JOIN t USING (host) WHERE n >= 2 AND n > 0.05 * pages),
-- Near copies: 80 % of the characters in common lines; a group goes by its longest common line.
m AS (SELECT q.host, rn, arg_max(c.line, (n, -i)) FILTER (WHERE c.line IS NOT NULL) AS head, max(n) FILTER (WHERE c.line IS NOT NULL) AS longest
      FROM q LEFT JOIN c ON q.host = c.host AND q.line = c.line GROUP BY q.host, rn
      HAVING coalesce(sum(n) FILTER (WHERE c.line IS NOT NULL), 0) >= 0.8 * sum(n) AND count(c.line) > 0),
g AS (SELECT q.host, q.line, max(m.longest) AS grp FROM q JOIN c ON q.host = c.host AND q.line = c.line JOIN m ON q.rn = m.rn GROUP BY q.host, q.line),
u AS (SELECT o.host, o.rn, coalesce('copies ' || g.grp, 'page ' || o.rn) AS unit
      FROM o LEFT JOIN m ON o.rn = m.rn LEFT JOIN g ON m.host = g.host AND m.head = g.line),
f2 AS (SELECT q.host, q.line, count(DISTINCT u.unit) AS n FROM q JOIN u ON q.rn = u.rn GROUP BY q.host, q.line),
t2 AS (SELECT host, count(DISTINCT unit) AS pages FROM u GROUP BY host),
b AS (SELECT f2.host, f2.line FROM f2 JOIN t2 USING (host) WHERE n >= 2 AND n > 0.05 * pages)
SELECT l.page_id, l.host,
  CASE WHEN bool_or(b.line IS NULL AND l.line <> '') THEN count(b.line) ELSE 0 END AS n_dropped,
  coalesce(CASE WHEN bool_or(b.line IS NULL AND l.line <> '') THEN string_agg(l.raw, chr(10) ORDER BY l.i) FILTER (WHERE b.line IS NULL)
                ELSE string_agg(l.raw, chr(10) ORDER BY l.i) END, '') AS text
FROM l LEFT JOIN b ON l.host = b.host AND l.line = b.line
GROUP BY l.rn, l.page_id, l.host
"""

def _number(text: str) -> str:
    """60 bits of an MD5 digest."""
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM d GROUP BY source),
s1 AS (SELECT *, [3.0, 1.0, 2.0][number % 3 + 1]::DOUBLE AS weight, sum(source_size) OVER () * 1.5::DOUBLE AS share FROM s0),
-- Level of words per weight when the k sources with least room per weight have stopped.
s2 AS (SELECT *, sum(2 * source_size) OVER o - 2 * source_size AS stopped, sum(weight) OVER () - sum(weight) OVER o + weight AS left_weight, row_number() OVER o AS place
       FROM s1 WINDOW o AS (ORDER BY 2 * source_size / weight, number ROWS UNBOUNDED PRECEDING)),
s3 AS (SELECT arg_min((share - stopped) / left_weight, place) FILTER (WHERE 2 * source_size >= weight * ((share - stopped) / left_weight)) AS level FROM s2),
s4 AS (SELECT number, source, source_size, least(2.0::DOUBLE * source_size, weight * coalesce(level, 0)) AS target FROM s1, s3),
s5 AS (SELECT *, least(floor(target + 0.5)::BIGINT, 2 * source_size) AS words, source_size // 512 AS "full", (source_size + 511) // 512 AS blocks FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS rounds FROM s5),
s7 AS (SELECT *, words - rounds * source_size AS rest FROM s6),
s8 AS (SELECT *, rounds * blocks + (rest + 511) // 512 AS quota FROM s7),
s AS (SELECT *, sum(quota) OVER (ORDER BY number) - quota AS low, sum(quota) OVER () AS n FROM s8),
-- Every source has the indexes below its quota, whichever shards they went to.
j AS (SELECT number, unnest(range(quota::BIGINT)) AS idx FROM s),
k AS (SELECT number, "full", rounds, rest, source_size, idx // blocks AS turn, idx % blocks AS at_ FROM j JOIN s USING (number)),
y AS (SELECT number, e, list({_number("'key:' || number || ':' || e || ':' || r")} ORDER BY r) AS keys
      FROM s, (SELECT unnest(range(3)) AS e), (SELECT unnest(range(1, 25)) AS r) GROUP BY number, e),
b AS (SELECT k.number, rounds, rest, turn, at_, CASE WHEN at_ < "full" THEN 512 ELSE source_size - "full" * 512 END AS own,
        CASE WHEN at_ < "full" THEN list_reduce(list_concat([at_], keys), lambda x, key:
          CASE WHEN ascii(md5(key || ':' || greatest(x, ((key - x) % "full" + "full") % "full"))) % 2 = 1 THEN ((key - x) % "full" + "full") % "full" ELSE x END) ELSE "full" END AS block
      FROM k JOIN y ON k.number = y.number AND k.turn = y.e),
v AS (SELECT number, block, CASE WHEN turn < rounds THEN own ELSE least(own, rest - at_ * 512) END AS words FROM b),
p AS (SELECT rn, d.doc_id, size, number, source_size, target,
        sum(size) OVER (PARTITION BY number ORDER BY {_number("'doc:' || coalesce(doc_id::VARCHAR, '')")}, doc_id, size, rn) - size AS start
      FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source)
SELECT p.doc_id, size, p.source_size, target,
  coalesce(sum(greatest(0, least(start + size, block * 512 + words) - greatest(start, block * 512))) FILTER (WHERE words IS NOT NULL), 0)::BIGINT AS taken
FROM p LEFT JOIN v ON v.number = p.number AND block BETWEEN start // 512 AND (start + size - 1) // 512 AND size > 0
GROUP BY rn, p.doc_id, size, p.source_size, target
"""

OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
f AS (
  SELECT doc_id, part,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask
  FROM w),
g AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM f LEFT JOIN g USING (doc_id) GROUP BY part, mask),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
p AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
s AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit,
        coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))), 0)::INT AS earlier
      FROM p, (SELECT unnest(range(1, 6))::INT AS step)),
r AS (
  SELECT part, filter_order, step, bit,
    sum(n) FILTER (WHERE mask & bit = 0 AND mask & earlier = 0) AS kept, sum(n) FILTER (WHERE mask & bit <> 0 AND mask & earlier = 0) AS removed,
    sum(n) FILTER (WHERE mask & bit <> 0 AND mask & earlier <> 0) AS redundant, sum(n) FILTER (WHERE mask = bit) AS unique_fails,
    sum(good) FILTER (WHERE mask & bit <> 0 AND mask & earlier = 0) AS good_lost, sum(toxic) FILTER (WHERE mask & bit <> 0 AND mask & earlier = 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM r
"""

SQL = {"op4_blob_ledger_secrets": OP4, "op8_site_lines": OP8, "op11_multinomial_mix": OP11, "op12_filter_orders": OP12}
