"""DuckDB SQL for the reports that SQL can express, written out on its own."""

from __future__ import annotations


def _spans(kind: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
    SELECT r, {kind} AS kind, list_sum(list_transform(gaps[1:i], lambda g: length(g)))::BIGINT
             + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0)::BIGINT AS start,
           length(found[i]) AS size, parts[i] AS part, found[i] AS token
    FROM (SELECT r, regexp_extract_all(x, '{p}', 0) AS found, regexp_extract_all(x, '{p}', {group}) AS parts,
                 string_split_regex(x, '{p}') AS gaps, unnest(range(1, len(regexp_extract_all(x, '{p}', 0)) + 1)) AS i FROM t)
    WHERE length(parts[i]) >= {least}"""


def _tail(z: str) -> str:
    """Upper tail of the standard normal for z >= 0, by the same rational approximation."""
    t = f"(1.0::DOUBLE / (1.0 + 0.2316419 * {z}))"
    poly = "0.0"
    for c in ("1.330274429", "-1.821255978", "1.781477937", "-0.356563782", "0.319381530"):
        poly = f"(({poly}) + ({c}::DOUBLE)) * {t}"
    return f"(exp(-({z}) * ({z}) / 2) * 0.3989422804014327::DOUBLE * ({poly}))"


_KEYWORD = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                    for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""({_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

SECRETS = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
base AS ({_spans(0, _ASSIGN, 2, 12)} UNION ALL {_spans(1, "AKIA[A-Z0-9]{14,}", 0, 18)} UNION ALL {_spans(2, "[0-9a-f]{16,}", 0, 16)}),
loose AS (SELECT * FROM ({_spans(3, "[A-Za-z0-9+/_-]{20,}", 0, 20)}) l WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.r = l.r AND b.start < l.start + l.size AND l.start < b.start + b.size)),
fit AS (SELECT *, regexp_full_match(token, '[^a-z]+') OR regexp_full_match(token, '[^A-Z]+') AS one, lower(token) AS low FROM loose),
typed AS (SELECT r, start, size, CASE WHEN length(letters) <= 36 THEN low ELSE translate(token, '-_', '+/') END AS token, letters, length(letters) AS a
          FROM (SELECT *, CASE
                WHEN one AND regexp_full_match(low, '[0-9a-f]+') THEN '0123456789abcdef'
                WHEN one AND regexp_full_match(low, '[a-z]+') THEN 'etaoinshrdlcumwfgypbvkjxqz'
                WHEN one AND regexp_full_match(low, '[a-z2-7]+') THEN 'etaoinshrdlcumwfgypbvkjxqz234567'
                WHEN one AND regexp_full_match(low, '[a-z0-9]+') THEN 'etaoinshrdlcumwfgypbvkjxqz0123456789'
                WHEN regexp_full_match(low, '[a-z]+') THEN 'etaoinshrdlcumwfgypbvkjxqzETAOINSHRDLCUMWFGYPBVKJXQZ'
                WHEN NOT regexp_matches(token, '[0OIl+/_-]') THEN 'etaoinshrdcumwfgypbvkjxqzETANSHRDLCUMWFGYPBVKJXQZ123456789'
                ELSE 'etaoinshrdlcumwfgypbvkjxqzETAOINSHRDLCUMWFGYPBVKJXQZ0123456789+/' END AS letters FROM fit)),
symbols AS (SELECT r, start, size, a, k, strpos(letters, token[k]) - 1 AS v FROM (SELECT *, unnest(range(1, length(token) + 1)) AS k FROM typed)),
steps AS (SELECT *, lag(v) OVER w AS before, avg(v::DOUBLE) OVER (PARTITION BY r, start) AS mean, v * 8 // a AS bin
          FROM symbols WINDOW w AS (PARTITION BY r, start ORDER BY k)),
facts AS (SELECT r, start, any_value(size) AS size, any_value(a) AS a, COUNT(*)::DOUBLE AS n, COUNT(*) FILTER (v * 2 >= a)::DOUBLE AS h,
                 1.0 + COUNT(*) FILTER (before IS NOT NULL AND (v * 2 >= a) <> (before * 2 >= a)) AS runs,
                 SUM((v - mean) * (before - mean)) / nullif(SUM((v - mean) * (v - mean)), 0) AS serial FROM steps GROUP BY r, start),
chis AS (SELECT r, start, SUM(power(coalesce(c, 0) - n * part, 2) / (n * part)) AS chi
         FROM (SELECT r, start, n, bin, (ceil((bin + 1) * a / 8.0::DOUBLE) - ceil(bin * a / 8.0::DOUBLE)) / a AS part FROM facts CROSS JOIN range(8) b(bin)) LEFT JOIN (SELECT r, start, bin, COUNT(*) AS c FROM steps GROUP BY 1, 2, 3) USING (r, start, bin) GROUP BY 1, 2),
zs AS (SELECT r, start, size, n, (cbrt(chi / 7) - (1 - 2.0::DOUBLE / 63)) / sqrt(2.0::DOUBLE / 63) AS z1,
              abs(runs - (2 * h * (n - h) / n + 1)) / sqrt(nullif(greatest((2 * h * (n - h) / n) * (2 * h * (n - h) / n - 1) / (n - 1), 0), 0)) AS z2,
              abs((serial + 1 / n) * sqrt(n)) AS z3 FROM facts JOIN chis USING (r, start)),
ps AS (SELECT r, start, size, n, CASE WHEN z1 >= 0 THEN {_tail("abs(z1)")} ELSE 1 - {_tail("abs(z1)")} END AS p1,
              coalesce(2 * {_tail("z2")}, 0) AS p2, coalesce(2 * {_tail("z3")}, 0) AS p3 FROM zs),
half AS (SELECT r, start, size, n, -ln(greatest(least(p1, 1), 1e-300)) - ln(greatest(least(p2, 1), 1e-300)) - ln(greatest(least(p3, 1), 1e-300)) AS s FROM ps),
judged AS (SELECT r, start, size, exp(-s) * (1 + s + s * s / 2) * n * n / power(avg(n) OVER (), 2) AS p FROM half),
ranked AS (SELECT *, p <= 0.08 * row_number() OVER (ORDER BY p) / COUNT(*) OVER () AS below FROM judged),
added AS (SELECT r, 3 AS kind, start, size FROM ranked WHERE p > coalesce((SELECT MAX(p) FROM ranked WHERE below), -1)),
named AS (SELECT r, kind, start, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start || ':' || (start + size) AS span
          FROM (SELECT r, kind, start, size FROM base UNION ALL SELECT * FROM added))
SELECT doc_id, COUNT(*) FILTER (kind = 0) AS n_assign, COUNT(*) FILTER (kind = 1) AS n_access, COUNT(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, kind), '') AS spans
FROM t LEFT JOIN named USING (r) GROUP BY r, doc_id"""


_DRAW = "(('0x' || substr(md5({0}), 1, 15))::BIGINT << 3)"

MIXING = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  {_DRAW.format("coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')")} AS h FROM documents),
src AS (SELECT key, size, [1.0, 2.0, 3.0][(row_number() OVER (ORDER BY key) - 1) % 3 + 1]::DOUBLE AS weight
        FROM (SELECT key, SUM(size)::BIGINT AS size FROM d GROUP BY key)),
filled AS (SELECT 3.0::DOUBLE * size / weight AS edge, coalesce(SUM(3.0::DOUBLE * size) OVER w, 0) AS capped,
                  (SELECT SUM(weight) FROM src) - coalesce(SUM(weight) OVER w, 0) AS free FROM src
           WINDOW w AS (ORDER BY 3.0::DOUBLE * size / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (SELECT level FROM (SELECT edge, ((SELECT SUM(size) FROM src) - capped)::DOUBLE / free AS level FROM filled) WHERE edge >= level ORDER BY edge LIMIT 1),
tgt AS (SELECT key, size AS source_size, least(3.0::DOUBLE * size, level * weight) AS target FROM src, lvl),
blk AS (SELECT *, greatest(ceil(source_size / 512.0), least(source_size, 128))::BIGINT AS blocks FROM tgt WHERE source_size > 0 AND target > 0),
wnt AS (SELECT *, ceil(target * blocks / source_size * 1024.0::DOUBLE) / 1024.0::DOUBLE AS want FROM blk),
pln AS (SELECT *, least(round(want), 3 * blocks)::BIGINT AS quota,
               coalesce(SUM(want) OVER (ORDER BY {_DRAW.format("key")}, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM wnt),
whole AS (SELECT SUM(want) AS w, floor(SUM(want) + greatest(64.0, SUM(want) / 64))::BIGINT AS slots FROM pln),
pts AS (SELECT t, ((t::HUGEINT * 2850181424110363369) % 4611686018427387904)::BIGINT::DOUBLE * (w / 4611686018427387904.0::DOUBLE) AS x
        FROM whole, range(0, (SELECT slots FROM whole)) g(t)),
ranked AS (SELECT key, blocks, quota, row_number() OVER (PARTITION BY key ORDER BY t) - 1 AS r FROM pts JOIN pln ON x >= low AND x < low + want),
times AS (SELECT key, r % blocks AS block, COUNT(*) AS times FROM ranked WHERE r < quota GROUP BY 1, 2),
laid AS (SELECT *, coalesce(SUM(size) OVER (PARTITION BY key ORDER BY h, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d),
cut AS (SELECT key, block, times, block * (source_size // blocks) + block * (source_size % blocks) // blocks AS lo,
               (block + 1) * (source_size // blocks) + (block + 1) * (source_size % blocks) // blocks AS hi FROM times JOIN blk USING (key)),
got AS (SELECT rid, SUM((least(hi, start + size) - greatest(lo, start)) * times)::BIGINT AS taken
        FROM laid JOIN cut ON laid.key = cut.key AND start < hi AND start + size > lo AND size > 0 GROUP BY rid)
SELECT doc_id, size, source_size, coalesce(target, 0) AS target, coalesce(taken, 0)::BIGINT AS taken
FROM laid JOIN tgt USING (key) LEFT JOIN got USING (rid)"""


_ESCAPED = r"""replace(replace(replace({0}, '\', '\\'), '#', '\#'), '</', '<\/')"""

CHAT = rf"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
per AS (SELECT conv_id, COUNT(*) AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
               coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned,
               SUM(length({_ESCAPED.format("text")}) + length('### : </turn>') + 1 + CASE WHEN role IN ('system', 'user', 'assistant')
                   THEN length(role) ELSE 1 + length(replace({_ESCAPED.format("role")}, ':', '\:')) END) AS formatted_chars
        FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars FROM per"""


_TERMS = (r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")

LEXICAL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
p AS (SELECT r, doc_id, term, COUNT(*) AS tf FROM (SELECT r, doc_id, {_TERMS} AS term FROM d) GROUP BY ALL),
s AS (SELECT r, SUM(tf)::BIGINT AS n FROM p GROUP BY r), g AS (SELECT COUNT(*) AS docs, SUM(n)::BIGINT AS total FROM s),
m AS (SELECT r, 100 - 25 + (25 * n * docs) // total AS m FROM s, g),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, COUNT(*) AS df FROM p GROUP BY term), g),
q AS (SELECT i, item_id, term, COUNT(*) AS times FROM (SELECT i, item_id, {_TERMS} AS term
      FROM (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))) GROUP BY ALL),
sc AS (SELECT i, item_id, r, doc_id, SUM(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
       FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM sc WHERE score > 0) WHERE rank <= 20"""
