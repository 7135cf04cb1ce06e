"""DuckDB SQL with the rows of the registered queries, where SQL can state them.

None for op1 and op5 (trained models), op6 (packing) and the
pipeline; ``tests/llm`` compares those with brute-force versions. CRC-32 is written out.
"""

from __future__ import annotations

from clickweave.llm import link_trust, lsh_forest, poisson_mix
from clickweave.llm.params import OTHER_SHARE, RULES, TARGETS

OP2 = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

OP3 = """
WITH l AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), shared AS (
  SELECT key, min(doc_id) AS first_id FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT doc_id, pos, line, first_id IS NOT NULL AND first_id <> doc_id AS gone FROM l LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP4 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+') AS w FROM documents
), runs AS (
  SELECT doc_id, list_sort(list_distinct(CASE
    WHEN len(w) >= {lsh_forest.SHINGLE} THEN list_transform(range(1, len(w) - {lsh_forest.SHINGLE} + 2), lambda i: array_to_string(w[i:i + {lsh_forest.SHINGLE - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM words
), sets AS (
  SELECT s, min(doc_id) AS set_id, count(*) AS copies, len(s) AS n FROM runs WHERE len(s) > 0 GROUP BY s
), one AS (SELECT set_id, n, unnest(s) AS x FROM sets
), links AS (
  SELECT a.set_id AS a, b.set_id AS b FROM one a JOIN one b ON a.x = b.x AND a.set_id <> b.set_id
  GROUP BY a.set_id, b.set_id, a.n, b.n HAVING count(*) >= {lsh_forest.THRESHOLD} * (a.n + b.n - count(*)) - 1e-9
), reach AS (
  SELECT set_id AS a, set_id AS b FROM sets
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), classes AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a
), counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(set_id, doc_id) AS set_id, coalesce(copies, 1) AS copies, coalesce(n_links, 0) AS n_links
FROM runs LEFT JOIN sets USING (s) LEFT JOIN classes ON classes.a = set_id LEFT JOIN counts ON counts.a = set_id
"""

OP7 = f"""
WITH weight(pool, w) AS (VALUES {', '.join(f"('{k}', {v!r})" for k, v in TARGETS.items())}, (NULL, {OTHER_SHARE!r})
), docs AS (
  SELECT *, CASE WHEN source IN ({', '.join(f"'{k}'" for k in TARGETS)}) THEN source END AS pool,
         coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS k FROM documents
), counts AS (SELECT pool, count(*) AS n FROM docs GROUP BY pool
), rate AS (
  SELECT c.pool, w / (SELECT sum(w) FROM weight JOIN counts p ON p.pool IS NOT DISTINCT FROM weight.pool) * (SELECT count(*) FROM docs) / n AS rate
  FROM counts c JOIN weight ON c.pool IS NOT DISTINCT FROM weight.pool
), split AS (SELECT pool, greatest(1, ceil(rate / {poisson_mix.RATE_STEP!r}))::INTEGER AS draws, rate FROM rate WHERE rate > 0
), cdf AS (
  SELECT pool, draws, list_transform(range(0, 150), lambda i: list_sum(list_transform(range(0, i + 1),
           lambda j: exp(-rate / draws + j * ln(rate / draws) - lgamma(j + 1))))) AS cdf FROM split
), drawn AS (
  SELECT docs.*, list_sum(list_transform(range(1, draws + 1), lambda j: len(list_filter(cdf,
           lambda c: c <= ('0x' || substr(md5('mix|' || k || '|' || j::VARCHAR), 1, 13))::BIGINT / power(2, 52))))) AS times
  FROM docs JOIN cdf ON docs.pool IS NOT DISTINCT FROM cdf.pool
)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, times::BIGINT + 1))::INTEGER AS copy FROM drawn
"""

OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


SQL_STEPS = 300  # 0.85**300 of what a first step passes on is left


def _spread(name: str, seed: str, giver: str, taker: str) -> str:
    """CTEs of the PageRank along giver -> taker, as the sum of what each step adds."""
    return f"""{name}_flow AS (SELECT {giver} AS giver, {taker} AS taker, links / sum(links) OVER (PARTITION BY {giver}) AS part FROM edges),
{name}_gain AS (
  SELECT 0 AS i, host, {seed}::DOUBLE AS gain FROM hosts WHERE {seed} > 0
  UNION ALL
  SELECT g.i + 1, f.taker, {link_trust.DAMPING!r} * sum(f.part * g.gain) FROM {name}_gain g JOIN {name}_flow f ON f.giver = g.host WHERE g.i < {SQL_STEPS} GROUP BY g.i, f.taker),
{name} AS (SELECT host, sum(gain) AS score FROM {name}_gain GROUP BY host)"""


def _rule(field: str) -> str:
    cases = " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, field)}'"
                     for r in sorted(RULES, key=lambda r: -len(r.name)))
    return f"CASE {cases} END"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP9 = f"""
WITH RECURSIVE cut AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, html, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (SELECT *, {_rule('name')} AS rule, {_rule('verdict')} AS said FROM split
), linked AS (
  SELECT host AS src, {_LOWER.format("unnest(regexp_extract_all(html, '" + link_trust.LINK.replace("'", "''") + "', 1))")} AS dst FROM split
), edges AS (SELECT src, dst, count(*)::DOUBLE AS links FROM linked WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
), hosts AS (
  SELECT host, max(good) AS good, max(bad) AS bad FROM (
    SELECT host, avg((said IS NOT DISTINCT FROM 'allow')::INTEGER) AS good, avg((said IS NOT DISTINCT FROM 'block')::INTEGER) AS bad FROM ruled WHERE host <> '' GROUP BY host
    UNION ALL SELECT dst, 0.0, 0.0 FROM edges) GROUP BY host
), {_spread('t', 'good', 'src', 'dst')}, {_spread('r', 'bad', 'dst', 'src')}, blocked AS (
  SELECT r.host FROM r LEFT JOIN t USING (host)
  WHERE round(r.score, {link_trust.DIGITS}) >= {link_trust.THRESHOLD} AND round(r.score, {link_trust.DIGITS}) > round(coalesce(t.score, 0), {link_trust.DIGITS})
)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled
"""

def _bump(v: str, cost: str, letter: str) -> str:
    """A state's value (ten digits of cost, then the audit; 'z' if unreachable) after one more edit."""
    return f"CASE WHEN {v} = 'z' THEN 'z' ELSE lpad((substr({v}, 1, 10)::BIGINT + {cost})::VARCHAR, 10, '0') || substr({v}, 11) || '{letter}' END"


def _if(test: str, v: str) -> str:
    return f"CASE WHEN {test} THEN {v} ELSE 'z' END"


# The table of CRC-32 by its rule (reversed polynomial), and the checksum of a list of bytes.
_CRC_TABLE = """tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab
)"""


def _crc32(octets: str) -> str:
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


OP10 = f"""
WITH {_CRC_TABLE}, sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {_crc32("list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)")} AS text_crc32
  FROM documents, tab
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) AS place,
         sum(size) OVER () AS every FROM sized
), dealt AS (SELECT *, least((2 * upto - size) * 8 // (2 * every), 7)::INTEGER AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INTEGER AS grown_shard FROM dealt
"""

# A forward dynamic programme that keeps each state's cheapest, least audit as a string, then the audit replayed.
_CLOSED = f"""SELECT *, least(v3, {_bump('w2', '2', 'I')}) AS w3 FROM (
    SELECT *, least(v2, {', '.join(_bump(f'v{q}', '2', 'I') for q in (0, 1, 3))}) AS w2 FROM walk)"""
_STAYS = "2 + cut"
OP11 = f"""
WITH RECURSIVE {_CRC_TABLE}, named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), hashed AS (
  SELECT *, {_crc32("list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)")} % 20 AS how
  FROM named, tab
), damaged AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN how = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE how <> 0
), turns AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, substr(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged
), faults AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS odd FROM turns
), facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (odd) AS illegal FROM faults GROUP BY conv_id
), steps AS (
  SELECT conv_id, i, initial, coalesce(fault IN ('blank', 'duplicate'), false) AS go, coalesce(fault = 'truncated', false)::INTEGER AS cut FROM faults
), walk AS (
  SELECT conv_id, 0::BIGINT AS i, '0000000000' AS v0, 'z' AS v1, 'z' AS v2, 'z' AS v3 FROM facts
  UNION ALL
  SELECT s.conv_id, s.i, {_bump('v0', '3', 'D')},
         least({_bump('v1', '3', 'D')}, {_if("NOT go AND initial = 's'", _bump('v0', 'cut', 'K'))}),
         least({_bump('w2', '3', 'D')}, {', '.join(_if("NOT go", _bump(v, _STAYS, 'R')) for v in ('v0', 'v1', 'w3'))},
               {', '.join(_if("NOT go AND initial = 'u'", _bump(v, 'cut', 'K')) for v in ('v0', 'v1', 'w3'))}),
         least({_bump('w3', '3', 'D')}, {_if("NOT go", _bump('w2', _STAYS, 'R'))}, {_if("NOT go AND initial = 'a'", _bump('w2', 'cut', 'K'))})
  FROM ({_CLOSED}) w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1
), best AS (
  SELECT f.conv_id, f.n, least(v0, w3) AS v FROM ({_CLOSED}) w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.i
), replay AS (
  SELECT conv_id, 0::BIGINT AS p, 0::BIGINT AS i, 0 AS q, NULL::VARCHAR AS line, substr(v, 11) AS audit FROM best
  UNION ALL
  SELECT r.conv_id, r.p + 1, r.i + (r.letter <> 'I')::INTEGER,
         CASE r.letter WHEN 'D' THEN q WHEN 'K' THEN CASE t.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE WHEN q = 2 THEN 3 ELSE 2 END END,
         CASE r.letter WHEN 'K' THEN t.role || ':' || t.text WHEN 'D' THEN NULL ELSE CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END || CASE WHEN r.letter = 'R' THEN t.text ELSE '' END END, audit
  FROM (SELECT *, substr(audit, p + 1, 1) AS letter FROM replay WHERE p < length(audit)) r
  LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM r.conv_id AND t.i = r.i + 1 AND r.letter <> 'I'
), texts AS (SELECT conv_id, coalesce(string_agg(line, chr(10) ORDER BY p), '') AS repaired FROM replay GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(substr(v, 1, 10)::BIGINT, 0) AS cost, coalesce(substr(v, 11), '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents
), u AS (
  SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units, ('0x' || substr(hex, 1, 8))::BIGINT AS h1, ('0x' || substr(hex, 9, 8))::BIGINT AS h2,
         ('0x' || substr(hex, 17, 8))::BIGINT AS h3, ('0x' || substr(hex, 25, 8))::BIGINT AS h4 FROM d
), c AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
  SELECT *, array_to_string(list_slice(units, 1, a), '') AS prefix, array_to_string(list_slice(units, a + 1, b), '') AS middle, array_to_string(list_slice(units, b + 1, n), '') AS suffix FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

OP13 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), r AS (
  SELECT *, strlen(h) >= 100 AND row_number() OVER (PARTITION BY h ORDER BY page_id NULLS LAST) > 1 AS again, min(page_id) OVER (PARTITION BY h) AS first_id FROM p
)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to FROM r
"""

ORACLES = {"op2_radix_dedup": OP2, "op3_line_dedup": OP3, "op4_lsh_forest": OP4, "op7_poisson_mix": OP7, "op8_exact_topk": OP8, "op9_url_filter": OP9, "op10_byte_shards": OP10, "op11_turn_repair": OP11,
           "op12_fim_arrow": OP12, "op13_warc": OP13}
