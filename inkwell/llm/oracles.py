"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

from .mixing import SEED as MIX_SEED
from .quality_rules import RULES
from .sharding import SEED as SHARD_SEED

_WORD = r"[^\x20\x09-\x0D]+"


def _key(column: str, seed: int) -> str:
    """ranks.hash_key, as the whole number of 52 bits that it divides."""
    return f"('0x' || substr(md5('{seed}|' || coalesce({column}::VARCHAR, '')), 1, 13))::BIGINT"


def _crc_table() -> str:
    """The table of the CRC-32 of the reversed polynomial 0xEDB88320, made by its rule."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return f"({out}::BIGINT[])"


def _crc32(text: str) -> str:
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, {_crc_table()}[(xor(c, b) & 255) + 1])), 4294967295)"


_PRIOR = ", ".join(
    f"(sum({r}) + 0.5) / (sum(n) + 1.0) AS m_{r}, greatest(avg(({r} / n::DOUBLE) ** 2) - avg({r} / n::DOUBLE) ** 2 - (sum({r}) + 0.5) / (sum(n) + 1.0) * (1 - (sum({r}) + 0.5) / (sum(n) + 1.0)) * avg(1.0::DOUBLE / n), 1e-6::DOUBLE) AS v_{r}"
    for r in RULES
)
_SHRUNK = ", ".join(f"({r} + m_{r} * least(greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 1.0), 10000.0)) / (n + least(greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 1.0), 10000.0))" for r in RULES)

OP1 = f"""
WITH d AS MATERIALIZED (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, range(8) AS v(j) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{_WORD}') GROUP BY doc_id),
s AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)),
h AS (SELECT source, count(*) AS n, {', '.join(f'sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS {r}' for r, cond in RULES.items())} FROM s GROUP BY source),
p AS (SELECT {_PRIOR} FROM h),
v AS (SELECT source, greatest({_SHRUNK}) AS worst FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND worst <= 0.5 AS kept, round(worst, 6) AS host_worst_rate
FROM s JOIN v ON s.source IS NOT DISTINCT FROM v.source"""

OP5 = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS key, coalesce('s' || source, '') AS s, coalesce(text, '') AS t FROM documents),
e AS (SELECT doc_id, s, (octet_length(encode(t)) + 1)::BIGINT AS size, {_crc32('t')} AS text_crc32 FROM d),
r AS (SELECT *, (row_number() OVER (PARTITION BY s ORDER BY {_key('doc_id', SHARD_SEED)}, doc_id, text_crc32, size) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY s) AS share FROM e),
p AS (SELECT *, row_number() OVER (ORDER BY share, {_key('s', SHARD_SEED)}, s, doc_id, text_crc32, size) - 1 AS place, count(*) OVER () AS n FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place * 16 // n)::INTEGER AS shard, (place - (place * 16 // n * n + 15) // 16)::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM p"""

OP9 = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size, {_key('doc_id', MIX_SEED)} AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w, source_size * 2.0::DOUBLE AS cap FROM s),
o AS (SELECT *, cap / w AS level, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS i FROM w),
f AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS water FROM o),
t AS (SELECT source, source_size, least(cap, w * (SELECT arg_min(water, i) FROM f WHERE water <= level)) AS target FROM f),
b AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d),
e AS (SELECT b.doc_id, b.size, b.before, t.source_size, t.target, floor(t.target)::BIGINT AS goal, CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS epochs FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, goal - epochs * source_size - before)))::BIGINT AS taken FROM e"""

OP6 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""

# all pairs of a label: exact where the operator's forest has one leaf, as on small tables
OP8 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
k AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, k.b FROM r JOIN k ON r.b = k.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM k GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id"""

_BLANK = r"[^\x20\x09-\x0D]"


def _arc(letter: str, cost: str, line: str, state: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t{line}}}"


def _insert(role: str, state: str) -> str:
    return _arc("I", "3", f" || chr(10) || '{role}:'", state)


def _row_arcs(state: int) -> str:
    """Least of the edits that read a row and end in a state: Delete, Keep and Rerole where its grammar allows them."""
    came = {1: [0], 2: [0, 1, 3], 3: [2]}.get(state, [])
    initial, role = {1: ("s", None), 2: ("u", "user"), 3: ("a", "assistant")}.get(state, (None, None))
    arcs = [_arc("D", "4", "", f"b{state}")]
    for q in came:
        arcs.append(f"CASE WHEN stays AND ini = '{initial}' THEN {_arc('K', 'more', ' || chr(10) || line', f'b{q}')} END")
        if role:
            arcs.append(f"CASE WHEN stays THEN {_arc('R', '3 + more', f' || chr(10) || {chr(39)}{role}:{chr(39)} || text', f'b{q}')} END")
    return f"least({', '.join(arcs)})" if len(arcs) > 1 else arcs[0]


# least (cost, letters) by state, row by row; the operator goes both ways and walks tight arcs instead
_FAR = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"
_ZERO = "{'c': 0::BIGINT, 'a': '', 't': ''}"
_CLOSED = f"n0 AS b0, n1 AS b1, n2x AS b2, least(n3, {_insert('assistant', 'n2x')}) AS b3"
_WIDER = f"least(n2, {_insert('user', 'n0')}, {_insert('user', 'n1')}, {_insert('user', 'n3')}) AS n2x"

OP11 = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
h AS (SELECT *, ({_crc32('key')} % 20)::INTEGER AS h FROM k),
g AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE h <> 0),
n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM g),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, left(role, 1) AS ini, list_last(regexp_extract_all(text, '{_BLANK}')) AS final FROM n),
m AS MATERIALIZED (SELECT conv_id, turn, i, ini, text, role || ':' || text AS line, CASE WHEN final IS NULL THEN 'blank' WHEN again THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault, fault IN ('truncated', 'fine') AS stays, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more,
  coalesce(lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS illegal FROM o),
z AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM m GROUP BY conv_id),
r AS (SELECT conv_id, 0::BIGINT AS i, {_CLOSED} FROM (SELECT *, {_WIDER} FROM (SELECT DISTINCT conv_id, {_ZERO} AS n0, {_FAR} AS n1, {_FAR} AS n2, {_FAR} AS n3 FROM m))
  UNION ALL SELECT conv_id, i, {_CLOSED} FROM (SELECT *, {_WIDER} FROM (SELECT m.conv_id, m.i, {_row_arcs(0)} AS n0, {_row_arcs(1)} AS n1, {_row_arcs(2)} AS n2, {_row_arcs(3)} AS n3 FROM r JOIN m ON m.conv_id IS NOT DISTINCT FROM r.conv_id AND m.i = r.i + 1))),
e AS (SELECT z.*, least(r.b0, r.b3) AS best FROM z JOIN r ON z.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = z.n),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM c LEFT JOIN e ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""

_DRAWS = ", ".join(f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))

OP12 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, {_DRAWS}, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, len(u)::BIGINT AS n FROM d),
c AS (SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form, u, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM u),
p AS (SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""

ORACLES = {"op1_host_quality_rules": OP1, "op5_stratified_shards": OP5, "op6_warc_boundary_chain": OP6, "op8_projection_forest": OP8, "op9_weighted_mix": OP9, "op11_tight_arc_repair": OP11, "op12_bit_parallel_fim": OP12}
