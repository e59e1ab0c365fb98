"""The queries in DuckDB SQL, where SQL can say them."""

from __future__ import annotations

from odotrack.llm.decontaminate import MIN_ITEM_TOKENS, MIN_PERCENT, MIN_TOKENS, WHOLE_TOKENS
from odotrack.llm.licenses import MIN_PERCENT as LICENSE_PERCENT
from odotrack.llm.licenses import SHINGLE, TEMPLATES
from odotrack.llm.quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS
from odotrack.llm.secret_scan import BASE, Rule
from odotrack.llm.secret_scan import RULES as SECRET_RULES
from odotrack.llm.vector_codes import ENTRIES, PARTS, SCALE

WORD = r"[^\x20\x09-\x0D]+"
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
_FAILED = ", ".join(
    "CASE WHEN "
    + " OR ".join(
        [f"{r.count} * 1000 < {r.total} * {r.low}"] * (r.low is not None)
        + [f"{r.count} * 1000 > {r.total} * {r.high}"] * (r.high is not None)
    )
    + f" THEN '{r.name}' END"
    for r in RULES
)



# Every pair of neighbouring tokens is a seed: an overlap that counts holds one, whatever the
# operator's masks. Best window of each alignment.
OP1 = rf"""
WITH d AS (SELECT DISTINCT doc_id, text, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') AS t FROM documents),
b AS (SELECT * FROM (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') AS t FROM benchmark)
      WHERE len(t) >= {MIN_ITEM_TOKENS}),
ds AS (SELECT doc_id, text, unnest(range(len(t) - 1)) AS pos,
              unnest(list_transform(range(len(t) - 1), lambda i: t[i + 1] || ' ' || t[i + 2])) AS seed FROM d),
bs AS (SELECT item_id, unnest(range(len(t) - 1)) AS item_at,
              unnest(list_transform(range(len(t) - 1), lambda i: t[i + 1] || ' ' || t[i + 2])) AS seed FROM b),
hits AS (SELECT DISTINCT doc_id, text, item_id, pos - item_at AS shift FROM ds JOIN bs USING (seed)),
e AS (SELECT hits.*, least({MIN_TOKENS}, len(b.t)) AS n,
             list_transform(range(greatest(0, -shift), least(len(b.t), len(d.t) - shift)),
                            lambda j: (b.t[j + 1] = d.t[j + shift + 1])::INT) AS equal
      FROM hits JOIN d USING (doc_id, text) JOIN b USING (item_id)),
w AS (SELECT doc_id, item_id, n, unnest(range(0, len(equal) - n + 1)) AS k, equal, greatest(0, -shift) + shift AS doc_at FROM e),
s AS (SELECT doc_id, item_id, n, doc_at + k AS doc_start, list_sum(equal[k + 1:k + n]) AS equal_tokens FROM w)
SELECT doc_id, item_id, max(equal_tokens)::BIGINT AS equal_tokens, arg_min(doc_start, (-equal_tokens, doc_start)) AS doc_start
FROM s WHERE equal_tokens * 100 >= n * CASE WHEN n <= {WHOLE_TOKENS} THEN 100 ELSE {MIN_PERCENT} END
GROUP BY doc_id, item_id"""

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM g) WHERE n > 1),
spots AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, coalesce(length(list_aggregate(w, 'string_agg', '')), 0) AS word_chars,
             length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
             len(lines) AS n_lines, len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
             len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines
      FROM w LEFT JOIN spots USING (r)),
v AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed,
             concat_ws(',', {_FAILED}) AS failed_rules FROM m)
SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM v"""

_TEMPLATES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
_RUN = " || ' ' || ".join(f"t[i + {k}]" for k in range(1, SHINGLE + 1))
# All templates have five tokens or more. Every window is compared with every template of its length.
OP5 = rf"""
WITH d AS (SELECT DISTINCT doc_id, text, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') AS t FROM documents),
l AS (SELECT license_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') AS t
      FROM (VALUES {_TEMPLATES}) AS v(license_id, text)),
ls AS (SELECT DISTINCT license_id, unnest(list_transform(range(len(t) - {SHINGLE - 1}), lambda i: {_RUN})) AS s FROM l),
n AS (SELECT license_id, count(*) AS of_template, (1 << ceil(log2(count(*) * 1.25))::INT) AS stride FROM ls GROUP BY 1),
ds AS (SELECT doc_id, text, unnest(range(len(t) - {SHINGLE - 1})) AS pos,
              unnest(list_transform(range(len(t) - {SHINGLE - 1}), lambda i: {_RUN})) AS s FROM d),
known AS (SELECT * FROM ds WHERE s IN (SELECT s FROM ls)),
w AS (SELECT doc_id, text, stride, s, pos, unnest([pos // stride, pos // stride - 1]) AS w
      FROM known, (SELECT DISTINCT stride FROM n)),
first AS (SELECT doc_id, text, stride, w, min(pos) AS position FROM w GROUP BY ALL),
hits AS (SELECT doc_id, text, stride, w, license_id, of_template, count(DISTINCT s) AS matched
         FROM w JOIN ls USING (s) JOIN n USING (license_id, stride) GROUP BY ALL)
SELECT doc_id, license_id, max(matched) AS matched, any_value(of_template) AS of_template,
       arg_min(position, (-matched, position)) AS position
FROM hits JOIN first USING (doc_id, text, stride, w)
WHERE matched * 100 >= of_template * {LICENSE_PERCENT} GROUP BY doc_id, license_id"""

OP8 = r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(replace(text, '\', '\\'), '<(\||/?s>|/?[0-9A-Za-z_]*_of_)', '<\\\1', 'g') AS t1 FROM m),
f AS (SELECT *, regexp_replace(t1, '\[(/?[A-Z_]+\])', '[\\\1', 'g') AS escaped FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, escaped)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, escaped) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(escaped) + length(role) + 16)::BIGINT AS formatted_chars,
       0::BIGINT AS expanded_tokens
FROM f GROUP BY conv_id"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT page_id, html, min(page_id) OVER (PARTITION BY html) AS first, (unhex(sha1(html))::BIT)::VARCHAR AS bits FROM p)
SELECT page_id, strlen(html) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT
            + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT
            + substr(bits, 5 * i + 5, 1)::INT)::INT, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM g"""


def _rule(rule: Rule) -> str:
    """(rule, kind, pattern in one group, group that is counted, least)."""
    head = f"(?i:{rule.pattern})" if rule.any_case else rule.pattern
    pattern = f"({head}({rule.body}))" if rule.body else f"({head})"
    if rule.kind == "hex":
        pattern = "([0-9a-f]+)"
    counted = 2 + rule.pattern.count("(") if rule.body else 1
    text = pattern.replace("'", "''")
    return f"({SECRET_RULES.index(rule)}, '{rule.kind}', '{text}', {counted}, {rule.least})"


_SECRETS = ", ".join(map(_rule, SECRET_RULES))
_BASE_KINDS = len(BASE)
_N_BASE = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
_OPEN, _CLOSE = "chr(57344)", "chr(57345)"  # private characters mark where matches begin and end
OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
p(rule, kind, pat, grp, least) AS (VALUES {_SECRETS}),
s AS (SELECT r, p.*, string_split(regexp_replace(text, pat, {_OPEN} || '\1' || {_CLOSE}, 'g'), {_OPEN}) AS parts FROM d, p),
u AS (SELECT * EXCLUDE parts, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM s WHERE len(parts) > 1),
m AS (SELECT *, string_split(part, {_CLOSE})[1] AS hit,
             sum(length(part) - (i > 0)::INT) OVER (PARTITION BY r, rule ORDER BY i) - length(part) + (i > 0)::INT AS start
      FROM u),
f AS (SELECT r, rule, kind, start::BIGINT AS start, kind || ':' || start::BIGINT || ':' || (start + length(hit))::BIGINT AS span
      FROM m WHERE i > 0 AND length(CASE grp WHEN 1 THEN hit WHEN 2 THEN regexp_extract(hit, pat, 2) ELSE regexp_extract(hit, pat, 3) END) >= least)
SELECT any_value(doc_id) AS doc_id, {_N_BASE},
       sha256(coalesce(string_agg(span, ',' ORDER BY start, rule) FILTER (rule < {_BASE_KINDS}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, rule), '') AS spans
FROM d LEFT JOIN f USING (r) GROUP BY r"""

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_FIELDS = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
# Bit by bit, for want of a function; the last bit decides.
_CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
    lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))))"""
_SIDES = """coalesce(string_agg(v.h, '' ORDER BY v.pos) FILTER (v.pos < own), '') AS before,
             coalesce(string_agg(v.h, '' ORDER BY v.pos) FILTER (v.pos > own), '') AS after"""
OP12 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, *, CASE WHEN {_CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS now
                     FROM documents),
l AS (SELECT r, doc_id, source, sha256({_FIELDS} || {_FIELD.format("text")}) AS leaf, sha256({_FIELDS} || {_FIELD.format("now")}) AS changed FROM d),
t AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY source) AS n FROM l),
tree AS (SELECT 0 AS level, source, pos, leaf AS h, n FROM t
         UNION ALL
         SELECT level + 1, source, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3)
         FROM tree WHERE n > 1 GROUP BY level, source, pos // 3),
tops AS (SELECT source, h AS subroot, level AS depth, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
         FROM tree WHERE n = 1),
over AS (SELECT 0 AS level, pos, subroot AS h, n FROM tops
         UNION ALL
         SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3)
         FROM over WHERE n > 1 GROUP BY level, pos // 3),
low AS (SELECT r, level AS step, {_SIDES}
        FROM (SELECT r, t.source, level, t.pos // pow(3, level)::BIGINT AS own
              FROM t JOIN tops ON tops.source IS NOT DISTINCT FROM t.source, (SELECT DISTINCT level FROM tree) WHERE level < depth) AS o
        JOIN tree v USING (level) WHERE v.source IS NOT DISTINCT FROM o.source AND v.pos // 3 = own // 3
        GROUP BY r, level, own),
high AS (SELECT source, depth + level AS step, {_SIDES}
         FROM (SELECT source, depth, level, pos // pow(3, level)::BIGINT AS own FROM tops, (SELECT DISTINCT level FROM over WHERE n > 1)) AS o
         JOIN over v USING (level) WHERE v.pos // 3 = own // 3 GROUP BY source, depth, level, own),
steps AS (SELECT * FROM low
          UNION ALL SELECT r, step, before, after FROM t JOIN high ON high.source IS NOT DISTINCT FROM t.source),
fold AS (SELECT r, 0 AS step, changed AS h FROM t
         UNION ALL SELECT r, step + 1, sha256(before || h || after) FROM fold JOIN steps USING (r, step)),
proofs AS (SELECT r, sha256(string_agg(before || after, '' ORDER BY step)) AS proof FROM steps GROUP BY r),
roots AS (SELECT r, arg_max(h, step) AS folded_root FROM fold GROUP BY r)
SELECT doc_id, leaf, subroot, over.h AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = over.h AS verified
FROM t JOIN tops ON tops.source IS NOT DISTINCT FROM t.source JOIN over ON over.n = 1 LEFT JOIN proofs USING (r) JOIN roots USING (r)"""

_NEAREST = """SELECT r, p, arg_min(e, (apart, e)) AS e, min(apart) AS apart
       FROM (SELECT r, p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS apart
             FROM x JOIN {0} USING (p)) GROUP BY r, p"""
_MOVED = """SELECT p, e, coalesce(m.c, {0}.c) AS c FROM {0} LEFT JOIN
       (SELECT p, e, list(mean ORDER BY i) AS c
        FROM (SELECT p, e, i, floor(sum(v)::DOUBLE / count(*))::BIGINT AS mean
              FROM (SELECT p, e, unnest(x) AS v, unnest(range(len(x))) AS i FROM x JOIN {1} USING (r, p)) GROUP BY p, e, i)
        GROUP BY p, e) AS m USING (p, e)"""
OP13 = f"""
WITH k AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda v: floor(v::DOUBLE * {SCALE})::BIGINT) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS (SELECT r, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS x FROM k, range({PARTS}) AS t(p)),
c0 AS (SELECT p, e, x AS c FROM x JOIN (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM k QUALIFY e < {ENTRIES}) USING (r)),
a1 AS ({_NEAREST.format("c0")}),
c1 AS ({_MOVED.format("c0", "a1")}),
a2 AS ({_NEAREST.format("c1")}),
c2 AS ({_MOVED.format("c1", "a2")}),
a3 AS ({_NEAREST.format("c2")}),
coded AS (SELECT r, string_agg(printf('%02x', e::INT), '' ORDER BY p) AS code, sum(apart)::BIGINT AS error FROM a3 GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM c2) AS codebooks_sha256
FROM k JOIN coded USING (r)"""

ORACLES: dict[str, str] = {
    "op1_decontaminate": OP1,
    "op4_quality_rules": OP4,
    "op5_licenses": OP5,
    "op6_warc_zip": OP6,
    "op8_chat_format": OP8,
    "op11_secret_scan": OP11,
    "op12_merkle": OP12,
    "op13_vector_codes": OP13,
}
