"""DuckDB SQL of the queries that SQL can express.  It shares parameters and
patterns with the operators; the work is expressed anew."""

from __future__ import annotations

from tessera.llm import decontam, quality, secrets

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}')"


OP10 = """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS g FROM pages),
m AS (SELECT g, max(page_id) AS target FROM d WHERE n >= 1000 GROUP BY g)
SELECT page_id, n AS payload_bytes, d.g AS payload_digest,
  CASE WHEN target <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN target <> page_id THEN target END AS refers_to
FROM d LEFT JOIN m ON d.g = m.g AND n >= 1000
"""

OP9 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({lower('text')}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS ss FROM w),
n AS (SELECT doc_id, len(ss) AS n FROM s),
u AS (SELECT doc_id, unnest(ss) AS sh FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT doc_id, any_value(n.n) AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept
FROM r JOIN n USING (doc_id) GROUP BY doc_id
"""

OP7 = rf"""
WITH iw AS (SELECT item_id, regexp_extract_all({lower('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
b AS (SELECT DISTINCT item_id, least(len(ws), {decontam.WINDOW}) AS k, array_to_string(ws[i:i + {decontam.WINDOW - 1}], ' ') AS t
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {decontam.WINDOW - 2}, 2))) AS i FROM iw WHERE len(ws) > 0)),
dw AS (SELECT doc_id, regexp_extract_all({lower('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
o AS (SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS t
      FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM b))),
f AS (SELECT doc_id, i, k, item_id FROM o JOIN b USING (t, k)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM f) GROUP BY doc_id),
g AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM f GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
  sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)
"""


def _any_case(pattern: str) -> str:
    """An ASCII-only (?i:...) written out."""
    end = pattern.index("))") + 1
    head, rest = pattern[len("(?i:"):end], pattern[end + 1:]
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in head) + rest


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _kind(k: int, pattern: str, value: str, keep: str) -> str:
    return f"""
m{k} AS (SELECT row_id, unnest(range(1, len(m) + 1)) AS i, m, g FROM (
    SELECT row_id, regexp_extract_all(text, {_sql(pattern)}) AS m, string_split_regex(text, {_sql(pattern)}) AS g FROM d)),
k{k} AS (SELECT row_id, {k} AS kind, s AS start, s + length(m[i]) AS stop, {value} AS v FROM (
    SELECT *, coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s FROM m{k}) WHERE {keep})"""


_ASSIGN = _any_case(secrets.ASSIGN)
_VALUE = f"regexp_extract(m[i], {_sql(_ASSIGN)}, 2)"
_NAMED = "CASE kind " + " ".join(f"WHEN {k} THEN '{name}'" for k, name in enumerate(secrets.KINDS)) + " END || ':' || start::BIGINT || ':' || stop::BIGINT"
OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repository FROM documents),
{_kind(0, _ASSIGN, _VALUE, f"length({_VALUE}) >= {secrets.MIN_ASSIGNED}")},
{_kind(1, secrets.ACCESS, "m[i]", "true")},
{_kind(2, secrets.HEX, "m[i]", "true")},
{_kind(3, secrets.TOKEN, "m[i]", "regexp_matches(m[i], '[0-9]') AND regexp_matches(m[i], '[a-z]') AND regexp_matches(m[i], '[A-Z]')")},
s AS (SELECT * FROM k0 UNION ALL SELECT * FROM k1 UNION ALL SELECT * FROM k2 UNION ALL SELECT * FROM k3),
own AS (SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT owner || chr(1) || repository) AS repositories FROM s JOIN d USING (row_id) GROUP BY v),
ent AS (SELECT v, -sum(n / length(v) * log2(n / length(v))) AS bits FROM (
    SELECT v, c, count(*) AS n FROM (SELECT v, unnest(string_split(v, '')) AS c FROM own) GROUP BY v, c) GROUP BY v),
j AS (SELECT s.*, owners <= 2 AND repositories <= 4 AND bits >= 2.5 AND NOT regexp_matches(v, {_sql(secrets.PLACEHOLDERS)}) AS live
      FROM s JOIN own USING (v) JOIN ent USING (v)),
a AS (SELECT row_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg({_NAMED}, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg({_NAMED}, ',' ORDER BY start, kind) FILTER (kind < 3 OR live) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (kind < 3 AND NOT live) AS n_example FROM j GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN a USING (row_id)
"""


def _list(words: list[str]) -> str:
    return "[" + ", ".join(_sql(w) for w in words) + "]"


def _distance(p: str, q: str) -> str:
    a, b = f"z[1] / list_sum({p})", f"z[2] / list_sum({q})"
    half = f"(({a}) + ({b})) / 2"

    def term(x):
        return f"CASE WHEN {x} > 0 THEN ({x}) * log2(({x}) / ({half})) ELSE 0 END"
    return f"sqrt(greatest(list_sum(list_transform(list_zip({p}, {q}), lambda z: ({term(a)} + {term(b)}) / 2)), 0))"


def _op1(min_chars=200, min_tokens=50, min_docs=20, char_limit=0.16, word_limit=0.15, char_allowance=1.6, word_allowance=1.6) -> str:
    lists = " ".join(f"WHEN {_sql(k)} THEN {_list(v)}" for k, v in quality.COMMON.items())
    counts = ", ".join(f"length(c) - length(regexp_replace(c, {_sql(p + '+')}, '', 'g'))" for p in quality.CLASSES.values())

    def share(x, total):
        return f"list_transform(list_append({x}, {total} - list_sum({x})), lambda x: floor(x * {quality.SCALE} / {total})::BIGINT)"

    def refs(name, source):
        return f"""{name}b AS (
    SELECT lang, 'c' AS kind, unnest(range(1, len(cs) + 1)) AS bin, unnest(cs) AS x FROM {source} WHERE n_chars >= {min_chars}
    UNION ALL SELECT lang, 'w', unnest(range(1, len(ts) + 1)), unnest(ts) FROM {source} WHERE n_tokens >= {min_tokens}),
{name} AS (SELECT lang, list(x::DOUBLE ORDER BY bin) FILTER (kind = 'c' AND n >= {min_docs}) AS rc, list(x::DOUBLE ORDER BY bin) FILTER (kind = 'w' AND n >= {min_docs}) AS rw
    FROM (SELECT lang, kind, bin, sum(x) AS x, count(*) AS n FROM {name}b GROUP BY ALL) GROUP BY lang)"""

    def judged(name, ref):
        return f"""{name}d AS (SELECT f.*, CASE WHEN n_chars >= {min_chars} THEN {_distance('cs', 'rc')} END AS dc, CASE WHEN n_tokens >= {min_tokens} THEN {_distance('ts', 'rw')} END AS dw
    FROM f LEFT JOIN {ref} USING (lang)),
{name} AS (SELECT *, NOT failed AND NOT coalesce(dc > {char_limit} + {char_allowance} / sqrt(n_chars), false) AND NOT coalesce(dw > {word_limit} + {word_allowance} / sqrt(n_tokens), false) AS kept FROM {name}d)"""

    return rf"""
WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, lang, coalesce(text, '') AS text,
    CASE lang {lists} ELSE {_list(quality.ANY)} END AS own FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS c,
    list_filter(string_split_regex(lower(text), {_sql(quality.TOKEN_BREAK)}), lambda x: x <> '') AS tk,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, array_to_string(ws[i:i + 4], ' ')) AS n FROM (SELECT row_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT row_id, count(DISTINCT j) AS n FROM (SELECT row_id, unnest(range(i, i + 5)) AS j FROM g WHERE n > 1) GROUP BY row_id),
q AS (SELECT row_id, doc_id, lang, len(ws) AS n_words, length(c) AS word_chars, [{counts}] AS cl, length(text) AS n_chars, len(tk) AS n_tokens, coalesce(rep.n, 0) AS n_repeat_words,
    list_transform(own, lambda x: len(list_filter(tk, lambda y: y = x))) AS tw, len(ls) - len(list_distinct(ls)) AS n_dup_lines FROM w LEFT JOIN rep USING (row_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS failed, {share('list_prepend(n_chars - word_chars, cl)', 'n_chars')} AS cs, {share('tw', 'n_tokens')} AS ts FROM q),
{refs('r0', '(SELECT * FROM f WHERE NOT failed)')},
{judged('j0', 'r0')},
{refs('r1', '(SELECT * FROM j0 WHERE kept)')},
{judged('j1', 'r1')}
SELECT doc_id, n_words, word_chars, cl[1] AS n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed, kept,
  round(dc, 6) AS char_distance, round(dw, 6) AS word_distance FROM j1
"""


OP1 = _op1()


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's bytes (DuckDB has none)."""
    step = "lambda c, z: xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), {step})"
    digits = f"list_transform(range(1, 2 * octet_length(encode({text})) + 1, 2), lambda i: ('0x' || hex(encode({text}))[i:i + 1])::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {digits}), lambda a, b: {byte}))"


def field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


_FIELDS = " || ".join(field(f"{c}::VARCHAR") for c in ("doc_id", "source", "lang", "n_chars"))
_KEPT = "CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END".format(crc=crc32("doc_id::VARCHAR"))

OP13 = f"""
WITH RECURSIVE f AS (SELECT doc_id, source, sha256({_FIELDS} || {field('text')}) AS leaf, sha256({_FIELDS} || {field('kept')}) AS tampered
  FROM (SELECT *, {_KEPT} AS kept FROM documents)),
l AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS id,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM f),
t AS (SELECT 0 AS level, source, pos, leaf AS digest, n FROM l UNION ALL
  SELECT level + 1, source, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 2) // 3) FROM t WHERE n > 1 GROUP BY level, source, pos // 3),
sub AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS level, pos, digest, n FROM sub UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 2) // 3) FROM u WHERE n > 1 GROUP BY level, pos // 3),
tr AS (SELECT level, source, pos // 3 AS p, list(digest ORDER BY pos) AS ds FROM t WHERE n > 1 GROUP BY ALL),
ur AS (SELECT level, pos // 3 AS p, list(digest ORDER BY pos) AS ds FROM u WHERE n > 1 GROUP BY ALL),
a AS (SELECT id, source, 0 AS level, pos, tampered AS node, '' AS proof FROM l UNION ALL
  SELECT id, a.source, a.level + 1, pos // 3, sha256(array_to_string(list_concat(ds[:pos % 3], [node], ds[pos % 3 + 2:]), '')),
    proof || array_to_string(list_concat(ds[:pos % 3], ds[pos % 3 + 2:]), '')
  FROM a JOIN tr ON tr.level = a.level AND tr.source IS NOT DISTINCT FROM a.source AND tr.p = pos // 3),
b AS (SELECT id, 0 AS level, sub.pos, node, proof FROM (SELECT id, arg_max(node, level) AS node, arg_max(proof, level) AS proof, any_value(source) AS source
    FROM a GROUP BY id) x JOIN sub ON sub.source IS NOT DISTINCT FROM x.source UNION ALL
  SELECT id, b.level + 1, pos // 3, sha256(array_to_string(list_concat(ds[:pos % 3], [node], ds[pos % 3 + 2:]), '')),
    proof || array_to_string(list_concat(ds[:pos % 3], ds[pos % 3 + 2:]), '')
  FROM b JOIN ur ON ur.level = b.level AND ur.p = pos // 3),
r AS (SELECT digest AS root FROM u WHERE n = 1)
SELECT doc_id, leaf, sub.digest AS subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM (SELECT id, arg_max(node, level) AS node, arg_max(proof, level) AS proof FROM b GROUP BY id) x JOIN l USING (id)
JOIN sub ON sub.source IS NOT DISTINCT FROM l.source CROSS JOIN r
"""


_SHOWN = "coalesce({0}::VARCHAR, ' ')"
_KEY = crc32("(" + _SHOWN.format("conv_id") + " || ':' || " + _SHOWN.format("turn") + ")")

OP11 = rf"""
WITH RECURSIVE h AS (SELECT conv_id, turn, {_SHOWN.format('role')} AS role, {_SHOWN.format('text')} AS text, {_KEY} % 20 AS h FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
  CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) FROM h WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(len(role) || ':' || role || text)) AS i,
  count(*) OVER (PARTITION BY conv_id) AS n, regexp_replace(text, '[ 	-
]+$', '') AS body FROM d),
f AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS x,
  left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM o),
g AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS free, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS m FROM f),
v AS (SELECT conv_id, n + 1 AS i, 0 AS e, 6 AS s, 3 AS u, 0 AS a FROM (SELECT DISTINCT conv_id, n FROM g) UNION ALL
  SELECT conv_id, i, least(re, 3 + least(ru, 3 + ra)), least(rs, 3 + least(ru, 3 + ra)), least(ru, 3 + ra), least(ra, 3 + ru) FROM (
    SELECT v.conv_id, g.i, least(4 + e, CASE WHEN NOT free THEN 999999 WHEN x = 's' THEN least(m + s, 3 + m + u) WHEN x = 'u' THEN m + u ELSE 3 + m + u END) AS re,
      least(4 + s, CASE WHEN NOT free THEN 999999 WHEN x = 'u' THEN m + u ELSE 3 + m + u END) AS rs,
      least(4 + u, CASE WHEN NOT free THEN 999999 WHEN x = 'a' THEN m + a ELSE 3 + m + a END) AS ru,
      least(4 + a, CASE WHEN NOT free THEN 999999 WHEN x = 'u' THEN m + u ELSE 3 + m + u END) AS ra
    FROM v JOIN g ON g.conv_id IS NOT DISTINCT FROM v.conv_id AND g.i = v.i - 1)),
c AS (SELECT conv_id, i, [e, s, u, a] AS c FROM v),
st AS (SELECT a.conv_id, a.i, a.c, b.c AS after, role, text, free, m, x FROM c a LEFT JOIN c b ON b.conv_id IS NOT DISTINCT FROM a.conv_id AND b.i = a.i + 1
  LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM a.conv_id AND g.i = a.i),
w AS (SELECT DISTINCT conv_id, 1::BIGINT AS i, 1 AS k, '' AS audit, []::VARCHAR[] AS rows, 0 AS step FROM c UNION ALL
  SELECT conv_id, CASE WHEN op = 'I' THEN i ELSE i + 1 END, CASE op WHEN 'D' THEN k WHEN 'K' THEN kept ELSE into_ END, audit || op,
    CASE op WHEN 'D' THEN rows WHEN 'K' THEN list_append(rows, role || ':' || text)
      ELSE list_append(rows, CASE WHEN into_ = 3 THEN 'user:' ELSE 'assistant:' END || CASE WHEN op = 'R' THEN text ELSE '' END) END, step + 1
  FROM (SELECT *, CASE WHEN after IS NULL AND k IN (1, 4) THEN NULL WHEN 4 + after[k] = c[k] THEN 'D' WHEN 3 + c[into_] = c[k] THEN 'I'
      WHEN kept IS NOT NULL AND m + after[kept] = c[k] THEN 'K' ELSE 'R' END AS op
    FROM (SELECT w.*, st.c, after, role, text, m, CASE WHEN k = 3 THEN 4 ELSE 3 END AS into_,
        CASE WHEN NOT free THEN NULL WHEN x = 's' AND k = 1 THEN 2 WHEN x = 'u' AND k <> 3 THEN 3 WHEN x = 'a' AND k = 3 THEN 4 END AS kept
      FROM w JOIN st ON st.conv_id IS NOT DISTINCT FROM w.conv_id AND st.i = w.i)) WHERE op IS NOT NULL),
e AS (SELECT conv_id, arg_max(audit, step) AS audit, arg_max(rows, step) AS rows FROM w GROUP BY conv_id),
q AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id)
SELECT z.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(c[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(rows, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) z LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM z.conv_id
LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM z.conv_id LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM z.conv_id AND c.i = 1
"""
