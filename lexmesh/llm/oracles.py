"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import licenses, urls

A_TO_Z = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all(" + A_TO_Z.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) > 0),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE c >= 0.8 * (na + nb - c) - 1e-9),
r(v, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.v),
c AS (SELECT v, min(root) AS class_id FROM r GROUP BY 1),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY 1)
SELECT v AS doc_id, class_id, coalesce(n_links, 0) AS n_links, v = class_id AS kept FROM c LEFT JOIN n ON a = v
"""

OP9 = """
WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
r(v, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.v),
c AS (SELECT v, min(root) AS component_id FROM r GROUP BY 1),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY 1)
SELECT v AS vec_id, coalesce(n_links, 0) AS n_links, component_id, v = component_id AS kept FROM c LEFT JOIN n ON a = v
"""


#: Bytes are pairs of hex digits here; windows are compared by two hashes of theirs.
OP2 = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
w AS (SELECT doc_id, i, hash(s) AS k, hash(s || 'x') AS k2 FROM (SELECT doc_id, i, substr(h, 2 * i + 1, 400) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 199, 0))) AS i FROM b))),
r AS (SELECT doc_id, i FROM w JOIN (SELECT k, k2 FROM w GROUP BY 1, 2 HAVING count(*) > 1) USING (k, k2)),
o AS (SELECT *, coalesce((i > lag(i) OVER d + 200)::INT, 1) AS begins FROM r WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
u AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM o) GROUP BY doc_id, run),
g AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS after FROM u),
c AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, (2 * after + 1)::BIGINT, (2 * (a - after))::BIGINT), '' ORDER BY a) || substr(any_value(h), (2 * max(z) + 1)::BIGINT) AS kept FROM g JOIN b USING (doc_id) GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM b LEFT JOIN c USING (doc_id)
"""


def _op6() -> str:
    kinds, grams = licenses.template_grams()
    quoted = lambda x: "NULL" if x is None else f"'{x}'"
    return f"""
WITH kinds(tpl, label, base, words) AS (VALUES {", ".join(f"({t}, '{label}', {base}, {n})" for t, label, base, n in kinds)}),
t(tpl, tpos, a, b, c) AS (VALUES {", ".join(f"({t}, {i}, '{a}', '{b}', {quoted(c)})" for t, i, a, b, c in grams)}),
w AS (SELECT doc_id, {WORDS} AS w FROM documents),
g AS (SELECT doc_id, i - 1 AS pos, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM w)),
h AS (SELECT doc_id, tpl, pos, tpos, pos - tpos AS diag FROM g JOIN t ON g.a = t.a AND g.b = t.b AND (t.c IS NULL OR t.c = g.c)),
o AS (SELECT *, coalesce((diag - lag(diag) OVER l > CASE WHEN base THEN 0 ELSE {licenses.NEAR} END)::INT, 1) AS begins FROM h JOIN kinds USING (tpl) WINDOW l AS (PARTITION BY doc_id, tpl ORDER BY diag, pos)),
r AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id, tpl ORDER BY diag, pos ROWS UNBOUNDED PRECEDING) AS run, CASE WHEN base THEN {licenses.BASE_GRAM} ELSE {licenses.GRAM} END AS k FROM o),
i AS (SELECT *, tpos > coalesce(max(tpos) OVER (PARTITION BY doc_id, tpl, run ORDER BY pos, tpos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS counts FROM r),
n AS (SELECT *, least(k, coalesce(lead(tpos) OVER (PARTITION BY doc_id, tpl, run, counts ORDER BY tpos, pos) - tpos, k)) AS adds FROM i),
m AS (SELECT doc_id, label, base, words, min(diag) AS diag, sum(adds) FILTER (counts) / words AS cover, max(pos) + any_value(k) - min(pos) <= {licenses.LONGER} * words AS fits FROM n GROUP BY doc_id, tpl, run, label, base, words),
f AS (SELECT *, base AND cover = 1 AS whole, (base AND cover = 1) OR (NOT base AND fits AND cover >= {licenses.COVER}) AS valid FROM m),
d AS (SELECT doc_id, count(*) FILTER (whole) AS n_base, min(diag) FILTER (whole) AS first_word, max(diag) FILTER (whole) AS last_word, array_to_string(list_sort(list(DISTINCT label) FILTER (whole)), ',') AS base_labels, array_to_string(list_sort(list(DISTINCT label) FILTER (valid)), ',') AS labels, max(CASE WHEN whole OR (NOT base AND fits) THEN cover ELSE 0 END) AS score FROM f GROUP BY 1)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score FROM w LEFT JOIN d USING (doc_id)
"""


def _op8() -> str:
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    ordered = sorted(urls.RULES, key=lambda r: (-len(r[1] + r[2]), r))
    case = lambda of: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{of((v, h, p))}'" for v, h, p in ordered) + " END"
    rounds = ""
    for k in range(1, urls.ROUNDS + 1):
        rounds += f"m{k} AS (SELECT kind, host, sum(mass) AS mass FROM (SELECT e.kind, e.dst AS host, m.mass * e.share * {urls.DAMPING} AS mass FROM m{k - 1} m JOIN e ON e.kind = m.kind AND e.src = m.host UNION ALL SELECT kind, host, mass * (1 - {urls.DAMPING}) FROM m0) GROUP BY 1, 2), "
    return f"""
WITH p0 AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p1 AS (SELECT page_id, html, {A_TO_Z.format("regexp_extract(rest, '^[^/?#]*')")} AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p0),
p AS (SELECT *, {case(lambda r: r[1] + r[2])} AS rule, {case(lambda r: r[0])} AS v FROM p1),
h AS (SELECT host, count(*) AS n, count(*) FILTER (v = 'allow') AS a, count(*) FILTER (v = 'block') AS b FROM p WHERE host <> '' GROUP BY 1),
links AS (SELECT host AS src, {A_TO_Z.format("unnest(regexp_extract_all(coalesce(html, ''), '(?i)href\\s*=\\s*[\"'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"''\\s>]+)', 1))")} AS dst FROM p WHERE host <> ''),
parts AS (SELECT string_split(host, '.') AS q FROM h WHERE host LIKE '%.%.%'),
chain AS (SELECT DISTINCT array_to_string(q[i:], '.') AS a, array_to_string(q[i + 1:], '.') AS b FROM (SELECT q, unnest(range(1, len(q) - 1)) AS i FROM parts)),
w AS (SELECT src, dst, sum(x) AS x FROM (SELECT src, dst, 1.0::DOUBLE AS x FROM links WHERE src <> dst AND dst <> '' UNION ALL SELECT a, b, 1.0 FROM chain UNION ALL SELECT b, a, 1.0 FROM chain) GROUP BY 1, 2),
k AS (SELECT 'trust' AS kind, src, dst, x FROM w UNION ALL SELECT 'distrust', dst, src, x FROM w),
e AS MATERIALIZED (SELECT kind, src, dst, x / sum(x) OVER (PARTITION BY kind, src) AS share FROM k),
m0 AS MATERIALIZED (SELECT 'trust' AS kind, host, a / n AS mass FROM h WHERE a > 0 UNION ALL SELECT 'distrust', host, b / n FROM h WHERE b > 0),
{rounds}
z AS (SELECT host, coalesce(sum(mass) FILTER (kind = 'distrust'), 0) > coalesce(sum(mass) FILTER (kind = 'trust'), 0) AS bad FROM m{urls.ROUNDS} GROUP BY 1)
SELECT page_id, p.host, path, rule, coalesce(v, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict FROM p LEFT JOIN z ON z.host = p.host
"""


ORACLES = {"op1_ngrams": OP1, "op2_suffixes": OP2, "op6_licenses": _op6(), "op8_urls": _op8(), "op9_embeddings": OP9}
