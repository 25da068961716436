"""DuckDB twins of the training-data queries that SQL can express on whole tables."""

from __future__ import annotations

from tixprep.llm.licenses import LINES_JOINED, TEMPLATES, THRESHOLD
from tixprep.llm.pii import ADDED_KINDS, BASE_KINDS, CONTEXT, CONTEXT_BONUS, CONTEXT_WIDTH, KEEP_SCORE, START_SCORE

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def decontaminate(percent: int = 5, window: int = 13) -> str:
    return f"""WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS id, {_WORDS.format(_LOWER.format('text'))} AS w FROM benchmark),
win AS (SELECT DISTINCT id, least({window}, len(w)) AS n, array_to_string(w[j : j + least({window}, len(w)) - 1], ' ') AS k
        FROM (SELECT id, w, unnest(range(1, greatest(len(w) - {window - 1}, 1) + 1)) AS j FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS w FROM documents),
dwin AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS k
         FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM dw, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, p, n, id FROM dwin JOIN win USING (n, k)),
hw AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hits)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND coalesce(n_hit, 0) * 100 >= len(w) * {percent} AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN its USING (doc_id)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licenses() -> str:
    clean = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    grams = "list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))"
    values = ", ".join(f"({_quoted(name)}, {_quoted(t)})" for name, texts in TEMPLATES.items() for t in texts)
    return f"""WITH t AS (SELECT license, {grams} AS tg FROM (SELECT license, string_split({clean.format('body')}, ' ') AS ws FROM (VALUES {values}) AS v(license, body))),
ln AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: {clean.format('x')}) AS ls FROM documents WHERE text IS NOT NULL),
un AS (SELECT doc_id, line, k, ls FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS line FROM ln), (SELECT unnest(range(1, {LINES_JOINED + 1})) AS k) WHERE line + k <= len(ls)
       UNION ALL SELECT doc_id, 0, len(ls), ls FROM ln WHERE len(ls) > {LINES_JOINED}),
uw AS (SELECT doc_id, line, k, list_filter(string_split(array_to_string(ls[line + 1 : line + k], ' '), ' '), lambda x: x <> '') AS ws FROM un),
ug AS (SELECT doc_id, line, k, {grams} AS ug FROM uw WHERE len(ws) > 1),
f AS (SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(ug, tg)) / (len(ug) + len(tg)) AS dice, line, k FROM ug, t
      WHERE 2.0::DOUBLE * len(list_intersect(ug, tg)) / (len(ug) + len(tg)) >= {THRESHOLD}),
a AS (SELECT doc_id, first(license ORDER BY dice DESC, license, line, k) AS license, max(dice) AS dice, count(*) AS n_found,
             string_agg(license || ':' || line || ':' || k, ',' ORDER BY dice DESC, license, line, k) AS found FROM f GROUP BY doc_id)
SELECT doc_id, a.license, a.dice, coalesce(a.n_found, 0)::BIGINT AS n_found, coalesce(a.found, '') AS found FROM documents LEFT JOIN a USING (doc_id)"""


# The same spans as pii.PATTERNS, in the spelling of an engine without look-around.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": r"[0-9](?:[ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]", "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"}


def pii() -> str:
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(string_split(reverse({digits}), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN c::INTEGER "
            f"ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][c::INTEGER + 1] END)) % 10 = 0")
    flat = "replace(m, ' ', '')"
    mod97 = (f"list_reduce([0::BIGINT] || list_transform(string_split(substr({flat}, 5) || substr({flat}, 1, 4), ''), lambda c: ascii(c)::BIGINT), "
             f"lambda a, c: CASE WHEN c < 58 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END) = 1")
    valid = {"email": "TRUE", "ip": "list_max(list_transform(string_split(m, '.'), lambda p: CASE WHEN length(ltrim(p, '0')) > 3 THEN 999 ELSE p::HUGEINT END)) <= 255",
             "card": f"CASE WHEN length({digits}) BETWEEN 16 AND 19 THEN {luhn} ELSE FALSE END", "phone": f"length({digits}) BETWEEN 8 AND 15",
             "iban": f"CASE WHEN length({flat}) BETWEEN 15 AND 34 THEN {mod97} ELSE FALSE END",
             "ssn": "NOT regexp_matches(m, '^(?:000|666|9)') AND NOT regexp_matches(m, '-00-|-0000$')"}
    parts = []
    for order, kind in enumerate(BASE_KINDS + ADDED_KINDS):
        parts.append(f"""SELECT doc_id, {order} AS ord, '{kind}' AS kind, st, st + length(m) AS en, least({START_SCORE[kind]}::DOUBLE + CASE WHEN regexp_matches(
      substr(text, greatest(st - {CONTEXT_WIDTH}, 0) + 1, st - greatest(st - {CONTEXT_WIDTH}, 0)) || ' ' || substr(text, st + length(m) + 1, {CONTEXT_WIDTH}),
      {_quoted(CONTEXT[kind])}) THEN {CONTEXT_BONUS}::DOUBLE ELSE 0 END, 1.0) AS score FROM (
    SELECT doc_id, text, ms[i] AS m, length(array_to_string(ps[1:i], '')) + length(array_to_string(ms[1:i - 1], '')) AS st FROM (
      SELECT doc_id, text, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM (
        SELECT doc_id, text, regexp_extract_all(text, {_quoted(_PLAIN[kind])}) AS ms, string_split_regex(text, {_quoted(_PLAIN[kind])}) AS ps FROM documents WHERE text IS NOT NULL)))
  WHERE {valid[kind]}""")
    spans = "kind || ':' || st || ':' || en"
    added = ", ".join(f"'{k}'" for k in ADDED_KINDS)
    base = f"kind NOT IN ({added})"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE_KINDS)
    zero = ", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in BASE_KINDS)
    return f"""WITH s AS ({' UNION ALL '.join(parts)}),
k AS (SELECT * FROM s WHERE {base} OR score >= {KEEP_SCORE}),
a AS (SELECT doc_id, {counts}, string_agg({spans}, ',' ORDER BY ord, st) FILTER (WHERE {base}) AS b, string_agg({spans}, ',' ORDER BY ord, st) AS spans,
             string_agg({spans} || ':' || round(score * 100)::INTEGER, ',' ORDER BY ord, st) AS scores FROM k GROUP BY doc_id)
SELECT doc_id, {zero}, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores FROM documents LEFT JOIN a USING (doc_id)"""


def repeats(length: int = 100) -> str:
    return f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, {2 * length}) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {length - 1})) AS p FROM d)),
f AS (SELECT s, min({{'doc_id': doc_id, 'p': p}}) AS first FROM w GROUP BY s HAVING count(*) > 1),
r AS (SELECT w.doc_id, w.p FROM w JOIN f USING (s) WHERE {{'doc_id': w.doc_id, 'p': w.p}} > first),
i AS (SELECT doc_id, p, sum(CASE WHEN p <= before + {length} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS island
      FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM r)),
sp AS (SELECT doc_id, min(p) AS a, max(p) + {length} AS b FROM i GROUP BY doc_id, island),
cut AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS k0, a AS k1, b - a AS gone FROM (
          SELECT doc_id, a, b FROM sp UNION ALL SELECT doc_id, length(h) // 2, length(h) // 2 FROM d)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * k0 + 1, 2 * (k1 - k0)), '' ORDER BY k0) AS x, sum(gone) AS n_removed, count(*) - 1 AS n_spans
         FROM cut JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans, sha256(unhex(x)) AS kept_sha256
FROM kept JOIN d USING (doc_id)"""


def cover_tree(cosine: float = 0.9) -> str:
    return f"""WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= {cosine}),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)"""


def fill_in_middle(seed: int = 1) -> str:
    h = ", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, {h} FROM d),
c AS (SELECT doc_id, t, w, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (SELECT doc_id, t, n, form, coalesce(array_to_string(w[1:a], ''), '') AS p, coalesce(array_to_string(w[a + 1:b], ''), '') AS m,
             coalesce(array_to_string(w[b + 1:n], ''), '') AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM s"""


def divergence(min_docs: int = 10, top_terms: int = 10) -> str:
    share = "1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (coalesce(total, 0) + 2 * v)"
    apart = "(x.p - y.p) * (x.p - y.p) // (x.p + y.p)"
    return rf"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER.format('text')} AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {min_docs}),
vs AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, sum(n) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, {share} AS p FROM g JOIN vs USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, {share} AS p FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) JOIN (SELECT lang, sum(total) AS total FROM g GROUP BY lang) USING (lang) JOIN vs USING (lang)),
pv AS (SELECT x.lang, x.source, y.source AS item, sum({apart}) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source),
a AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source
      UNION ALL SELECT x.lang, x.source, 'term', x.term, {apart} FROM p x JOIN q y ON x.lang = y.lang AND x.term = y.term WHERE x.n > 0 AND x.p > y.p),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM a)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM k WHERE part = 'pair' OR rank <= {top_terms}"""
