"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is plain SQL over the driver's pre-registered tables. The ticket view is spelled out
as a CTE. Regex classes are the DuckDB (RE2) spelling of the same Python classes; RE2's ``\\s``
lacks U+000B, so it is added.
"""

from __future__ import annotations

D_SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
D_NON_SPACE = f"[^{D_SPACE}]"
D_SPACES = f"[{D_SPACE}]+"
D_EMAIL_LOOSE = f"{D_NON_SPACE}+@{D_NON_SPACE}+"
D_EMAIL_STRICT = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
D_URL = f"http{D_NON_SPACE}+|www[^\\n]{D_NON_SPACE}+"
D_NON_WORD_RUN = r"[^\p{L}\p{N}_]+"


def rr(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, '{pattern}', '{repl}', 'g')"


def d_clean_basic(e: str) -> str:
    t = f"coalesce({e}, '')"
    t = rr(t, D_EMAIL_LOOSE, "EMAIL")
    t = rr(t, D_URL, "URL")
    t = rr(t, D_NON_WORD_RUN, " ")
    t = rr(t, r"\p{Nd}+", "[NUM]")
    return f"lower(trim({t}))"


def d_clean_profile(e: str) -> str:
    t = f"lower(coalesce({e}, ''))"
    t = rr(t, D_EMAIL_LOOSE, "[EMAIL]")
    t = rr(t, D_URL, "[URL]")
    t = rr(t, D_NON_WORD_RUN, " ")
    t = rr(t, r"\p{Nd}+", "[NUM]")
    return f"trim({t})"


def d_clean_strict(e: str) -> str:
    t = f"coalesce({e}, '')"
    t = rr(t, D_EMAIL_STRICT, "EMAIL")
    t = rr(t, D_URL, "URL")
    t = rr(t, r"[^a-zA-Z0-9]+", " ")
    t = rr(t, r"[0-9]+", "[NUM]")
    return f"lower(trim({t}))"


def d_normalize(e: str) -> str:
    return f"trim({rr(e, D_SPACES, ' ')})"


def d_words(e: str) -> str:
    return f"list_filter(string_split({d_normalize(f'coalesce({e}, {chr(39)}{chr(39)})')}, ' '), lambda x: x <> '')"


def d_uniform(seed, key: str, tag: str) -> str:
    """Same seeded uniform as ``tixprep.functions.hashing.uniform``."""
    return (
        f"(('0x' || substr(md5(concat_ws('|', CAST({seed} AS VARCHAR), CAST({key} AS VARCHAR), '{tag}')), 1, 8))"
        f"::BIGINT / 4294967296.0::DOUBLE)"
    )


TICKETS_CTE = """tickets AS (
  SELECT d.doc_id AS number_fld,
    CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE split_part(d.text, chr(10), 1) END AS short_description,
    CASE WHEN d.doc_id % 19 = 0 THEN NULL ELSE d.text END AS description,
    d.lang AS category,
    CASE WHEN d.n_chars < 100 THEN 'xs' WHEN d.n_chars < 300 THEN 's' WHEN d.n_chars < 1000 THEN 'm'
         WHEN d.n_chars < 3000 THEN 'l' WHEN d.n_chars < 10000 THEN 'xl' ELSE 'xxl' END AS subcategory,
    nullif(lower(regexp_extract(d.text, '^[A-Za-z]+')), '') AS assignment_group,
    CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE o.o_orderpriority END AS priority,
    CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE e.event_type END AS contact_type,
    CASE WHEN d.doc_id % 23 = 0 THEN NULL ELSE n.n_name END AS location,
    c.c_mktsegment AS u_department,
    CASE WHEN d.doc_id % 29 = 0 THEN NULL ELSE r.r_name END AS opened_by_department,
    CASE WHEN d.doc_id % 37 = 0 THEN 'not a date'
         WHEN d.doc_id % 10 = 0 THEN strftime(o.o_orderdate, '%m/%d/%Y')
         ELSE CAST(o.o_orderdate AS VARCHAR) END AS date_opened,
    o.o_totalprice AS total_price,
    e.value AS value
  FROM documents d
  JOIN orders o ON o.o_orderkey = d.doc_id
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
  LEFT JOIN events e ON e.event_id = d.doc_id
)"""


def d_h32(seed, key: str, *tags: str) -> str:
    """The 32-bit hash of ``hashing.hash32``; key and tags are SQL expressions."""
    rest = "".join(f", CAST({t} AS VARCHAR)" for t in tags)
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {key}{rest})), 1, 8))::BIGINT"


def d_unit(seed, key: str, *tags: str) -> str:
    return f"({d_h32(seed, key, *tags)} / 4294967296.0::DOUBLE)"


# Twins of the seeded edits. Each takes a relation with the columns rk (row key) and txt, and others that
# pass through, and ends in a relation ``p`` of the same columns; ``lex`` is the lexicon.

def d_edit(p: str, src: str, tag: str, cond: str = "TRUE", seed: int = 7) -> list[str]:
    """One word at a seeded position becomes a synonym."""
    rk = f"(rk || '|{tag}')"
    return [
        f"{p}_w AS (SELECT *, CASE WHEN {cond} THEN {d_words('txt')} END AS _w FROM {src})",
        f"{p}_i AS (SELECT *, CASE WHEN _w IS NOT NULL AND len(_w) > 0 THEN floor({d_unit(seed, rk, chr(39) + 'pos' + chr(39))} * len(_w))::INTEGER END AS _i FROM {p}_w)",
        f"{p}_s AS (SELECT {p}_i.*, lex.synonyms AS _syns FROM {p}_i LEFT JOIN lex ON lex.word = {p}_i._w[{p}_i._i + 1])",
        f"""{p} AS (SELECT * EXCLUDE (_w, _i, _syns, txt), CASE WHEN _i IS NULL THEN txt WHEN _syns IS NULL THEN array_to_string(_w, ' ')
          ELSE array_to_string(list_transform(_w, lambda x, j: CASE WHEN j - 1 = _i
               THEN _syns[floor({d_unit(seed, rk, chr(39) + 'syn' + chr(39))} * len(_syns))::INTEGER + 1] ELSE x END), ' ') END AS txt FROM {p}_s)""",
    ]


def d_ratio(p: str, src: str, tag: str, ratio: str, cond: str = "TRUE", seed: int = 7) -> list[str]:
    """A share of the candidate words becomes synonyms."""
    return [
        f"{p}_w AS (SELECT *, rk || '|{tag}' AS _rk, {d_words('txt')} AS _w FROM {src})",
        f"{p}_c AS (SELECT *, list_filter(range(0, len(_w)), lambda i: regexp_full_match(_w[i + 1], '\\p{{L}}+') AND length(_w[i + 1]) > 3) AS _cand FROM {p}_w)",
        f"""{p}_s AS (SELECT *, CASE WHEN len(_w) > 0 AND len(_cand) > 0 AND {cond} THEN list_slice(list_sort(list_transform(_cand, lambda i:
              {{'h': {d_h32(seed, '_rk', 'i')}, 'i': i}})), 1, least(greatest(1, floor(len(_w) * ({ratio})::DOUBLE)::BIGINT), len(_cand))) END AS _sel FROM {p}_c)""",
        f"{p}_x AS (SELECT _rk, _s.i AS pos, _w[_s.i + 1] AS word FROM (SELECT _rk, _w, unnest(_sel) AS _s FROM {p}_s))",
        f"""{p}_e AS (SELECT _rk, list({{'p': pos, 's': synonyms[floor({d_unit(seed, '_rk', 'pos', chr(39) + 'syn' + chr(39))} * len(synonyms))::INTEGER + 1]}}) AS _m
              FROM {p}_x JOIN lex USING (word) GROUP BY _rk)""",
        f"""{p} AS (SELECT * EXCLUDE (_w, _cand, _sel, _rk, _m, txt), CASE WHEN _sel IS NULL THEN txt ELSE array_to_string(list_transform(_w, lambda w, i:
              coalesce(list_filter(_m, lambda e: e.p = i - 1)[1].s, w)), ' ') END AS txt FROM {p}_s LEFT JOIN {p}_e USING (_rk))""",
    ]


def d_insert(p: str, src: str, tag: str, cond: str = "TRUE", seed: int = 7) -> list[str]:
    """A synonym of a random word at a random position."""
    rk, q = f"(rk || '|{tag}')", chr(39)
    return [
        f"{p}_w AS (SELECT *, {d_words('txt')} AS _w FROM {src})",
        f"{p}_i AS (SELECT *, CASE WHEN {cond} AND len(_w) > 0 THEN floor({d_unit(seed, rk, q + 'pos' + q)} * len(_w))::INTEGER END AS _i FROM {p}_w)",
        f"""{p}_s AS (SELECT {p}_i.*, lex.synonyms AS _syns, floor({d_unit(seed, rk, q + 'at' + q)} * (len(_w) + 1))::INTEGER AS _at
              FROM {p}_i LEFT JOIN lex ON lex.word = {p}_i._w[{p}_i._i + 1])""",
        f"""{p} AS (SELECT * EXCLUDE (_w, _i, _syns, _at, txt), CASE WHEN _i IS NULL THEN txt WHEN _syns IS NULL THEN array_to_string(_w, ' ')
              ELSE array_to_string(_w[1:_at] || [_syns[floor({d_unit(seed, rk, q + 'syn' + q)} * len(_syns))::INTEGER + 1]] || _w[_at + 1:], ' ') END AS txt FROM {p}_s)""",
    ]


def d_delete(p: str, src: str, tag: str, share: float = 0.1, cond: str = "TRUE", seed: int = 7) -> list[str]:
    """Each word goes with a probability."""
    rk, q = f"(rk || '|{tag}')", chr(39)
    return [
        f"{p}_w AS (SELECT *, {d_words('txt')} AS _w FROM {src})",
        f"{p}_k AS (SELECT *, list_filter(_w, lambda x, i: {d_unit(seed, rk, q + 'd' + q + ' || CAST(i - 1 AS VARCHAR)')} > {share}::DOUBLE) AS _kept FROM {p}_w)",
        f"""{p} AS (SELECT * EXCLUDE (_w, _kept, txt), CASE WHEN NOT ({cond}) OR len(_w) < 4 THEN txt WHEN len(_kept) > 0 THEN array_to_string(_kept, ' ')
              ELSE _w[floor({d_unit(seed, rk, q + 'keep' + q)} * len(_w))::INTEGER + 1] END AS txt FROM {p}_k)""",
    ]


def d_swap(p: str, src: str, tag: str, cond: str = "TRUE", seed: int = 7) -> list[str]:
    """Three runs of words (and a rest) in a seeded order."""
    rk, q = f"(rk || '|{tag}')", chr(39)
    return [
        f"{p}_w AS (SELECT *, {d_words('txt')} AS _w FROM {src})",
        f"{p}_z AS (SELECT *, greatest(1, len(_w) // 3) AS _sz FROM {p}_w)",
        f"""{p}_r AS (SELECT *, list_transform(range(0, greatest(ceil(len(_w) / _sz)::BIGINT - 1, 0) + 1), lambda j:
              {{'u': {d_unit(seed, rk, q + 'r' + q + ' || CAST(j AS VARCHAR)')}, 'j': j, 'run': _w[j * _sz + 1 : j * _sz + _sz]}}) AS _runs FROM {p}_z)""",
        f"""{p} AS (SELECT * EXCLUDE (_w, _sz, _runs, txt), CASE WHEN NOT ({cond}) OR len(_w) < 3 THEN txt
              ELSE array_to_string(flatten(list_transform(list_sort(_runs), lambda x: x.run)), ' ') END AS txt FROM {p}_r)""",
    ]


def d_fast_augment(p: str, src: str, seed: int = 7) -> list[str]:
    """Ratio edit, insertion (heavy) or deletion, segment shuffle for half of the rows; the relation
    has a boolean column heavy."""
    q = chr(39)
    coin = f"{d_unit(seed, '(rk || ' + q + '|fa3' + q + ')', q + 'coin' + q)} < 0.5"
    return (d_ratio(f"{p}1", src, "fa1", "CASE WHEN heavy THEN 0.20 ELSE 0.10 END", seed=seed) + d_insert(f"{p}2", f"{p}1", "fa2i", "heavy", seed)
            + d_delete(f"{p}3", f"{p}2", "fa2d", 0.1, "NOT heavy", seed) + d_swap(p, f"{p}3", "fa3s", coin, seed))
