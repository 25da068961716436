"""§2.3 lexicon/write-back, §2.7 union, §2.9 balancing and augmentation, §2.12 table function."""

from __future__ import annotations

from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.oracle import d_edit, d_fast_augment, d_insert, d_ratio, d_uniform, d_words
from tixprep.operators import augment as A
from tixprep.queries import query
from tixprep.queries.common import BASE_CTE, MERGED_CTE, base, labels, merged, sql
from tixprep.sources.tables import read_table

TG = S.TARGETS


def lexicon(spark, sf):
    """Synonym lexicon derived from the vocabulary of the ``documents`` and ``benchmark`` texts."""
    from tixprep.session import dimension
    texts = read_table(spark, sf, "benchmark").select("text").unionAll(read_table(spark, sf, "documents").select("text"))
    return dimension(A.synonym_lexicon(A.vocabulary_synsets(texts, "text")))


def _h32(seed, key, tag):
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', CAST({key} AS VARCHAR), '{tag}')), 1, 8))::BIGINT"


LEX_CTES = [
    f"""bw AS (SELECT DISTINCT w AS lemma FROM (SELECT unnest({d_words('lower(text)')}) AS w FROM (SELECT text FROM benchmark UNION ALL SELECT text FROM documents))
       WHERE regexp_full_match(w, '\\p{{L}}+') AND length(w) > 3)""",
    "ns AS (SELECT greatest(1, floor(count(*) / 3))::BIGINT AS k FROM bw)",
    f"pairs AS (SELECT {_h32(7, 'lemma', 'synset')} % k AS synset, lemma FROM bw, ns)",
    "mem AS (SELECT synset, list(DISTINCT lower(replace(lemma, '_', ' '))) AS members FROM pairs GROUP BY synset)",
    "keyed AS (SELECT DISTINCT synset, lower(lemma) AS word FROM pairs)",
    """lex0 AS (SELECT word, list_sort(list_distinct(flatten(list(members)))) AS syns FROM keyed JOIN mem USING (synset) GROUP BY word)""",
    "lex AS (SELECT word, list_filter(syns, lambda x: x <> word) AS synonyms FROM lex0 WHERE len(list_filter(syns, lambda x: x <> word)) > 0)",
]


@query("synonym_lexicon", "WITH " + ",\n".join(LEX_CTES) + """
SELECT word, len(synonyms)::INTEGER AS n_synonyms, array_to_string(synonyms, '|') AS synonyms_joined FROM lex""")
def q_synonym_lexicon(spark, sf):
    lx = lexicon(spark, sf)
    return lx.select("word", F.size("synonyms").cast("int").alias("n_synonyms"), F.array_join("synonyms", "|").alias("synonyms_joined"))


def _inflected_sql() -> str:
    """Words of ``documents`` looked up in synsets of the ``benchmark`` vocabulary, round by round."""
    from tixprep.operators.lexicon import DETACHMENT_RULES, MOST_ROUNDS
    made = ", ".join(f"CASE WHEN ends_with(now, '{old}') AND length(now) > {0 if new else len(old)} THEN left(now, length(now) - {len(old)}) || '{new}' END" for old, new in DETACHMENT_RULES)
    words = lambda table, least: f"""SELECT DISTINCT w FROM (SELECT unnest({d_words('lower(text)')}) AS w FROM {table}) WHERE regexp_full_match(w, '\\p{{L}}+') AND length(w) > {least}"""
    ctes = [f"bw AS (SELECT w AS lemma FROM ({words('benchmark', 3)}))", *LEX_CTES[1:5], "entries AS (SELECT DISTINCT word AS form FROM keyed)",
            f"left0 AS (SELECT w AS word, w AS now FROM ({words('documents', 0)}))"]
    for k in range(MOST_ROUNDS):
        own = "SELECT word, now AS form FROM left0 UNION " if k == 0 else ""
        ctes += [f"made{k} AS ({own}SELECT DISTINCT word, form FROM (SELECT word, unnest([{made}]) AS form FROM left{k}) WHERE form IS NOT NULL)",
                 f"found{k} AS (SELECT word, form FROM made{k} SEMI JOIN entries USING (form))",
                 f"left{k + 1} AS (SELECT word, form AS now FROM made{k} WHERE word NOT IN (SELECT word FROM found{k}){' AND form <> word' if k == 0 else ''})"]
    union = " UNION ".join(f"SELECT word, form FROM found{k}" for k in range(MOST_ROUNDS))
    ctes += [f"forms AS ({union})", "hit AS (SELECT DISTINCT f.word, k.synset FROM forms f JOIN keyed k ON k.word = f.form)",
             "syns AS (SELECT word, list_filter(list_sort(list_distinct(flatten(list(members)))), lambda x: x <> word) AS synonyms FROM hit JOIN mem USING (synset) GROUP BY word)"]
    return "WITH " + ",\n".join(ctes) + "\nSELECT word, len(synonyms)::INTEGER AS n_synonyms, array_to_string(synonyms, '|') AS synonyms_joined FROM syns WHERE len(synonyms) > 0"


@query("synonym_lexicon_inflected", _inflected_sql())
def q_synonym_lexicon_inflected(spark, sf):
    from tixprep.operators import lexicon as LX
    pairs = A.vocabulary_synsets(read_table(spark, sf, "benchmark").select("text"), "text")
    lx = LX.inflected_lexicon(pairs, LX.text_words(read_table(spark, sf, "documents"), "text"))
    return lx.select("word", F.size("synonyms").cast("int").alias("n_synonyms"), F.array_join("synonyms", "|").alias("synonyms_joined"))


_SR_KEY = "(CAST(number_fld AS VARCHAR) || '|sr')"


@query("synonym_replace", sql(BASE_CTE, *LEX_CTES, body=f"""
WITH r AS (SELECT number_fld, description, {d_words('description')} AS words FROM base),
r2 AS (SELECT *, len(words) AS n, floor({d_uniform(7, _SR_KEY, 'pos')} * len(words))::INTEGER AS idx,
              {d_uniform(7, _SR_KEY, 'syn')} AS us FROM r),
j AS (SELECT r2.*, lex.synonyms FROM r2 LEFT JOIN lex ON lex.word = r2.words[r2.idx + 1])
SELECT number_fld, CASE WHEN n = 0 THEN description ELSE array_to_string(list_transform(words, lambda x, i:
   CASE WHEN i - 1 = idx AND synonyms IS NOT NULL THEN synonyms[floor(us * len(synonyms))::INTEGER + 1] ELSE x END), ' ') END
   AS description
FROM j"""))
def q_synonym_replace(spark, sf):
    d = base(spark, sf).select("number_fld", "description")
    return A.synonym_replace(d, lexicon(spark, sf), "description", F.col("number_fld"), "sr")


_RD_KEY = "(CAST(number_fld AS VARCHAR) || '|rd')"


@query("random_deletion", sql(BASE_CTE, body=f"""
WITH r AS (SELECT number_fld, description, {d_words('description')} AS words FROM base),
k AS (SELECT *, list_filter(words, lambda x, i: ('0x' || substr(md5(concat_ws('|', '7', {_RD_KEY}, 'd' || CAST(i - 1 AS VARCHAR))), 1, 8))::BIGINT
                 / 4294967296.0::DOUBLE > 0.1) AS kept FROM r)
SELECT number_fld, CASE WHEN len(words) < 4 THEN description
  WHEN len(kept) > 0 THEN array_to_string(kept, ' ')
  ELSE words[floor({d_uniform(7, _RD_KEY, 'keep')} * len(words))::INTEGER + 1] END AS description
FROM k"""))
def q_random_deletion(spark, sf):
    d = base(spark, sf).select("number_fld", "description")
    return A.random_deletion(d, "description", F.col("number_fld"), "rd")


_SW_KEY = "(CAST(number_fld AS VARCHAR) || '|sw')"


@query("random_swap_segments", sql(BASE_CTE, body=f"""
WITH r AS (SELECT number_fld, description, {d_words('description')} AS words FROM base),
s AS (SELECT *, len(words) AS n, greatest(1, len(words) // 3) AS sz FROM r),
t AS (SELECT *, list_transform(range(0, greatest(ceil(n / sz)::BIGINT - 1, 0) + 1), lambda j:
        {{'u': ('0x' || substr(md5(concat_ws('|', '7', {_SW_KEY}, 'r' || CAST(j AS VARCHAR))), 1, 8))::BIGINT / 4294967296.0::DOUBLE,
         'j': j, 'run': words[j * sz + 1 : j * sz + sz]}}) AS runs FROM s)
SELECT number_fld, CASE WHEN n < 3 THEN description
  ELSE array_to_string(flatten(list_transform(list_sort(runs), lambda x: x.run)), ' ') END AS description
FROM t"""))
def q_random_swap_segments(spark, sf):
    d = base(spark, sf).select("number_fld", "description")
    return A.random_swap_segments(d, "description", F.col("number_fld"), "sw")


_ROWS = "rows_in AS (SELECT number_fld, CAST(number_fld AS VARCHAR) AS rk, description AS txt FROM base)"


@query("synonym_replace_ratio", sql(BASE_CTE, *LEX_CTES, _ROWS, *d_ratio("rr", "rows_in", "rr", "0.15"), body="SELECT number_fld, txt AS description FROM rr"))
def q_synonym_replace_ratio(spark, sf):
    d = base(spark, sf).select("number_fld", "description")
    return A.synonym_replace_ratio(d, lexicon(spark, sf), "description", F.col("number_fld"), "rr", 0.15)


@query("random_insertion", sql(BASE_CTE, *LEX_CTES, _ROWS, *d_insert("ri", "rows_in", "ri"), body="SELECT number_fld, txt AS description FROM ri"))
def q_random_insertion(spark, sf):
    d = base(spark, sf).select("number_fld", "description")
    return A.random_insertion(d, lexicon(spark, sf), "description", F.col("number_fld"), "ri")


def _fields_sql() -> str:
    from tixprep.queries.q_text import _COMB
    first = f"ft AS (SELECT number_fld, CAST(number_fld AS VARCHAR) AS rk, {_COMB} AS combined_text FROM base)"
    parts = "fp AS (SELECT *, string_split(combined_text, ' [SEP] ') AS parts FROM ft)"
    ok = "len(parts) >= 7"
    ctes = [first, parts, "f0 AS (SELECT *, parts[1] AS txt FROM fp)", *d_edit("f0e", "f0", "sf:f0", ok),
            "f1 AS (SELECT * EXCLUDE (txt), txt AS new0, parts[2] AS txt FROM f0e)", *d_edit("f1e", "f1", "sf:f1", ok)]
    body = f"""SELECT b.number_fld, CASE WHEN {ok} THEN new0 ELSE b.short_description END AS short_description,
       CASE WHEN {ok} THEN txt ELSE b.description END AS description,
       CASE WHEN {ok} THEN array_to_string([new0, txt] || parts[3:], ' [SEP] ') ELSE combined_text END AS combined_text
FROM f1e JOIN base b USING (number_fld)"""
    return sql(BASE_CTE, *LEX_CTES, *ctes, body=body)


@query("synonym_replace_fields", _fields_sql())
def q_synonym_replace_fields(spark, sf):
    from tixprep.operators.fields import combine_text7, fill_defaults
    d = combine_text7(fill_defaults(base(spark, sf), "main")).select("number_fld", "short_description", "description", "combined_text")
    return A.synonym_replace_fields(d, lexicon(spark, sf), "combined_text", F.col("number_fld"), "sf")


_HEAVY = """hv AS (SELECT number_fld, CAST(number_fld AS VARCHAR) AS rk, description AS txt,
    count(*) OVER (PARTITION BY category) < 25 OR count(*) OVER (PARTITION BY subcategory) < 25 OR count(*) OVER (PARTITION BY assignment_group) < 25 AS heavy
    FROM base)"""


@query("fast_augment", sql(BASE_CTE, *LEX_CTES, _HEAVY, *d_fast_augment("fa", "hv"), body="SELECT number_fld, txt AS description FROM fa"))
def q_fast_augment(spark, sf):
    d = A.rare_flags(base(spark, sf)).select("number_fld", "description", "is_heavy")
    return A.fast_augment(d, lexicon(spark, sf), "description", F.col("number_fld"), F.col("is_heavy")).select("number_fld", "description")


_MINOR_CTES = ["mc AS (SELECT category, count(*) AS n FROM merged GROUP BY category)",
               "mf AS (SELECT category, n < max(n) OVER () * 0.3 AND category <> 'Other' AS minor FROM mc)",
               "mr AS (SELECT m.number_fld, m.category, m.description AS txt, unnest(range(0, CASE WHEN mf.minor THEN 3 ELSE 1 END))::INTEGER AS copy_no "
               "FROM merged m JOIN mf USING (category))",
               "mk AS (SELECT *, CAST(number_fld AS VARCHAR) || ':' || CAST(copy_no AS VARCHAR) AS rk FROM mr)"]


@query("oversample_minority", sql(BASE_CTE, MERGED_CTE, *LEX_CTES, *_MINOR_CTES, *d_edit("me", "mk", "os", "copy_no > 0"),
                                  body="SELECT number_fld, category, copy_no, txt AS description FROM me"))
def q_oversample_minority(spark, sf):
    out = A.oversample_minority(merged(spark, sf), lexicon(spark, sf), "category", "description", "number_fld")
    return out.select("number_fld", "category", F.col("copy_no").cast("int").alias("copy_no"), "description")


CHAIN_CTE = """chain AS (
  WITH t0 AS (SELECT category, subcategory, assignment_group, count(*) AS n FROM merged GROUP BY ALL),
  t1 AS (SELECT *, CASE WHEN sum(n) OVER (PARTITION BY category) < max(tot) OVER () * 0.3 AND category <> 'Other' THEN 3 ELSE 1 END AS f1
         FROM (SELECT *, sum(n) OVER (PARTITION BY category) AS tot FROM t0)),
  t2 AS (SELECT *, CASE WHEN tot2 < max(tot2) OVER () * 0.3 AND subcategory <> 'Other' THEN 3 ELSE 1 END AS f2
         FROM (SELECT *, sum(n * f1) OVER (PARTITION BY subcategory) AS tot2 FROM t1)),
  t3 AS (SELECT *, CASE WHEN tot3 < max(tot3) OVER () * 0.3 AND assignment_group <> 'Other' THEN 3 ELSE 1 END AS f3
         FROM (SELECT *, sum(n * f1 * f2) OVER (PARTITION BY assignment_group) AS tot3 FROM t2))
  SELECT category, subcategory, assignment_group, n, f1, f2, f3 FROM t3
)"""


def chain_text_ctes() -> list[str]:
    """Copies of every merged row with the edits of their path: (src, i1, i2, i3, t3, labels)."""
    from tixprep.queries.q_text import _COMB
    out = [f"""r0 AS (SELECT m.number_fld AS src, m.category, m.subcategory, m.assignment_group, {_COMB} AS txt, c.f1, c.f2, c.f3
             FROM merged m JOIN chain c USING (category, subcategory, assignment_group))"""]
    src, path = "r0", "CAST(src AS VARCHAR)"
    for k in (1, 2, 3):
        path += f" || '.' || CAST(i{k} AS VARCHAR)"
        keep = "" if k == 1 else " EXCLUDE (rk)"
        out += [f"u{k} AS (SELECT *{keep}, unnest(range(0, f{k})) AS i{k} FROM {src})", f"e{k} AS (SELECT *, {path} AS rk FROM u{k})"]
        out += d_edit(f"z{k}", f"e{k}", f"p{k}", f"i{k} > 0")
        src = f"z{k}"
    return out


PATH = "CAST(i1 AS VARCHAR) || '.' || CAST(i2 AS VARCHAR) || '.' || CAST(i3 AS VARCHAR)"


@query("oversample_chain", sql(BASE_CTE, MERGED_CTE, CHAIN_CTE, *LEX_CTES, *chain_text_ctes(), body=f"""
SELECT src AS src_id, {PATH} AS aug_no, category, subcategory, assignment_group, txt AS combined_text FROM z3"""))
def q_oversample_chain(spark, sf):
    from tixprep.operators.fields import combine_text7, fill_defaults
    from tixprep.operators.classes import merge_rare_targets, triple_counts
    keys = labels(spark, sf)  # counted for the merge and for the factors
    d = combine_text7(fill_defaults(merge_rare_targets(base(spark, sf), counted=keys), "main"))
    factors = A.oversample_factors(triple_counts(merge_rare_targets(keys)))
    # only what the result holds goes on: the chain writes its rows once
    out = A.oversample_chain(d.select("number_fld", *TG, "combined_text"), lexicon(spark, sf), "combined_text", "number_fld", factors=factors)
    return out.select(F.col("number_fld").alias("src_id"), "aug_no", *TG, "combined_text")


_RARE_CTE = """rare AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY category) AS nc, count(*) OVER (PARTITION BY subcategory) AS ns,
    count(*) OVER (PARTITION BY assignment_group) AS ng FROM base) WHERE nc < 50 OR ns < 50 OR ng < 50)"""


@query("rare_subset", sql(BASE_CTE, _RARE_CTE, body="SELECT number_fld, category, subcategory, assignment_group FROM rare"))
def q_rare_subset(spark, sf):
    return A.rare_subset(base(spark, sf)).select("number_fld", *TG)


_COPIES = """copies AS (SELECT *, CAST(src_id AS VARCHAR) || ':' || CAST(aug_no AS VARCHAR) AS rk FROM (
    SELECT number_fld AS src_id, category, subcategory, assignment_group, concat_ws(' [SEP] ', short_description, description) AS txt, heavy,
    unnest(range(1, CASE WHEN heavy THEN 10 ELSE 5 END + 1))::INTEGER AS aug_no FROM (
      SELECT *, (nc < 50 AND count(*) OVER (PARTITION BY category) < 25) OR (ns < 50 AND count(*) OVER (PARTITION BY subcategory) < 25)
             OR (ng < 50 AND count(*) OVER (PARTITION BY assignment_group) < 25) AS heavy FROM rare)))"""
AUG_CTES = [BASE_CTE, _RARE_CTE, *LEX_CTES, _COPIES, *d_fast_augment("aug", "copies")]
_CHOSEN = f"{d_uniform(7, 'rk', 'transform')} < 0.5"


def _aug(spark, sf):
    """(augmented copies, rare rows)."""
    from tixprep.operators.fields import combine_text2
    b = base(spark, sf)
    rare = combine_text2(A.rare_subset(b))
    return A.augment_rare_rows(rare, lexicon(spark, sf), "combined_text", "number_fld", rare_sets_from=b), rare


def _copy_cols(*more):
    return [F.col("number_fld").alias("src_id"), F.col("aug_no").cast("int").alias("aug_no"), *more]


@query("augment_rare_rows", sql(*AUG_CTES, body="SELECT src_id, aug_no, category, subcategory, assignment_group, txt AS combined_text FROM aug"))
def q_augment_rare_rows(spark, sf):
    return _aug(spark, sf)[0].select(*_copy_cols(*TG, "combined_text"))


@query("union_augmented", sql(*AUG_CTES, body="""
SELECT number_fld AS src_id, 0 AS aug_no, category, concat_ws(' [SEP] ', short_description, description) AS combined_text FROM rare
UNION ALL SELECT src_id, aug_no, category, txt FROM aug"""))
def q_union_augmented(spark, sf):
    aug, rare = _aug(spark, sf)
    return A.union_augmented(rare.withColumn("aug_no", F.lit(0)), aug).select(*_copy_cols("category", "combined_text"))


@query("select_for_transform", sql(*AUG_CTES, body=f"SELECT src_id, aug_no, txt AS combined_text FROM aug WHERE {_CHOSEN}"))
def q_select_for_transform(spark, sf):
    return A.select_for_transform(_aug(spark, sf)[0], "number_fld").select(*_copy_cols("combined_text"))


def _upper_words(texts: list[str]) -> list[str]:
    """Stand-in for an external text model (list -> list of the same length)."""
    return [t.upper() if t is not None else None for t in texts]


_UPPER = "replace(upper(txt), 'ẞ', 'SS')"  # as Python: the one letter here on which the two differ


@query("batch_transform", sql(*AUG_CTES, body=f"SELECT src_id, aug_no, {_UPPER} AS new_text FROM aug WHERE {_CHOSEN}"))
def q_batch_transform(spark, sf):
    sel = A.select_for_transform(_aug(spark, sf)[0], "number_fld")
    return A.batch_transform(sel, _upper_words, "combined_text", ["number_fld", "aug_no"]).select(*_copy_cols("new_text"))


@query("writeback_by_id", sql(*AUG_CTES, body=f"SELECT src_id, aug_no, CASE WHEN {_CHOSEN} THEN {_UPPER} ELSE txt END AS combined_text FROM aug"))
def q_writeback_by_id(spark, sf):
    from tixprep.session import cut_lineage
    aug = cut_lineage(_aug(spark, sf)[0].select("number_fld", "aug_no", "combined_text"))  # read twice below
    new = A.batch_transform(A.select_for_transform(aug, "number_fld"), _upper_words, "combined_text", ["number_fld", "aug_no"])
    return A.writeback_by_id(aug, new, "combined_text", ["number_fld", "aug_no"]).select(*_copy_cols("combined_text"))


@query("per_key_copies", sql(BASE_CTE, body="""
SELECT number_fld, unnest(range(0, length(category)))::INTEGER AS copy_no FROM base"""))
def q_per_key_copies(spark, sf):
    from tixprep.operators.udf import per_key_copies
    d = base(spark, sf).select("number_fld", F.length("category").alias("k"))
    return per_key_copies(d, "k").select("number_fld", F.col("copy_no").cast("int").alias("copy_no"))


def _rare_set_sql() -> str:
    ctes = [*AUG_CTES, f"""rs AS (SELECT number_fld AS src_id, 0 AS aug_no, concat_ws(' [SEP] ', short_description, description) AS text,
        category, subcategory, assignment_group FROM rare
      UNION ALL SELECT src_id, aug_no, CASE WHEN {_CHOSEN} THEN {_UPPER} ELSE txt END, category, subcategory, assignment_group FROM aug)""",
            """rw AS (SELECT *, sqrt(1.0 / count(*) OVER (PARTITION BY category)) AS a, sqrt(1.0 / count(*) OVER (PARTITION BY subcategory)) AS b,
        sqrt(1.0 / count(*) OVER (PARTITION BY assignment_group)) AS c FROM rs)"""]
    return sql(*ctes, body="""SELECT src_id, aug_no, text, category, subcategory, assignment_group,
       (dense_rank() OVER (ORDER BY category) - 1)::INTEGER AS category_code, (dense_rank() OVER (ORDER BY subcategory) - 1)::INTEGER AS subcategory_code,
       (dense_rank() OVER (ORDER BY assignment_group) - 1)::INTEGER AS assignment_group_code,
       round(least(10.0, greatest(1.0, pow((a / min(a) OVER ()) * (b / min(b) OVER ()) * (c / min(c) OVER ()), 1.0 / 3.0))), 9) AS sample_weight FROM rw""")


@query("prepare_rare_set", _rare_set_sql())
def q_prepare_rare_set(spark, sf):
    from tixprep.plans.rare import prepare_rare_set
    from tixprep.queries.common import tk
    samples, _ = prepare_rare_set(tk(spark, sf), lexicon(spark, sf), transform=_upper_words)
    return samples.withColumn("sample_weight", F.round("sample_weight", 9))


@query("transform_ledger", "SELECT doc_id, reverse(text) AS new_text, 2::BIGINT AS runs FROM documents WHERE text IS NOT NULL")
def q_transform_ledger(spark, sf):
    """A text function that fails on some chunks the first time: the second run does only those."""
    from tixprep.operators.ledger import ChunkLedger
    from tixprep.sources.io import scratch_path
    book = ChunkLedger(spark, scratch_path(spark, "ledger"), ["doc_id"])
    book.start(read_table(spark, sf, "documents").select("doc_id", "text").filter("text IS NOT NULL"))

    def flaky(texts):
        if len(texts[0]) % 3 == 0:
            raise RuntimeError("no answer")
        return [t[::-1] for t in texts]
    book.run(flaky)
    runs = book.run(lambda texts: [t[::-1] for t in texts]).agg(F.max("attempts")).first()[0]
    return book.results().withColumn("runs", F.lit(int(runs)).cast("bigint"))
