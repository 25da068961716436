"""§2.10 label, feature, scoring and evaluation tables; §2.1 bundle and report I/O; the
training-set flagship; §2.12 UDF surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.operators import encode as EN
from tixprep.operators import evaluate as EV
from tixprep.queries import query
from tixprep.queries.common import BASE_CTE, MERGED_CTE, base, merged, sql, tk
from tixprep.sources import io as IO
from tixprep.sources.tables import read_table

_LOGITS = """lg AS (SELECT vec_id AS id, embedding[1:4] AS cat_logits, (label % 4)::INTEGER AS cat_label,
  embedding[5:10] AS sub_logits, (label % 6)::INTEGER AS sub_label, embedding[11:20] AS grp_logits,
  (label % 10)::INTEGER AS grp_label, 1.0 + label / 10.0 AS weight FROM embeddings)"""


def _ce(lg, lb):
    m = f"list_max({lg})"
    return (f"({m} + ln(list_sum(list_transform({lg}, lambda x: exp(x - {m})))) - {lg}[{lb} + 1])")


_LOSS = f"""ls AS (SELECT id, {_ce('cat_logits', 'cat_label')} * weight AS l0, {_ce('sub_logits', 'sub_label')} * weight AS l1,
  {_ce('grp_logits', 'grp_label')} * weight AS l2,
  list_position(cat_logits, list_max(cat_logits)) - 1 AS p0, list_position(sub_logits, list_max(sub_logits)) - 1 AS p1,
  list_position(grp_logits, list_max(grp_logits)) - 1 AS p2, cat_label, sub_label, grp_label FROM lg)"""


def logits_fixture(df, shift=0, sizes=(4, 6, 10), keep=()):
    """Three heads of logits cut from the embedding column (stand-in for model outputs), labels from
    its integer label, and a row weight; ``shift`` moves the slices."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    start, out, off = F.lit(1) + shift, [], 0
    for (lg, lb), k in zip(EV.HEADS, sizes, strict=True):
        out += [F.slice(v, start + off, k).alias(lg), (F.col("label") % k).cast("int").alias(lb)]
        off += k
    return df.select(F.col("vec_id").alias("id"), *keep, *out, (1.0 + F.col("label") / 10.0).alias("weight"))


def _logits(spark, sf):
    return logits_fixture(read_table(spark, sf, "embeddings"))


@query("weighted_cross_entropy", f"""WITH {_LOGITS}, {_LOSS}
SELECT round(avg(l0), 9) AS cat_loss, round(avg(l1), 9) AS sub_loss, round(avg(l2), 9) AS grp_loss,
       round((avg(l0) + avg(l1) + avg(l2)) / 3.0, 9) AS total_loss FROM ls""")
def q_weighted_cross_entropy(spark, sf):
    d = EV.weighted_cross_entropy(_logits(spark, sf))
    return d.select(*[F.round(c, 9).alias(c) for c in d.columns])


@query("head_accuracy", f"""WITH {_LOGITS}, {_LOSS}
SELECT round(avg((p0 = cat_label)::DOUBLE), 9) AS cat_acc, round(avg((p1 = sub_label)::DOUBLE), 9) AS sub_acc,
       round(avg((p2 = grp_label)::DOUBLE), 9) AS grp_acc FROM ls""")
def q_head_accuracy(spark, sf):
    d = EV.head_accuracy(_logits(spark, sf))
    return d.select(*[F.round(c, 9).alias(c) for c in d.columns])


@query("batch_mean_loss", f"""WITH {_LOGITS}, {_LOSS},
b AS (SELECT (row_number() OVER (ORDER BY id) - 1) // 128 AS batch, (l0 + l1 + l2) / 3.0 AS loss FROM ls),
bb AS (SELECT batch, avg(loss) AS bl FROM b GROUP BY batch)
SELECT round(avg(bl), 9) AS val_loss, count(*) AS n_batches FROM bb""")
def q_batch_mean_loss(spark, sf):
    d = EV.batch_mean_loss(_logits(spark, sf))
    return d.select(F.round("val_loss", 9).alias("val_loss"), "n_batches")


def _epochs(spark, sf):
    from tixprep.functions.hashing import uniform
    rows = read_table(spark, sf, "embeddings").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(S.NUM_EPOCHS))))
    scored = logits_fixture(rows, F.col("epoch") - 1, keep=["epoch"])
    return EV.epoch_metrics(scored.withColumn("is_val", uniform(S.SPLIT_SEED, F.col("id"), "val") < S.VAL_SHARE))


_EPOCH_COLS = ["train_loss", "val_loss", "cat_acc", "subcat_acc", "assign_acc"]


def _epoch_sql() -> str:
    from tixprep.oracle import d_uniform
    v = "list_transform(embedding, lambda x: x::DOUBLE)"
    lg = f"""elg AS (SELECT vec_id AS id, epoch, {v}[epoch : epoch + 3] AS cat_logits, (label % 4)::INTEGER AS cat_label,
      {v}[epoch + 4 : epoch + 9] AS sub_logits, (label % 6)::INTEGER AS sub_label,
      {v}[epoch + 10 : epoch + 19] AS grp_logits, (label % 10)::INTEGER AS grp_label, 1.0 + label / 10.0 AS weight
      FROM embeddings, (SELECT unnest(range(1, 11)) AS epoch))"""
    ls = f"""els AS (SELECT id, epoch, ({_ce('cat_logits', 'cat_label')} * weight + {_ce('sub_logits', 'sub_label')} * weight
      + {_ce('grp_logits', 'grp_label')} * weight) / 3.0 AS loss,
      (list_position(cat_logits, list_max(cat_logits)) - 1 = cat_label)::DOUBLE AS c0,
      (list_position(sub_logits, list_max(sub_logits)) - 1 = sub_label)::DOUBLE AS c1,
      (list_position(grp_logits, list_max(grp_logits)) - 1 = grp_label)::DOUBLE AS c2,
      {d_uniform(42, 'id', 'val')} < 0.1 AS is_val FROM elg)"""
    rest = """vb AS (SELECT epoch, (row_number() OVER (PARTITION BY epoch ORDER BY id) - 1) // 128 AS batch, loss FROM els WHERE is_val),
    vl AS (SELECT epoch, avg(bl) AS val_loss FROM (SELECT epoch, batch, avg(loss) AS bl FROM vb GROUP BY epoch, batch) GROUP BY epoch),
    em AS (SELECT epoch, avg(loss) FILTER (WHERE NOT is_val) AS train_loss, avg(c0) FILTER (WHERE is_val) AS cat_acc,
           avg(c1) FILTER (WHERE is_val) AS subcat_acc, avg(c2) FILTER (WHERE is_val) AS assign_acc FROM els GROUP BY epoch),
    ep AS (SELECT em.epoch::INTEGER AS epoch, round(train_loss, 9) AS train_loss, round(val_loss, 9) AS val_loss,
           round(cat_acc, 9) AS cat_acc, round(subcat_acc, 9) AS subcat_acc, round(assign_acc, 9) AS assign_acc
           FROM em JOIN vl USING (epoch))"""
    return "WITH " + lg + ",\n" + ls + ",\n" + rest


@query("epoch_metrics", _epoch_sql() + "\nSELECT * FROM ep")
def q_epoch_metrics(spark, sf):
    m = _epochs(spark, sf)
    m = m.select(F.col("epoch").cast("int").alias("epoch"), *[F.round(c, 9).alias(c) for c in _EPOCH_COLS])
    path = IO.scratch_path(spark, "metrics")
    m.write.mode("append").parquet(path)  # the append-only metrics log
    return spark.read.parquet(path)


@query("early_stop_trace", _epoch_sql() + """,
t AS (SELECT *, min(val_loss) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM ep),
t2 AS (SELECT *, best_before IS NULL OR val_loss < best_before AS improved FROM t),
t3 AS (SELECT *, (epoch - max(CASE WHEN improved THEN epoch END) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::INTEGER
         AS patience_counter FROM t2),
t4 AS (SELECT *, min(CASE WHEN patience_counter >= 3 THEN epoch END) OVER () AS stop_epoch FROM t3)
SELECT epoch, train_loss, val_loss, cat_acc, subcat_acc, assign_acc, best_before, improved, patience_counter, stop_epoch,
       stop_epoch IS NULL OR epoch <= stop_epoch AS reached, least(coalesce(best_before, val_loss), val_loss) AS best_so_far
FROM t4""")
def q_early_stop_trace(spark, sf):
    m = _epochs(spark, sf)
    m = m.select(F.col("epoch").cast("int").alias("epoch"), *[F.round(c, 9).alias(c) for c in _EPOCH_COLS])
    return EV.early_stop_trace(m)


@query("truncation_rate", f"""SELECT round(avg((len({__import__('tixprep.oracle', fromlist=['d_words']).d_words('text')}) > 512)::DOUBLE), 9)
  AS truncation_rate, count(*) AS n_texts FROM documents""")
def q_truncation_rate(spark, sf):
    d = EN.truncation_rate(read_table(spark, sf, "documents"), "text")
    return d.select(F.round("truncation_rate", 9).alias("truncation_rate"), "n_texts")


def _encode_sql() -> str:
    from tixprep.oracle import d_words
    return sql(BASE_CTE, f"w AS (SELECT number_fld, {d_words('description')} AS words FROM base)",
               """voc AS (SELECT word, (row_number() OVER (ORDER BY n DESC, word) - 1 + 2)::INTEGER AS token_id
                  FROM (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM w) GROUP BY word))""",
               """p AS (SELECT number_fld, unnest(words[1:512]) AS word, unnest(range(1, len(words[1:512]) + 1)) AS pos FROM w)""",
               """ids AS (SELECT p.number_fld, list(coalesce(voc.token_id, 1) ORDER BY p.pos) AS ids
                  FROM p LEFT JOIN voc USING (word) GROUP BY p.number_fld)""",
               body="""SELECT w.number_fld,
  array_to_string((coalesce(ids.ids, []::INTEGER[]) || list_transform(range(0, 512), lambda x: 0))[1:512], ',') AS input_ids,
  array_to_string(list_transform(range(0, 512), lambda x: CASE WHEN x < len(w.words) THEN 1 ELSE 0 END), ',') AS attention_mask
FROM w LEFT JOIN ids USING (number_fld)""")


@query("encode_fixed_length", _encode_sql())
def q_encode_fixed_length(spark, sf):
    from tixprep.session import cut_lineage
    b = cut_lineage(base(spark, sf).select("number_fld", "description"))  # read for the vocabulary and for the ids
    vocab = EN.vocabulary(b, "description")
    out = EN.encode_fixed_length(b, "description", vocab, "number_fld")
    return out.select("number_fld", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("input_ids", "attention_mask")])


def _samples(spark, sf, oversample=True):
    from tixprep.plans.prepare import prepare_training_set
    from tixprep.queries.q_augment import lexicon
    return prepare_training_set(tk(spark, sf), lexicon(spark, sf), oversample=oversample)


def _written_samples(spark, sf):
    """The training set, written once: split, sizes, rows and dictionary read it again."""
    from tixprep.session import cut_lineage
    return cut_lineage(_samples(spark, sf))


def _prepare_sql(as_cte: bool = False):
    from tixprep.queries.q_augment import CHAIN_CTE, LEX_CTES, PATH, chain_text_ctes
    ctes = [BASE_CTE, MERGED_CTE, CHAIN_CTE, *LEX_CTES, *chain_text_ctes()]
    ctes += ["""fin AS (SELECT category, subcategory, assignment_group, n * f1 * f2 * f3 AS nf FROM chain)""",
             """wt AS (SELECT category, subcategory, assignment_group,
                  sqrt(1.0 / sum(nf) OVER (PARTITION BY category)) AS a, sqrt(1.0 / sum(nf) OVER (PARTITION BY subcategory)) AS b,
                  sqrt(1.0 / sum(nf) OVER (PARTITION BY assignment_group)) AS c FROM fin)""",
             """pl AS (SELECT category, subcategory, assignment_group,
                  round(least(10.0, greatest(1.0, pow((a / min(a) OVER ()) * (b / min(b) OVER ()) * (c / min(c) OVER ()), 1.0 / 3.0))), 9) AS sample_weight,
                  (dense_rank() OVER (ORDER BY category) - 1)::INTEGER AS category_code,
                  (dense_rank() OVER (ORDER BY subcategory) - 1)::INTEGER AS subcategory_code,
                  (dense_rank() OVER (ORDER BY assignment_group) - 1)::INTEGER AS assignment_group_code FROM wt)"""]
    body = f"""SELECT z3.src AS src_id, {PATH} AS aug_no, txt AS text, category, subcategory, assignment_group,
       category_code, subcategory_code, assignment_group_code, sample_weight
FROM z3 JOIN pl USING (category, subcategory, assignment_group)"""
    if as_cte:
        return ctes + [f"samples AS ({body})"]
    return sql(*ctes, body=body)


@query("prepare_training_set", _prepare_sql())
def q_prepare_training_set(spark, sf):
    return _samples(spark, sf).withColumn("sample_weight", F.round("sample_weight", 9))


def _bundle_sql() -> str:
    from tixprep.oracle import d_uniform
    key = "(CAST(src_id AS VARCHAR) || ':' || CAST(aug_no AS VARCHAR))"
    ctes = _prepare_sql(as_cte=True) + [
        "c AS (SELECT category, count(*) AS n FROM samples GROUP BY category)",
        "t AS (SELECT *, sum(n) OVER () AS nn, ceil(sum(n) OVER () * 0.1)::BIGINT AS nv FROM c)",
        "a AS (SELECT *, (nn - nv) * n // nn AS fl, ((nn - nv) * n) % nn AS rem FROM t)",
        "b AS (SELECT *, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, category) <= (nn - nv) - sum(fl) OVER () THEN 1 ELSE 0 END AS n_train FROM a)",
        "l AS (SELECT category, n, nv, n - n_train AS lft, sum(n - n_train) OVER () AS tl FROM b)",
        "m AS (SELECT *, nv * lft // tl AS fl2, (nv * lft) % tl AS rem2 FROM l)",
        "q AS (SELECT category, fl2 + CASE WHEN row_number() OVER (ORDER BY rem2 DESC, category) <= nv - sum(fl2) OVER () THEN 1 ELSE 0 END AS n_val FROM m)",
        f"r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {d_uniform(42, key, 'split')}, {key}) AS rk FROM samples)",
    ]
    body = """SELECT r.src_id, r.aug_no, CASE WHEN r.rk <= q.n_val THEN 'val' ELSE 'train' END AS split, r.text,
       r.category, r.subcategory, r.assignment_group, r.category_code, r.subcategory_code, r.assignment_group_code, r.sample_weight
FROM r JOIN q USING (category)"""
    return sql(*ctes, body=body)


def _bundle(spark, sf):
    """The written bundle of the whole training set: samples with their split, dictionary, weights. Split, dictionary
    and weights follow from keys and labels, so the texts are written once, into the bundle."""
    from tixprep.operators.classes import level_weights
    from tixprep.operators.sampling import stratified_split
    from tixprep.plans.prepare import sample_keys
    from tixprep.session import cut_lineage
    key = F.concat_ws(":", "src_id", "aug_no").alias("_k")
    keys = cut_lineage(sample_keys(tk(spark, sf)).select(key, *S.TARGETS))
    s = stratified_split(_samples(spark, sf).select("*", key), "category", "_k", keys=keys).drop("_k")
    return IO.sink_bundle(s, EN.label_dictionary(keys), level_weights(keys), IO.scratch_path(spark, "bundle"))


_BUNDLE_COLS = ["src_id", "aug_no", "split", "text", *S.TARGETS, *[t + "_code" for t in S.TARGETS]]


@query("sink_bundle", _bundle_sql())
def q_sink_bundle(spark, sf):
    samples, _, _ = IO.scan_bundle(spark, _bundle(spark, sf))
    return samples.select(*_BUNDLE_COLS, F.round("sample_weight", 9).alias("sample_weight"))


_TARGET_ROWS = " UNION ALL ".join(f"SELECT '{t}' AS target, {t} AS label, count(*) AS n FROM samples GROUP BY {t}" for t in S.TARGETS)


@query("scan_bundle", sql(*_prepare_sql(as_cte=True), f"lb AS ({_TARGET_ROWS})", body="""
SELECT target, label, (dense_rank() OVER (PARTITION BY target ORDER BY label) - 1)::INTEGER AS code, n,
       round(sqrt(1.0 / n) / sqrt(1.0 / max(n) OVER (PARTITION BY target)), 9) AS level_weight FROM lb"""))
def q_scan_bundle(spark, sf):
    _, dic, levels = IO.scan_bundle(spark, _bundle(spark, sf))
    return dic.join(levels.withColumnRenamed("value", "label"), ["target", "label"]).select(
        "target", "label", "code", "n", F.round("level_weight", 9).alias("level_weight"))


@query("bundle_to_rows", sql(*_prepare_sql(as_cte=True), body="""
SELECT src_id, aug_no, text, category, subcategory, assignment_group, sample_weight FROM samples"""))
def q_bundle_to_rows(spark, sf):
    samples, dic, _ = IO.scan_bundle(spark, _bundle(spark, sf))
    codes = samples.select("src_id", "aug_no", "text", "sample_weight", *[t + "_code" for t in S.TARGETS])
    dec = EN.label_decode(codes, dic, {t: t + "_code" for t in S.TARGETS}, strict=True)
    return dec.select("src_id", "aug_no", "text", *[F.col(f"{t}_label").alias(t) for t in S.TARGETS], F.round("sample_weight", 9).alias("sample_weight"))


def _wide_sql() -> str:
    """Field-aware copies: in each pass fields 0 and 1 of an edited copy change, and the text with them."""
    from tixprep.oracle import d_edit
    from tixprep.queries.q_augment import CHAIN_CTE, LEX_CTES, PATH
    from tixprep.queries.q_text import _COMB
    filled = {c: f"coalesce(m.{c}, '{d}') AS {c}" for c, d in
              (("priority", "UnknownPriority"), ("contact_type", "OtherContact"), ("location", "UnknownLocation"),
               ("u_department", "UnknownDepartment"), ("opened_by_department", "UnknownDepartment"))}
    ctes = [BASE_CTE, MERGED_CTE, CHAIN_CTE, *LEX_CTES,
            f"""r0 AS (SELECT m.number_fld AS src, m.category, m.subcategory, m.assignment_group, m.short_description, m.description,
                  {', '.join(filled.values())}, {_COMB} AS text, c.f1, c.f2, c.f3
                FROM merged m JOIN chain c USING (category, subcategory, assignment_group))"""]
    src, path, ok = "r0", "CAST(src AS VARCHAR)", "_ok"
    for k in (1, 2, 3):
        path += f" || '.' || CAST(i{k} AS VARCHAR)"
        keep = "" if k == 1 else " EXCLUDE (rk)"
        ctes += [f"u{k} AS (SELECT *{keep}, unnest(range(0, f{k})) AS i{k} FROM {src})",
                 f"e{k} AS (SELECT *, {path} AS rk, string_split(text, ' [SEP] ') AS parts FROM u{k})",
                 f"o{k} AS (SELECT *, i{k} > 0 AND len(parts) >= 7 AS _ok, parts[1] AS txt FROM e{k})", *d_edit(f"a{k}", f"o{k}", f"p{k}:f0", ok),
                 f"b{k} AS (SELECT * EXCLUDE (txt), txt AS _f0, parts[2] AS txt FROM a{k})", *d_edit(f"c{k}", f"b{k}", f"p{k}:f1", ok),
                 f"""z{k} AS (SELECT * EXCLUDE (txt, _f0, _ok, parts, text, short_description, description),
                      CASE WHEN _ok THEN array_to_string([_f0, txt] || parts[3:], ' [SEP] ') ELSE text END AS text,
                      CASE WHEN _ok THEN _f0 ELSE short_description END AS short_description, CASE WHEN _ok THEN txt ELSE description END AS description FROM c{k})"""]
        src = f"z{k}"
    plan = [c for c in _prepare_sql(as_cte=True) if c.lstrip().startswith(("fin AS", "wt AS", "pl AS"))]
    return sql(*ctes, *plan, body=f"""SELECT src AS src_id, {PATH} AS aug_no, text, category, subcategory, assignment_group, category_code, subcategory_code,
       assignment_group_code, sample_weight, short_description, description, priority, contact_type, location, u_department, opened_by_department
FROM z3 JOIN pl USING (category, subcategory, assignment_group)""")


@query("sink_bundle_wide", _wide_sql())
def q_sink_bundle_wide(spark, sf):
    """The dictionary follows from the labels of the copies, so the texts are written once, into the bundle."""
    from tixprep.plans.prepare import prepare_training_set, sample_keys
    from tixprep.queries.q_augment import lexicon
    s = prepare_training_set(tk(spark, sf), lexicon(spark, sf), field_aware=True)
    path = IO.sink_bundle(s, EN.label_dictionary(sample_keys(tk(spark, sf))), None, IO.scratch_path(spark, "bundle-wide"))
    samples, _, _ = IO.scan_bundle(spark, path)
    return samples.withColumn("sample_weight", F.round("sample_weight", 9))


@query("sink_report")
def q_sink_report(spark, sf):
    from tixprep.plans.report import profile_report
    rep = profile_report(tk(spark, sf))
    path = IO.sink_report(rep, IO.scratch_path(spark, "report"))
    # the text view, read back: one line per metric, four fields
    cells = F.split("value", " [|] ")
    return spark.read.text(f"{path}/text").select(*[cells[i].alias(c) for i, c in enumerate(["section", "item", "metric", "value"])])


def _table_profile_sql() -> str:
    from tixprep.queries.q_profile import ALL, TYPES
    parts = []
    for c in ALL:
        t = TYPES.get(c, "string")
        num = t != "string"
        top = f"(SELECT {c} AS v, count(*) AS n FROM tickets WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, v LIMIT 1)"
        parts.append(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS n_unique, "
            f"(SELECT CAST(v AS VARCHAR) FROM {top}) AS top_value, (SELECT n FROM {top}) AS top_count, "
            f"(SELECT string_agg(left(CAST(v AS VARCHAR), 40) || '=' || n, '; ' ORDER BY n DESC, v) FROM {top.replace('LIMIT 1', 'LIMIT 5')}) AS top_values, "
            + (f"round(avg({c}), 6) AS mean, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max" if num
               else "NULL::DOUBLE AS mean, NULL::DOUBLE AS min, NULL::DOUBLE AS max")
            + " FROM tickets")
    return sql(body=" UNION ALL ".join(parts))


@query("table_profile", _table_profile_sql())
def q_table_profile(spark, sf):
    from tixprep.plans.report import table_profile
    return table_profile(tk(spark, sf)).withColumn("mean", F.round("mean", 6))


_NUM, _CAT = ["total_price", "value"], ["category", "subcategory", "priority"]


def _association_sql() -> str:
    parts = [f"SELECT '{a}' AS column_a, '{b}' AS column_b, 'pearson' AS kind, corr(x, y) AS value FROM (SELECT {a} AS x, {b} AS y FROM tickets WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
             for a in _NUM for b in _NUM]
    parts += [f"""SELECT '{c}', '{x}', 'eta', sqrt(sum(n * pow(m - mm, 2)) / any_value(t)) FROM (
      SELECT {c} AS g, count(*) AS n, avg({x}) AS m FROM tickets WHERE {c} IS NOT NULL AND {x} IS NOT NULL GROUP BY {c}),
      (SELECT avg({x}) AS mm, var_pop({x}) * count(*) AS t FROM tickets WHERE {c} IS NOT NULL AND {x} IS NOT NULL)""" for c in _CAT for x in _NUM]
    for a in _CAT:
        for b in _CAT:
            if a != b:
                ab = f"(SELECT {a} AS a, {b} AS b, count(*) AS n FROM tickets WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL)"
                parts.append(f"""SELECT '{a}', '{b}', 'uncertainty', (ha - hab) / ha FROM
      (SELECT -sum(p * ln(p)) AS ha FROM (SELECT sum(n) / sum(sum(n)) OVER () AS p FROM {ab} GROUP BY a)),
      (SELECT -sum(n / t * ln(n / nb)) AS hab FROM (SELECT n, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER () AS t FROM {ab}))""")
    return sql(body="SELECT column_a, column_b, kind, round(value, 6) AS value FROM (" + " UNION ALL ".join(parts) + ")")


@query("association_matrix", _association_sql())
def q_association_matrix(spark, sf):
    from tixprep.operators.profile import association_matrix
    return association_matrix(tk(spark, sf), _NUM, _CAT).withColumn("value", F.round("value", 6))


@query("train_three_heads")
def q_train_three_heads(spark, sf):
    from tixprep.operators.sampling import stratified_split
    from tixprep.operators.score import score_multi_head, train_three_heads
    s = _written_samples(spark, sf).withColumn("_k", F.concat_ws(":", "src_id", "aug_no"))
    s = stratified_split(s, "category", "_k")
    model = train_three_heads(s.filter(F.col("split") == "train"))
    val = s.filter(F.col("split") == "val")
    return score_multi_head(model, val, EN.label_dictionary(s), keep=["src_id", "aug_no", "category"])


@query("score_multi_head")
def q_score_multi_head(spark, sf):
    from tixprep.operators.fields import combine_text7_clean
    from tixprep.operators.score import score_multi_head, train_three_heads
    s = _written_samples(spark, sf)
    model = train_three_heads(s)
    t = combine_text7_clean(tk(spark, sf)).withColumnRenamed("combined_text", "text")
    return score_multi_head(model, t, EN.label_dictionary(s), keep=["number_fld"])


@query("map_text", "SELECT doc_id, text, CAST(length(text) AS VARCHAR) AS n_chars_text FROM documents")
def q_map_text(spark, sf):
    from tixprep.operators.udf import map_text
    return map_text(read_table(spark, sf, "documents").select("doc_id", "text"), "text", lambda s: s.str.len().astype(str), "n_chars_text")


@query("map_row", "SELECT o_orderkey, round_even(o_totalprice, 0) AS o_totalprice FROM orders")
def q_map_row(spark, sf):
    from tixprep.operators.udf import map_row
    d = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return map_row(d, lambda b: b.assign(o_totalprice=b.o_totalprice.round(0)), d.schema)


@query("map_batch", "SELECT doc_id, reverse(text) AS transformed FROM documents")
def q_map_batch(spark, sf):
    from tixprep.operators.udf import map_batch
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return map_batch(d, lambda ts: [t[::-1] for t in ts], "text", ["doc_id"], 100)


def _manual_sql() -> str:
    from tixprep.oracle import TICKETS_CTE, d_clean_strict
    d = {c: f"coalesce({c}, '{v}')" for c, v in S.DEFAULTS["manual"].items() if c not in S.TEXT_FIELDS}
    text = ", ".join([d_clean_strict(c) for c in S.TEXT_FIELDS] + [d.get(c, c) for c in S.COMBINED_FIELDS if c not in S.TEXT_FIELDS])
    return f"""WITH {TICKETS_CTE},
mb AS (SELECT number_fld AS src_id, concat_ws(' [SEP] ', {text}) AS text, category, subcategory, assignment_group FROM tickets
       WHERE category IS NOT NULL AND subcategory IS NOT NULL AND assignment_group IS NOT NULL),
mv AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY category, subcategory, assignment_group) AS nn FROM mb) WHERE nn >= 5),
mw AS (SELECT *, sqrt(1.0 / count(*) OVER (PARTITION BY category)) AS a, sqrt(1.0 / count(*) OVER (PARTITION BY subcategory)) AS b,
       sqrt(1.0 / count(*) OVER (PARTITION BY assignment_group)) AS c FROM mv)
SELECT src_id, text, category, subcategory, assignment_group,
       (dense_rank() OVER (ORDER BY category) - 1)::INTEGER AS category_code, (dense_rank() OVER (ORDER BY subcategory) - 1)::INTEGER AS subcategory_code,
       (dense_rank() OVER (ORDER BY assignment_group) - 1)::INTEGER AS assignment_group_code,
       round(least(10.0, greatest(1.0, pow((a / min(a) OVER ()) * (b / min(b) OVER ()) * (c / min(c) OVER ()), 1.0 / 3.0))), 9) AS sample_weight FROM mw"""


@query("prepare_manual_set", _manual_sql())
def q_prepare_manual_set(spark, sf):
    from tixprep.plans.manual import write_manual_bundle
    samples, dictionary, _ = IO.scan_bundle(spark, write_manual_bundle(tk(spark, sf), IO.scratch_path(spark, "manual")))
    dec = EN.label_decode(samples.drop(*S.TARGETS), dictionary, {t: t + "_code" for t in S.TARGETS}, strict=True)
    return dec.select("src_id", "text", *[F.col(f"{t}_label").alias(t) for t in S.TARGETS], *[t + "_code" for t in S.TARGETS],
                      F.round("sample_weight", 9).alias("sample_weight"))


@query("train_and_log")
def q_train_and_log(spark, sf):
    from tixprep.operators.sampling import stratified_split
    from tixprep.plans.train_log import train_and_log
    s = _written_samples(spark, sf).withColumn("_k", F.concat_ws(":", "src_id", "aug_no"))
    return train_and_log(stratified_split(s, "category", "_k"), "_k")
