"""§2.3 joins on class tables, §2.4 class aggregates, §2.5 coverage and label encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from tixprep.operators import classes as C
from tixprep.operators import encode as EN
from tixprep.queries import query
from tixprep.queries.common import BASE_CTE, MERGED_CTE, base, labels, merged, merged_labels, sql, tk

TG = ["category", "subcategory", "assignment_group"]


def per_target(op, df, *args, **kwargs):
    """``op`` for each of the three targets, one table with the target's name."""
    out = None
    for t in TG:
        part = op(df, t, *args, **kwargs)
        part = part.select(F.lit(t).alias("target"), *[F.col(c).alias("value") if c == t else F.col(c) for c in part.columns])
        out = part if out is None else out.unionByName(part)
    return out


def per_target_sql(*ctes: str, select: str) -> str:
    """``select`` (with {t} for the target) for each of the three targets."""
    return sql(*ctes, body=" UNION ALL ".join(f"(SELECT '{t}' AS target, * FROM ({select.format(t=t)}))" for t in TG))


@query("value_counts", per_target_sql(BASE_CTE, select="""
SELECT {t} AS value, count(*) AS n FROM base WHERE {t} IS NOT NULL GROUP BY {t} ORDER BY n DESC, value LIMIT 10"""))
def q_value_counts(spark, sf):
    return per_target(C.value_counts, base(spark, sf), k=10)


@query("value_counts_with_null", per_target_sql(select="""
SELECT {t} AS value, count(*) AS n FROM tickets GROUP BY {t} ORDER BY n DESC, value NULLS FIRST LIMIT 20"""))
def q_value_counts_with_null(spark, sf):
    return per_target(C.value_counts, tk(spark, sf), k=20, keep_null=True)


@query("top_k_classes", per_target_sql(BASE_CTE, select="""
SELECT {t} AS value, count(*) AS n FROM base GROUP BY {t} ORDER BY n DESC, value LIMIT 5"""))
def q_top_k_classes(spark, sf):
    return per_target(C.value_counts, base(spark, sf), k=5)


@query("class_distribution", per_target_sql(BASE_CTE, select="""
SELECT {t} AS value, count(*) AS n, count(*) / (SELECT count(*) FROM base) * 100.0 AS percentage,
       (SELECT count(DISTINCT {t}) FROM base) AS n_classes
FROM base WHERE {t} IS NOT NULL GROUP BY {t}"""))
def q_class_distribution(spark, sf):
    return per_target(C.class_distribution, base(spark, sf))


@query("imbalance_ratio", sql(BASE_CTE, body="""
SELECT 'category' AS target, max(n) / min(n) AS imbalance_ratio FROM (SELECT count(*) AS n FROM base GROUP BY category)
UNION ALL SELECT 'subcategory', max(n) / min(n) FROM (SELECT count(*) AS n FROM base GROUP BY subcategory)
UNION ALL SELECT 'assignment_group', max(n) / min(n) FROM (SELECT count(*) AS n FROM base GROUP BY assignment_group)"""))
def q_imbalance_ratio(spark, sf):
    b = base(spark, sf)
    out = None
    for t in TG:
        part = C.imbalance_ratio(b, t).select(F.lit(t).alias("target"), "imbalance_ratio")
        out = part if out is None else out.unionByName(part)
    return out


@query("merge_rare_classes", sql(BASE_CTE, MERGED_CTE, body="""
SELECT number_fld, category, subcategory, assignment_group FROM merged"""))
def q_merge_rare_classes(spark, sf):
    return merged(spark, sf).select("number_fld", *TG)


@query("rare_class_set", per_target_sql(BASE_CTE, select="SELECT {t} AS value, count(*) AS n FROM base GROUP BY {t} HAVING count(*) < 50"))
def q_rare_class_set(spark, sf):
    return per_target(C.rare_class_set, base(spark, sf))


@query("minority_class_set", per_target_sql(BASE_CTE, MERGED_CTE, select="""
SELECT value, n FROM (SELECT {t} AS value, count(*) AS n, max(count(*)) OVER () AS mx FROM merged GROUP BY {t})
WHERE n < mx * 0.3 AND value <> 'Other'"""))
def q_minority_class_set(spark, sf):
    return per_target(C.minority_class_set, merged(spark, sf))


@query("heavy_class_flag", sql(BASE_CTE, body="""
SELECT number_fld,
  (count(*) OVER (PARTITION BY category) < 50 OR count(*) OVER (PARTITION BY subcategory) < 50
   OR count(*) OVER (PARTITION BY assignment_group) < 50) AS is_rare,
  (count(*) OVER (PARTITION BY category) < 25 OR count(*) OVER (PARTITION BY subcategory) < 25
   OR count(*) OVER (PARTITION BY assignment_group) < 25) AS is_heavy
FROM base"""))
def q_heavy_class_flag(spark, sf):
    from tixprep.operators.augment import rare_flags
    return rare_flags(base(spark, sf)).select("number_fld", "is_rare", "is_heavy")


_INVERSE = """SELECT value, n, w / min(w) OVER () AS class_weight FROM (
  SELECT value, n, (SELECT count(*) FROM base) / (count(*) OVER () * n) AS w FROM (SELECT {t} AS value, count(*) AS n FROM base GROUP BY {t}))"""


@query("class_weights_inverse", per_target_sql(BASE_CTE, select=_INVERSE))
def q_class_weights_inverse(spark, sf):
    return per_target(C.class_weights_inverse, base(spark, sf))


@query("weight_summary", per_target_sql(BASE_CTE, select=f"""
SELECT round(min(class_weight), 9) AS min_weight, round(max(class_weight), 9) AS max_weight, round(avg(class_weight), 9) AS mean_weight FROM ({_INVERSE})"""))
def q_weight_summary(spark, sf):
    s = per_target(C.weight_summary, base(spark, sf))
    return s.select("target", *[F.round(c, 9).alias(c) for c in s.columns if c != "target"])


@query("rare_and_dominant", per_target_sql(BASE_CTE, select="""
SELECT {t} AS value, count(*) AS n,
  round_even(count(*) / (SELECT count(*) FROM base) * 100, 2)::DOUBLE AS percentage,
  round_even(count(*) / (SELECT count(*) FROM base) * 100, 2) < 0.001 AS is_rare,
  round_even(count(*) / (SELECT count(*) FROM base) * 100, 2) > 10.0 AS is_dominant
FROM base GROUP BY {t}"""))
def q_rare_and_dominant(spark, sf):
    return per_target(C.rare_and_dominant, base(spark, sf))


_BAND = "CASE WHEN l_quantity <= 1 THEN 'one' WHEN l_quantity <= 3 THEN 'few' ELSE 'many' END"


@query("sampling_strategy", f"""
SELECT value, n, floor(least(mx * 0.5, n * 3.0))::BIGINT AS target_n FROM (
  SELECT {_BAND} AS value, count(*) AS n, max(count(*)) OVER () AS mx FROM lineitem GROUP BY ALL)
WHERE n >= 50 AND n < mx * 0.1""")
def q_sampling_strategy(spark, sf):
    # quantity bands of line items: no label of the tables has a class of at least 50 rows that is
    # below a tenth of the largest
    from tixprep.sources.tables import read_table
    return C.sampling_strategy(read_table(spark, sf, "lineitem").select(F.expr(_BAND).alias("band")), "band")


@query("sampling_warnings", per_target_sql(BASE_CTE, select="SELECT {t} AS value, count(*) AS n FROM base GROUP BY {t} HAVING count(*) < 50"))
def q_sampling_warnings(spark, sf):
    return per_target(C.sampling_warnings, base(spark, sf))


@query("cumulative_coverage", sql(BASE_CTE, body="""
WITH c AS (SELECT assignment_group AS value, count(*) AS n FROM base GROUP BY assignment_group),
r AS (SELECT value, n, row_number() OVER (ORDER BY n DESC, value) AS class_rank,
             sum(n) OVER (ORDER BY n DESC, value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS cum_n
      FROM c)
SELECT value, n, class_rank, cum_n, cum_n / (SELECT count(*) FROM base) * 100.0 AS cum_pct,
       (cum_n / (SELECT count(*) FROM base) * 100.0 - n / (SELECT count(*) FROM base) * 100.0) < 80.0 AS needed
FROM r"""))
def q_cumulative_coverage(spark, sf):
    return C.cumulative_coverage(base(spark, sf), "assignment_group")


_W_SQL = """
w AS (SELECT number_fld, category, subcategory, assignment_group,
        sqrt(1.0 / count(*) OVER (PARTITION BY category)) AS a,
        sqrt(1.0 / count(*) OVER (PARTITION BY subcategory)) AS b,
        sqrt(1.0 / count(*) OVER (PARTITION BY assignment_group)) AS c
      FROM merged),
v AS (SELECT number_fld, category, subcategory, assignment_group,
        (a / min(a) OVER ()) AS w0, (b / min(b) OVER ()) AS w1, (c / min(c) OVER ()) AS w2 FROM w)"""


@query("sample_weights", sql(BASE_CTE, MERGED_CTE, _W_SQL.strip(), body="""
SELECT number_fld, round(least(10.0, greatest(1.0, pow(w0 * w1 * w2, 1.0 / 3.0))), 9) AS sample_weight FROM v"""))
def q_sample_weights(spark, sf):
    d = C.sample_weights(merged(spark, sf))
    return d.select("number_fld", F.round("sample_weight", 9).alias("sample_weight"))


@query("hierarchical_weights", sql(BASE_CTE, MERGED_CTE, body="""
SELECT target, value, n, round(sqrt(1.0 / n) / sqrt(1.0 / max(n) OVER (PARTITION BY target)), 9) AS level_weight FROM (
  SELECT 'category' AS target, category AS value, count(*) AS n FROM merged GROUP BY category
  UNION ALL SELECT 'subcategory', subcategory, count(*) FROM merged GROUP BY subcategory
  UNION ALL SELECT 'assignment_group', assignment_group, count(*) FROM merged GROUP BY assignment_group)"""))
def q_hierarchical_weights(spark, sf):
    _, levels = C.hierarchical_weights(merged(spark, sf))
    return levels.withColumn("level_weight", F.round("level_weight", 9))


@query("weight_lookup", sql(BASE_CTE, MERGED_CTE, body="""
WITH c AS (SELECT assignment_group AS value, count(*) AS n FROM merged GROUP BY assignment_group),
w AS (SELECT value, (SELECT count(*) FROM merged) / ((SELECT count(*) FROM c) * n) AS w FROM c),
cw AS (SELECT value, w / (SELECT min(w) FROM w) AS class_weight FROM w)
SELECT b.number_fld, b.assignment_group, m.assignment_group AS merged_group, round(coalesce(ca.class_weight, 1.0), 9) AS weight,
       round(cm.class_weight, 9) AS merged_weight
FROM base b JOIN merged m USING (number_fld) LEFT JOIN cw ca ON ca.value = b.assignment_group LEFT JOIN cw cm ON cm.value = m.assignment_group"""))
def q_weight_lookup(spark, sf):
    # weights of the merged groups, looked up by the merged label (all found) and by the label as it
    # was: groups merged away are missing from the table and get 1.0
    b = labels(spark, sf)
    m = C.merge_rare_targets(b)
    w = C.class_weights_inverse(m, "assignment_group")
    d = b.select("number_fld", "assignment_group")
    d = C.weight_lookup(d, w, "assignment_group")
    mm = C.weight_lookup(m.select("number_fld", F.col("assignment_group").alias("merged_group")), w, "merged_group", out="merged_weight", default=None)
    return d.join(mm, "number_fld").select("number_fld", "assignment_group", "merged_group", F.round("weight", 9).alias("weight"),
                                           F.round("merged_weight", 9).alias("merged_weight"))


_DICT_SQL = """
SELECT target, (dense_rank() OVER (PARTITION BY target ORDER BY label) - 1)::INTEGER AS code, label FROM (
  SELECT DISTINCT 'category' AS target, category AS label FROM merged
  UNION SELECT DISTINCT 'subcategory', subcategory FROM merged
  UNION SELECT DISTINCT 'assignment_group', assignment_group FROM merged)"""


@query("label_encode", sql(BASE_CTE, MERGED_CTE, body=_DICT_SQL))
def q_label_encode(spark, sf):
    return EN.label_dictionary(merged(spark, sf))


@query("label_encode4", sql(BASE_CTE, MERGED_CTE, body="""
SELECT target, (dense_rank() OVER (PARTITION BY target ORDER BY label) - 1)::INTEGER AS code, label FROM (
  SELECT DISTINCT 'category' AS target, category AS label FROM merged
  UNION SELECT DISTINCT 'subcategory', subcategory FROM merged
  UNION SELECT DISTINCT 'assignment_group', assignment_group FROM merged
  UNION SELECT DISTINCT 'priority', coalesce(priority, '3 - Medium (4 Days)') FROM merged)"""))
def q_label_encode4(spark, sf):
    from tixprep.operators.fields import fill_defaults
    return EN.label_dictionary(fill_defaults(merged(spark, sf), "manual"), TG + ["priority"])


@query("label_dictionary", sql(BASE_CTE, MERGED_CTE, body=f"""
SELECT target, count(*) AS n_classes FROM ({_DICT_SQL}) GROUP BY target"""))
def q_label_dictionary(spark, sf):
    return EN.label_sizes(EN.label_dictionary(merged(spark, sf)))


@query("label_decode", sql(BASE_CTE, MERGED_CTE, body=f"""
WITH d AS ({_DICT_SQL})
SELECT m.number_fld, dc.code AS category_code, dc.label AS category_label, ds.label AS subcategory_label,
       dg.label AS assignment_group_label
FROM merged m
JOIN d dc ON dc.target = 'category' AND dc.label = m.category
JOIN d ds ON ds.target = 'subcategory' AND ds.label = m.subcategory
JOIN d dg ON dg.target = 'assignment_group' AND dg.label = m.assignment_group"""))
def q_label_decode(spark, sf):
    m = merged_labels(spark, sf)
    d = EN.label_dictionary(m)
    enc = EN.encode_labels(m.select("number_fld", *TG), d)
    dec = EN.label_decode(enc.select("number_fld", *[t + "_code" for t in TG]), d,
                          {t: t + "_code" for t in TG})
    return dec.select("number_fld", "category_code", "category_label", "subcategory_label", "assignment_group_label")


_RARE_DICT = " UNION ".join(f"SELECT DISTINCT '{t}' AS target, {t} AS label FROM base" for t in TG)
_DUAL_COLS = ", ".join(f"m_{t}.label AS main_{t}, r_{t}.label AS rare_{t}" for t in TG)
_DUAL_JOINS = " ".join(
    f"JOIN dm m_{t} ON m_{t}.target = '{t}' AND m_{t}.label = m.{t} LEFT JOIN dr r_{t} ON r_{t}.target = '{t}' AND r_{t}.code = m_{t}.code" for t in TG)


@query("dual_dictionary_decode", sql(BASE_CTE, MERGED_CTE, body=f"""
WITH dm AS ({_DICT_SQL}),
dr AS (SELECT target, (dense_rank() OVER (PARTITION BY target ORDER BY label) - 1)::INTEGER AS code, label FROM ({_RARE_DICT}))
SELECT m.number_fld, {_DUAL_COLS} FROM merged m {_DUAL_JOINS}"""))
def q_dual_dictionary_decode(spark, sf):
    # codes of the merged labels, decoded by the main (merged) and by the rare (un-merged) dictionary
    m = merged(spark, sf)
    dm = EN.label_dictionary(m)
    dual = EN.dual_dictionary(dm, EN.label_dictionary(base(spark, sf)))
    codes = EN.encode_labels(m.select("number_fld", *TG), dm).select("number_fld", *[f"{t}_code" for t in TG])
    cols = {t: f"{t}_code" for t in TG}
    main = EN.label_decode(codes, dual, cols, model="main", strict=True).select("*", *[F.col(f"{t}_label").alias(f"main_{t}") for t in TG]).drop(*[f"{t}_label" for t in TG])
    both = EN.label_decode(main, dual, cols, model="rare")
    return both.select("number_fld", *[f"main_{t}" for t in TG], *[F.col(f"{t}_label").alias(f"rare_{t}") for t in TG])


@query("filter_any_rare", sql(BASE_CTE, body="""
SELECT number_fld, category, subcategory, assignment_group FROM (
  SELECT *, count(*) OVER (PARTITION BY category) AS nc, count(*) OVER (PARTITION BY subcategory) AS ns,
         count(*) OVER (PARTITION BY assignment_group) AS ng FROM base)
WHERE nc < 50 OR ns < 50 OR ng < 50"""))
def q_filter_any_rare(spark, sf):
    from tixprep.operators.augment import rare_flags
    return rare_flags(base(spark, sf)).filter("is_rare").select("number_fld", *TG)


@query("sample_weight_describe", sql(BASE_CTE, MERGED_CTE, _W_SQL.strip(), body="""
SELECT 'sample_weight' AS column_name, count(x) AS count, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS std,
       round(min(x), 9) AS min, round(quantile_cont(x, 0.25), 9) AS p25, round(quantile_cont(x, 0.5), 9) AS p50,
       round(quantile_cont(x, 0.75), 9) AS p75, round(max(x), 9) AS max
FROM (SELECT least(10.0, greatest(1.0, pow(w0 * w1 * w2, 1.0 / 3.0))) AS x FROM v)"""))
def q_sample_weight_describe(spark, sf):
    from tixprep.operators.profile import describe_column
    d = describe_column(C.sample_weights(merged(spark, sf)), "sample_weight")
    return d.select("column_name", "count", *[F.round(c, 9).alias(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])
