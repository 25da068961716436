"""§2.5/2.6 split, sampling, shuffling and batching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tixprep.oracle import d_uniform
from tixprep.operators import sampling as SM
from tixprep.queries import query
from tixprep.queries.common import BASE_CTE, MERGED_CTE, merged, merged_labels, sql, tk

U_SPLIT = d_uniform(42, "number_fld", "split")


_SPLIT_SQL = f"""splits AS (WITH c AS (SELECT category, count(*) AS n FROM merged GROUP BY category),
  t AS (SELECT *, sum(n) OVER () AS nn, ceil(sum(n) OVER () * 0.1)::BIGINT AS nv FROM c),
  a AS (SELECT *, (nn - nv) * n // nn AS fl, ((nn - nv) * n) % nn AS rem FROM t),
  b AS (SELECT *, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, category) <= (nn - nv) - sum(fl) OVER () THEN 1 ELSE 0 END AS n_train FROM a),
  l AS (SELECT category, n, nv, n - n_train AS lft, sum(n - n_train) OVER () AS tl FROM b),
  m AS (SELECT *, nv * lft // tl AS fl2, (nv * lft) % tl AS rem2 FROM l),
  q AS (SELECT category, fl2 + CASE WHEN row_number() OVER (ORDER BY rem2 DESC, category) <= nv - sum(fl2) OVER () THEN 1 ELSE 0 END AS n_val FROM m),
  r AS (SELECT number_fld, category, row_number() OVER (PARTITION BY category ORDER BY {U_SPLIT}, number_fld) AS rk FROM merged)
  SELECT r.number_fld, r.category, CASE WHEN r.rk <= q.n_val THEN 'val' ELSE 'train' END AS split
  FROM r JOIN q USING (category))"""


@query("stratified_split", sql(BASE_CTE, MERGED_CTE, _SPLIT_SQL, body="SELECT number_fld, category, split FROM splits"))
def q_stratified_split(spark, sf):
    return SM.stratified_split(merged(spark, sf).select("number_fld", "category"), "category", "number_fld")


@query("uniform_sample", sql(body=f"""
SELECT number_fld, category, priority FROM tickets ORDER BY {d_uniform(42, 'number_fld', 'sample')}, number_fld LIMIT 15"""))
def q_uniform_sample(spark, sf):
    return SM.uniform_sample(tk(spark, sf).select("number_fld", "category", "priority"), "number_fld", 15)


@query("shuffle_rows", sql(body=f"""
SELECT number_fld, row_number() OVER (ORDER BY {d_uniform(42, 'number_fld', 'shuffle')}, number_fld) AS position FROM tickets"""))
def q_shuffle_rows(spark, sf):
    return SM.shuffle_rows(tk(spark, sf).select("number_fld"), "number_fld")


@query("batch_index", sql(BASE_CTE, body="""
SELECT number_fld, ((row_number() OVER (ORDER BY number_fld) - 1) // 128)::INTEGER AS batch FROM base"""))
def q_batch_index(spark, sf):
    from tixprep.queries.common import base
    return SM.batch_index(base(spark, sf).select("number_fld"), "number_fld")


@query("weighted_sample_replace", sql(BASE_CTE, MERGED_CTE, _SPLIT_SQL, body=f"""
WITH w AS (SELECT number_fld,
        sqrt(1.0 / count(*) OVER (PARTITION BY category)) AS a, sqrt(1.0 / count(*) OVER (PARTITION BY subcategory)) AS b,
        sqrt(1.0 / count(*) OVER (PARTITION BY assignment_group)) AS c FROM merged),
v AS (SELECT number_fld, least(10.0, greatest(1.0, pow((a / min(a) OVER ()) * (b / min(b) OVER ()) * (c / min(c) OVER ()), 1.0 / 3.0))) AS sw FROM w),
tv AS (SELECT v.* FROM v JOIN splits USING (number_fld) WHERE split = 'train'),
iw AS (SELECT number_fld AS key, round(sw / (SELECT min(sw) FROM tv) * 1e6)::BIGINT AS w,
        (('0x' || substr(md5(concat_ws('|', '42', CAST(number_fld AS VARCHAR), 'bucket')), 1, 8))::BIGINT % 65536) AS bk FROM tv),
iv AS (SELECT key, sum(w) OVER (ORDER BY bk, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo0, w FROM iw),
iv2 AS (SELECT key, coalesce(lo0, 0) AS lo, coalesce(lo0, 0) + w AS hi FROM iv),
tot AS (SELECT sum(w)::HUGEINT AS ww FROM iw),
dr AS (SELECT number_fld AS draw, ((('0x' || substr(md5(concat_ws('|', '42', CAST(number_fld AS VARCHAR), 'draw')), 1, 15))::BIGINT::HUGEINT * ww)
        // 1152921504606846976::HUGEINT)::BIGINT AS x FROM tv, tot)
SELECT dr.draw, iv2.key AS number_fld FROM dr JOIN iv2 ON iv2.lo <= dr.x AND dr.x < iv2.hi"""))
def q_weighted_sample_replace(spark, sf):
    # weights of the whole set, draws over the training part of its split
    from tixprep.operators.classes import sample_weights
    w = SM.stratified_split(sample_weights(merged_labels(spark, sf)), "category", "number_fld").filter("split = 'train'")
    return SM.weighted_sample_replace(w, "sample_weight", "number_fld")


_COPIES = """copies AS (SELECT number_fld * 10 + i AS row_id, number_fld, category FROM merged, (SELECT unnest(range(0, 5)) AS i) WHERE i <= number_fld % 5),
grp AS (SELECT number_fld, min(category) AS category, count(*) AS n FROM copies GROUP BY number_fld),
cl AS (SELECT category, sum(n)::BIGINT AS n FROM grp GROUP BY category),
t1 AS (SELECT *, sum(n) OVER () AS nn, ceil(sum(n) OVER () * 0.1)::BIGINT AS nv FROM cl),
t2 AS (SELECT *, (nn - nv) * n // nn AS fl, ((nn - nv) * n) % nn AS rem FROM t1),
t3 AS (SELECT *, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, category) <= (nn - nv) - sum(fl) OVER () THEN 1 ELSE 0 END AS n_train FROM t2),
t4 AS (SELECT category, n, nv, n - n_train AS lft, sum(n - n_train) OVER () AS tl FROM t3),
t5 AS (SELECT category, nv, nv * lft // tl AS fl2, (nv * lft) % tl AS rem2 FROM t4),
qu AS (SELECT category, fl2 + CASE WHEN row_number() OVER (ORDER BY rem2 DESC, category) <= nv - sum(fl2) OVER () THEN 1 ELSE 0 END AS n_val FROM t5)"""


@query("stratified_split_by_source", sql(BASE_CTE, MERGED_CTE, _COPIES, body=f"""
WITH u AS (SELECT *, sum(n) OVER (PARTITION BY category ORDER BY {d_uniform(42, 'number_fld', 'split')}, CAST(number_fld AS VARCHAR)) AS run FROM grp)
SELECT row_id, number_fld, copies.category, CASE WHEN u.run <= qu.n_val THEN 'val' ELSE 'train' END AS split
FROM copies JOIN u USING (number_fld) JOIN qu ON qu.category = copies.category"""))
def q_stratified_split_by_source(spark, sf):
    """Tickets with up to four copies each: all copies of a ticket on one side."""
    m = merged_labels(spark, sf).select("number_fld", "category")
    copies = m.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("number_fld") % 5))).select(
        (F.col("number_fld") * 10 + F.col("_i")).alias("row_id"), "number_fld", "category")
    return SM.stratified_split_by_source(copies, "category", "number_fld", "row_id")
