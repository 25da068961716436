"""§2.3/2.4/2.6/2.7 label hierarchy and combination queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tixprep.operators import hierarchy as H
from tixprep.operators import product as PR
from tixprep.queries import query
from tixprep.queries.common import BASE_CTE, base, labels, sql

TG = ["category", "subcategory", "assignment_group"]


@query("contingency_table", sql(BASE_CTE, body="""
SELECT category, subcategory, count(*) AS n FROM base GROUP BY category, subcategory"""))
def q_contingency_table(spark, sf):
    return H.contingency_table(base(spark, sf), "category", "subcategory")


_LEVELS = {"category": ["de", "en", "es", "fr", "it"], "subcategory": ["xs", "s", "m", "l", "xl", "xxl"], "assignment_group": ["der", "the", "un"]}


@query("zero_filled_combos", sql(BASE_CTE, body=f"""
WITH l AS (SELECT * FROM (SELECT unnest({_LEVELS['category']}) AS category), (SELECT unnest({_LEVELS['subcategory']}) AS subcategory),
                         (SELECT unnest({_LEVELS['assignment_group']}) AS assignment_group)),
k AS (SELECT category, subcategory, assignment_group, count(*) AS n FROM base GROUP BY ALL)
SELECT category, subcategory, assignment_group, n, 'observed' AS kind FROM k
UNION ALL SELECT l.category, l.subcategory, l.assignment_group, coalesce(k.n, 0)::BIGINT, 'levels' FROM l LEFT JOIN k USING (category, subcategory, assignment_group)"""))
def q_zero_filled_combos(spark, sf):
    b = base(spark, sf)
    return H.zero_filled_combos(b, TG).withColumn("kind", F.lit("observed")).unionByName(
        H.zero_filled_combos(b, TG, _LEVELS).withColumn("kind", F.lit("levels")))


@query("children_per_parent", sql(BASE_CTE, body="""
WITH c AS (SELECT subcategory, count(DISTINCT assignment_group) AS n_children FROM base GROUP BY subcategory)
SELECT 'n_children' AS column_name, count(n_children) AS count, round(avg(n_children), 9) AS mean,
       round(stddev_samp(n_children), 9) AS std, min(n_children)::DOUBLE AS min,
       round(quantile_cont(n_children, 0.25), 9) AS p25, round(quantile_cont(n_children, 0.5), 9) AS p50,
       round(quantile_cont(n_children, 0.75), 9) AS p75, max(n_children)::DOUBLE AS max FROM c"""))
def q_children_per_parent(spark, sf):
    d = H.children_per_parent_describe(base(spark, sf), "subcategory", "assignment_group")
    return d.select(*[F.round(c, 9).alias(c) if c in ("mean", "std", "p25", "p50", "p75") else F.col(c) for c in d.columns])


@query("conditional_stats", sql(BASE_CTE, body="""
SELECT count(DISTINCT category) AS n_parents, count(DISTINCT subcategory) AS n_children,
  round((SELECT avg(k) FROM (SELECT count(DISTINCT subcategory) AS k FROM base GROUP BY category)), 9) AS mean_children_per_parent
FROM base"""))
def q_conditional_stats(spark, sf):
    d = H.conditional_stats(base(spark, sf), "category", "subcategory")
    return d.withColumn("mean_children_per_parent", F.round("mean_children_per_parent", 9))


@query("top_pairs", sql(BASE_CTE, body="""
SELECT subcategory, assignment_group, count(*) AS n FROM base GROUP BY ALL
ORDER BY n DESC, subcategory, assignment_group LIMIT 5"""))
def q_top_pairs(spark, sf):
    return H.top_pairs(base(spark, sf), "subcategory", "assignment_group")


@query("combo_counts", sql(BASE_CTE, body="""
SELECT category, subcategory, assignment_group, count(*) AS n,
       round_even(count(*) / (SELECT count(*) FROM base) * 100, 4)::DOUBLE AS percentage
FROM base GROUP BY ALL"""))
def q_combo_counts(spark, sf):
    return H.combo_counts(base(spark, sf))


@query("combo_threshold_report", sql(BASE_CTE, body="""
WITH c AS (SELECT count(*) AS n, round_even(count(*) / (SELECT count(*) FROM base) * 100, 4)::DOUBLE AS pct
           FROM base GROUP BY category, subcategory, assignment_group),
t AS (SELECT * FROM (VALUES ('percentage', 0.01), ('percentage', 0.05), ('percentage', 0.1), ('percentage', 0.5),
                            ('count', 5.0), ('count', 10.0), ('count', 20.0), ('count', 50.0)) v(kind, threshold))
SELECT t.kind, t.threshold::DOUBLE AS threshold,
  count(*) FILTER (WHERE (t.kind = 'percentage' AND c.pct < t.threshold) OR (t.kind = 'count' AND c.n < t.threshold))::BIGINT AS combos_below,
  count(*) FILTER (WHERE (t.kind = 'percentage' AND c.pct < t.threshold) OR (t.kind = 'count' AND c.n < t.threshold))
     / (SELECT count(*) FROM c) * 100.0 AS combos_pct,
  coalesce(sum(c.n) FILTER (WHERE (t.kind = 'percentage' AND c.pct < t.threshold) OR (t.kind = 'count' AND c.n < t.threshold)), 0)::BIGINT AS rows_affected,
  coalesce(sum(c.n) FILTER (WHERE (t.kind = 'percentage' AND c.pct < t.threshold) OR (t.kind = 'count' AND c.n < t.threshold)), 0)
     / (SELECT sum(n) FROM c) * 100.0 AS rows_pct
FROM t CROSS JOIN c GROUP BY t.kind, t.threshold"""))
def q_combo_threshold_report(spark, sf):
    return H.combo_threshold_report(base(spark, sf))


@query("top_bottom_combos", sql(BASE_CTE, body="""
WITH c AS (SELECT category, subcategory, assignment_group, count(*) AS n FROM base GROUP BY ALL)
(SELECT *, 'top' AS "end" FROM c ORDER BY n DESC, category, subcategory, assignment_group LIMIT 10)
UNION ALL
(SELECT *, 'bottom' AS "end" FROM c ORDER BY n ASC, category DESC, subcategory DESC, assignment_group DESC LIMIT 10)"""))
def q_top_bottom_combos(spark, sf):
    return H.top_bottom_combos(base(spark, sf))


@query("filter_rare_combos", sql(BASE_CTE, body="""
SELECT number_fld, category, subcategory, assignment_group FROM base
WHERE (category, subcategory, assignment_group) IN (
  SELECT (category, subcategory, assignment_group) FROM base GROUP BY ALL HAVING count(*) >= 5)"""))
def q_filter_rare_combos(spark, sf):
    return H.filter_rare_combos(base(spark, sf)).select("number_fld", *TG)


@query("semi_join_combos", sql(BASE_CTE, body="""
SELECT b.number_fld, b.category, b.subcategory FROM base b
WHERE EXISTS (SELECT 1 FROM tickets t WHERE t.contact_type IS NOT NULL AND t.category = b.category
              AND t.subcategory = b.subcategory GROUP BY t.category, t.subcategory HAVING count(*) >= 20)"""))
def q_semi_join_combos(spark, sf):
    # valid (category, subcategory) pairs: those with >= 20 tickets that name a contact type
    from tixprep.queries.common import tk
    t = tk(spark, sf).filter(F.col("contact_type").isNotNull())
    valid = t.groupBy("category", "subcategory").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 20)
    return H.semi_join_combos(base(spark, sf), valid, ["category", "subcategory"]).select("number_fld", "category", "subcategory")


@query("distinct_labels", sql(BASE_CTE, body="SELECT DISTINCT category, subcategory, assignment_group FROM base"))
def q_distinct_labels(spark, sf):
    return H.distinct_labels(base(spark, sf))


# --- all combinations of the levels, the unseen ones included -------------------------------------

_FULL = """full_ AS (SELECT category, subcategory, assignment_group, coalesce(n, 0)::BIGINT AS n
  FROM (SELECT DISTINCT category FROM base) CROSS JOIN (SELECT DISTINCT subcategory FROM base) CROSS JOIN (SELECT DISTINCT assignment_group FROM base)
  LEFT JOIN (SELECT category, subcategory, assignment_group, count(*) AS n FROM base GROUP BY ALL) USING (category, subcategory, assignment_group))"""


@query("full_combos", sql(BASE_CTE, _FULL, body="SELECT * FROM full_"))
def q_full_combos(spark, sf):
    return PR.full_combos(base(spark, sf))


@query("full_threshold_report", sql(BASE_CTE, _FULL, body="""
WITH c AS (SELECT n, round_even(n / (SELECT count(*) FROM base) * 100, 4)::DOUBLE AS pct FROM full_),
t AS (SELECT * FROM (VALUES ('percentage', 0.01), ('percentage', 0.05), ('percentage', 0.1), ('percentage', 0.5),
                            ('count', 5.0), ('count', 10.0), ('count', 20.0), ('count', 50.0)) v(kind, threshold)),
x AS (SELECT t.kind, t.threshold, c.n, (t.kind = 'percentage' AND c.pct < t.threshold) OR (t.kind = 'count' AND c.n < t.threshold) AS below FROM t CROSS JOIN c)
SELECT kind, threshold::DOUBLE AS threshold, count(*)::BIGINT AS combos, count(*) FILTER (WHERE below)::BIGINT AS combos_below,
  round(count(*) FILTER (WHERE below) * 100.0 / count(*), 9) AS combos_pct, coalesce(sum(n) FILTER (WHERE below), 0)::BIGINT AS rows_affected,
  round(coalesce(sum(n) FILTER (WHERE below), 0) * 100.0 / (SELECT count(*) FROM base), 9) AS rows_pct
FROM x GROUP BY kind, threshold"""))
def q_full_threshold_report(spark, sf):
    d = PR.full_threshold_report(base(spark, sf))
    return d.select(*[F.round(c, 9).alias(c) if c.endswith("_pct") else F.col(c) for c in d.columns])


@query("full_top_bottom", sql(BASE_CTE, _FULL, body="""
(SELECT *, 'top' AS "end" FROM full_ ORDER BY n DESC, category, subcategory, assignment_group LIMIT 10)
UNION ALL
(SELECT *, 'bottom' AS "end" FROM full_ ORDER BY n ASC, category DESC, subcategory DESC, assignment_group DESC LIMIT 10)"""))
def q_full_top_bottom(spark, sf):
    return PR.full_top_bottom(base(spark, sf))


_UNSEEN = """(SELECT *, 'last' AS side FROM full_ WHERE n = 0 ORDER BY category DESC, subcategory DESC, assignment_group DESC LIMIT 25)
UNION ALL (SELECT *, 'first' AS side FROM full_ WHERE n = 0 ORDER BY category, subcategory, assignment_group LIMIT 25)"""


@query("unseen_combos", sql(BASE_CTE, _FULL, body=_UNSEEN))
def q_unseen_combos(spark, sf):
    b = labels(spark, sf)
    return PR.unseen_combos(b, k=25).withColumn("side", F.lit("last")).unionByName(PR.unseen_combos(b, k=25, last=False).withColumn("side", F.lit("first")))


# --- the hierarchy report's relations: both levels ------------------------------------------------

_RELATIONS = [("category", "subcategory"), ("subcategory", "assignment_group")]


def _both(one):
    """The rows of both relations, each marked with it."""
    out = None
    for parent, child in _RELATIONS:
        part = one(parent, child).withColumn("relation", F.lit(f"{parent}-{child}"))
        out = part if out is None else out.unionByName(part)
    return out


def _both_sql(one: str) -> str:
    return " UNION ALL ".join("(" + one.format(p=p, c=c, r=f"{p}-{c}") + ")" for p, c in _RELATIONS)


@query("hierarchy_contingency", sql(BASE_CTE, body=_both_sql("SELECT {p} AS parent, {c} AS child, count(*) AS n, '{r}' AS relation FROM base GROUP BY {p}, {c}")))
def q_hierarchy_contingency(spark, sf):
    b = base(spark, sf)
    return _both(lambda p, c: H.contingency_table(b, p, c).select(F.col(p).alias("parent"), F.col(c).alias("child"), "n"))


@query("hierarchy_children", sql(BASE_CTE, body=_both_sql("""
SELECT '{r}' AS relation, count(k) AS count, round(avg(k), 9) AS mean, round(stddev_samp(k), 9) AS std, min(k)::DOUBLE AS min,
       round(quantile_cont(k, 0.25), 9) AS p25, round(quantile_cont(k, 0.5), 9) AS p50, round(quantile_cont(k, 0.75), 9) AS p75, max(k)::DOUBLE AS max
FROM (SELECT count(DISTINCT {c}) AS k FROM base GROUP BY {p})""")))
def q_hierarchy_children(spark, sf):
    b = base(spark, sf)
    d = _both(lambda p, c: H.children_per_parent_describe(b, p, c)).drop("column_name")
    return d.select(*[F.round(c, 9).alias(c) if c in ("mean", "std", "p25", "p50", "p75") else F.col(c) for c in d.columns])


@query("hierarchy_conditional", sql(BASE_CTE, body=_both_sql("""
SELECT '{r}' AS relation, count(DISTINCT {p}) AS n_parents, count(DISTINCT {c}) AS n_children,
  round((SELECT avg(k) FROM (SELECT count(DISTINCT {c}) AS k FROM base GROUP BY {p})), 9) AS mean_children_per_parent FROM base""")))
def q_hierarchy_conditional(spark, sf):
    b = base(spark, sf)
    return _both(lambda p, c: H.conditional_stats(b, p, c)).withColumn("mean_children_per_parent", F.round("mean_children_per_parent", 9))


@query("hierarchy_top_pairs", sql(BASE_CTE, body=_both_sql(
    "SELECT '{r}' AS relation, {p} AS parent, {c} AS child, count(*) AS n FROM base GROUP BY {p}, {c} ORDER BY n DESC, {p}, {c} LIMIT 5")))
def q_hierarchy_top_pairs(spark, sf):
    b = base(spark, sf)
    return _both(lambda p, c: H.top_pairs(b, p, c).select(F.col(p).alias("parent"), F.col(c).alias("child"), "n"))
