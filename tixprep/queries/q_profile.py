"""§2.4 profile aggregates and §2.6 head/tail."""

from __future__ import annotations

from pyspark.sql import functions as F

from tixprep.functions.text import char_length_nan, clean_profile
from tixprep.oracle import d_clean_profile, d_words
from tixprep.operators import profile as P
from tixprep.queries import query
from tixprep.queries.common import sql, tk
from tixprep.session import cut_lineage
from tixprep.sources.tables import read_table, tickets

ALL = ["number_fld", "short_description", "description", "category", "subcategory", "assignment_group", "priority",
       "contact_type", "location", "u_department", "opened_by_department", "date_opened", "total_price", "value"]
TYPES = {"number_fld": "bigint", "total_price": "double", "value": "double"}


def _r(df, cols, d=9):
    return df.select(*[F.round(c, d).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("shape", sql(body="SELECT count(*) AS n_rows, 14 AS n_columns FROM tickets"))
def q_shape(spark, sf):
    return P.shape(tk(spark, sf))


_SCHEMA_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{TYPES.get(c, 'string')}' AS data_type, count({c}) AS non_null FROM tickets"
    for i, c in enumerate(ALL))


@query("schema_info", sql(body=_SCHEMA_ROWS))
def q_schema_info(spark, sf):
    return P.schema_info(tk(spark, sf))


_BYTES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, " + (f"coalesce(sum(strlen({c})), 0)::BIGINT" if TYPES.get(c, "string") == "string"
                                        else f"(count({c}) * 8)::BIGINT") + " AS bytes FROM tickets" for c in ALL)


@query("column_bytes", sql(body=f"""
WITH b AS ({_BYTES}) SELECT column_name, bytes, sum(bytes) OVER () / (1024.0 * 1024.0) AS total_mb FROM b"""))
def q_column_bytes(spark, sf):
    return P.column_bytes(tk(spark, sf))


_MISS = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, "
                           f"(count(*) - count({c})) / count(*) * 100.0 AS percent FROM tickets" for c in ALL)


@query("missing_summary", sql(body=f"SELECT * FROM ({_MISS}) ORDER BY missing DESC, column_name"))
def q_missing_summary(spark, sf):
    return P.missing_summary(tk(spark, sf))


_CAT = ["category", "subcategory", "assignment_group", "priority", "location", "opened_by_department", "u_department"]


@query("unique_count", sql(body=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM tickets" for c in _CAT)))
def q_unique_count(spark, sf):
    return P.unique_count(tk(spark, sf), _CAT)


@query("unique_count_with_null", sql(body=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (count(DISTINCT {c}) + max(({c} IS NULL)::INTEGER))::BIGINT AS n_unique FROM tickets"
    for c in _CAT)))
def q_unique_count_with_null(spark, sf):
    return P.unique_count_with_null(tk(spark, sf), _CAT)


@query("text_exploration", sql(body=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_unique FROM tickets"
    for c in ["description", "short_description"])))
def q_text_exploration(spark, sf):
    return P.text_exploration(tk(spark, sf), ["description", "short_description"])


def _describe_sql(expr: str, name: str, src: str) -> str:
    return (f"SELECT '{name}' AS column_name, count(x) AS count, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS std, "
            f"min(x)::DOUBLE AS min, round(quantile_cont(x, 0.25), 9) AS p25, round(quantile_cont(x, 0.5), 9) AS p50, "
            f"round(quantile_cont(x, 0.75), 9) AS p75, max(x)::DOUBLE AS max FROM (SELECT {expr} AS x FROM {src})")


_DESC_COLS = ["mean", "std", "p25", "p50", "p75"]


@query("describe_numeric", sql(body=" UNION ALL ".join(_describe_sql(c, c, "tickets") for c in ["number_fld", "total_price", "value"])))
def q_describe_numeric(spark, sf):
    d = P.describe_numeric(tk(spark, sf))
    return _r(d, _DESC_COLS + ["min", "max"])


@query("text_length_stats", sql(body=" UNION ALL ".join(
    _describe_sql(f"length(coalesce({c}, 'nan'))", c, "tickets") for c in ["short_description", "description"])))
def q_text_length_stats(spark, sf):
    return _r(P.text_length_stats(tk(spark, sf), ["short_description", "description"]), _DESC_COLS)


_PROC = f"""proc AS (SELECT number_fld, {d_clean_profile('short_description')} AS processed_short_description,
  {d_clean_profile('description')} AS processed_description FROM tickets)"""


def _proc(spark, sf):
    return tk(spark, sf).select("number_fld", clean_profile("short_description").alias("processed_short_description"),
                                clean_profile("description").alias("processed_description"))


_LENGTH_COLS = ["short_description_length", "description_length"]


def _processed_lengths(short, desc):
    return [F.length(clean_profile(c)).alias(name) for c, name in zip((short, desc), _LENGTH_COLS, strict=True)]


@query("processed_length_stats", sql(_PROC, body=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg(length({c})), 9) AS mean_chars, max(length({c}))::INTEGER AS max_chars FROM proc"
    for c in ["processed_short_description", "processed_description"])))
def q_processed_length_stats(spark, sf):
    d = P.processed_length_stats(_proc(spark, sf), ["processed_short_description", "processed_description"])
    return d.select("column_name", F.round("mean_chars", 9).alias("mean_chars"), "max_chars")


_PROC_COLS = ["processed_short_description", "processed_description"]


@query("token_length_stats", sql(_PROC, body=" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, round(avg(n), 9) AS mean_tokens, max(n)::INTEGER AS max_tokens,
       round(quantile_cont(n, 0.95), 9) AS p95_tokens FROM (SELECT len({d_words(c)})::INTEGER AS n FROM proc)""" for c in _PROC_COLS)))
def q_token_length_stats(spark, sf):
    return _r(P.token_length_stats(_proc(spark, sf), _PROC_COLS), ["mean_tokens", "p95_tokens"])


@query("word_frequency", sql(_PROC, body=" UNION ALL ".join(f"""
(SELECT '{c}' AS column_name, word, count(*) AS n FROM (SELECT unnest({d_words(c)}) AS word FROM proc)
GROUP BY word ORDER BY n DESC, word LIMIT 10)""" for c in _PROC_COLS)))
def q_word_frequency(spark, sf):
    return P.word_frequency(_proc(spark, sf), _PROC_COLS)


@query("duplicate_rows", """
SELECT 'documents' AS table_name, (count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)))::BIGINT
       AS duplicate_rows FROM documents
UNION ALL
SELECT 'conversations', (count(*) - (SELECT count(*) FROM (SELECT DISTINCT role, text FROM conversations)))::BIGINT
FROM conversations""")
def q_duplicate_rows(spark, sf):
    a = P.duplicate_rows(read_table(spark, sf, "documents").select("text", "lang")).select(F.lit("documents").alias("table_name"), "duplicate_rows")
    b = P.duplicate_rows(read_table(spark, sf, "conversations").select("role", "text")).select(F.lit("conversations").alias("table_name"), "duplicate_rows")
    return a.unionByName(b)


_NUMS = ["total_price", "value", "short_description_length", "description_length"]
_LEN_CTE = """lens AS (SELECT total_price, value, length(coalesce(short_description, 'nan')) AS short_description_length,
  length(coalesce(description, 'nan')) AS description_length FROM tickets)"""


def _lens(spark, sf):
    return tk(spark, sf).select("total_price", "value", char_length_nan("short_description").alias("short_description_length"),
                                char_length_nan("description").alias("description_length"))


def _corr_sql(a, b):
    x = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a}::DOUBLE END"
    y = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b}::DOUBLE END"
    den = f"(stddev_samp({x}) * stddev_samp({y}))"
    return (f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(CASE WHEN {den} = 0 THEN NULL "
            f"ELSE covar_samp({x}, {y}) / {den} END, 9) AS r FROM lens")


@query("correlation_matrix", sql(_LEN_CTE, body=" UNION ALL ".join(_corr_sql(a, b) for a in _NUMS for b in _NUMS)))
def q_correlation_matrix(spark, sf):
    return P.correlation_matrix(_lens(spark, sf), _NUMS).withColumn("r", F.round("r", 9))


def _histogram_sql(col: str) -> str:
    return f"""SELECT '{col}' AS column_name, g.bin, round(lo + (hi - lo) / 50 * g.bin, 9) AS lower, round(lo + (hi - lo) / 50 * (g.bin + 1), 9) AS upper,
       coalesce(b.n, 0)::BIGINT AS n
FROM (SELECT unnest(range(0, 50))::INTEGER AS bin) g
CROSS JOIN (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo, CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
            FROM (SELECT greatest(0, least(1000, length({col})))::DOUBLE AS v FROM tickets WHERE {col} IS NOT NULL)) r
LEFT JOIN (SELECT least(49, floor((v - lo) / (hi - lo) * 50))::INTEGER AS bin, count(*) AS n
           FROM (SELECT greatest(0, least(1000, length({col})))::DOUBLE AS v FROM tickets WHERE {col} IS NOT NULL),
                (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo, CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
                 FROM (SELECT greatest(0, least(1000, length({col})))::DOUBLE AS v FROM tickets WHERE {col} IS NOT NULL)) GROUP BY 1) b ON b.bin = g.bin"""


@query("histogram", sql(body=" UNION ALL ".join(_histogram_sql(c) for c in ("short_description", "description"))))
def q_histogram(spark, sf):
    out = None
    for c in ("short_description", "description"):
        h = P.histogram(tk(spark, sf).select(F.length(c).alias("n_chars")), "n_chars", 50, 0, 1000)
        h = h.select(F.lit(c).alias("column_name"), "bin", F.round("lower", 9).alias("lower"), F.round("upper", 9).alias("upper"), "n")
        out = h if out is None else out.unionByName(h)
    return out


@query("density_curve", """
WITH v AS (SELECT o_totalprice AS v FROM orders),
s AS (SELECT count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, min(v) AS lo, max(v) AS hi FROM v),
g AS (SELECT unnest(range(0, 200)) AS point),
x AS (SELECT g.point, (s.lo - 3 * s.h) + ((s.hi + 3 * s.h) - (s.lo - 3 * s.h)) * g.point / 199 AS x FROM g, s),
vc AS (SELECT v, count(*) AS c FROM v GROUP BY v)
SELECT x.point::INTEGER AS point, round(sum(vc.c * exp(-pow((x.x - vc.v) / s.h, 2) / 2.0)) / (s.n * s.h * sqrt(2 * pi())) * 1e6, 6) AS density_e6
FROM x, vc, s GROUP BY x.point, s.n, s.h""")
def q_density_curve(spark, sf):
    d = P.density_curve(read_table(spark, sf, "orders"), "o_totalprice")
    return d.select(F.col("point").cast("int").alias("point"), F.round(F.col("density") * 1e6, 6).alias("density_e6"))


@query("density_curve_binned", f"""
WITH v AS (SELECT o_totalprice AS v FROM orders),
s AS (SELECT count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, min(v) AS lo, max(v) AS hi FROM v),
k AS (SELECT n, h, lo - 3 * h AS g0, (hi + 3 * h - (lo - 3 * h)) / (199 * {P.NODES_PER_POINT}) AS d FROM s),
b AS (SELECT floor((v - g0) / d) AS node, (v - g0) / d - floor((v - g0) / d) AS part FROM v, k),
w AS (SELECT node, sum(w) AS w FROM (SELECT node, 1 - part AS w FROM b UNION ALL SELECT node + 1, part FROM b) GROUP BY node),
g AS (SELECT unnest(range(0, 200)) AS point)
SELECT g.point::INTEGER AS point, round(sum(w.w * exp(-pow((w.node - g.point * {P.NODES_PER_POINT}) * d / h, 2) / 2.0)) / (n * h * sqrt(2 * pi())) * 1e6, 6) AS density_e6,
       round(d * d / (8 * pow(h, 3) * sqrt(2 * pi())) * 1e12, 6) AS bound_e12 FROM g, w, k GROUP BY g.point, n, h, d""")
def q_density_curve_binned(spark, sf):
    d = P.density_curve_binned(read_table(spark, sf, "orders"), "o_totalprice")
    return d.select(F.col("point").cast("int").alias("point"), F.round(F.col("density") * 1e6, 6).alias("density_e6"), F.round(F.col("error_bound") * 1e12, 6).alias("bound_e12"))


@query("head", sql(body="SELECT number_fld, category, priority FROM tickets ORDER BY number_fld LIMIT 10"))
def q_head(spark, sf):
    return P.head(tk(spark, sf).select("number_fld", "category", "priority"), "number_fld")


@query("tail", sql(body="SELECT number_fld, category, priority FROM tickets ORDER BY number_fld DESC LIMIT 10"))
def q_tail(spark, sf):
    return P.tail(tk(spark, sf).select("number_fld", "category", "priority"), "number_fld")


@query("summary_statistics", sql(_PROC, body="""
SELECT count(*) AS n_rows,
  (SELECT count(DISTINCT category) + max((category IS NULL)::INTEGER) FROM tickets)::BIGINT AS n_categories,
  (SELECT count(DISTINCT subcategory) + max((subcategory IS NULL)::INTEGER) FROM tickets)::BIGINT AS n_subcategories,
  (SELECT count(DISTINCT assignment_group) + max((assignment_group IS NULL)::INTEGER) FROM tickets)::BIGINT AS n_assignment_groups,
  round(avg(length(processed_description)), 9) AS mean_description_length,
  round(avg(length(processed_short_description)), 9) AS mean_short_description_length
FROM proc"""))
def q_summary_statistics(spark, sf):
    # the tickets are derived once, for labels and lengths: texts are cleaned and measured where they lie
    t = cut_lineage(tickets(spark, sf, _processed_lengths).select("category", "subcategory", "assignment_group", *_LENGTH_COLS))
    u = P.unique_count_with_null(t, ["category", "subcategory", "assignment_group"])
    n = {c: u.filter(F.col("column_name") == c).select("n_unique").scalar() for c in ["category", "subcategory", "assignment_group"]}
    return t.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.round(F.avg("description_length"), 9).alias("mean_description_length"),
                 F.round(F.avg("short_description_length"), 9).alias("mean_short_description_length")) \
        .select("n_rows", n["category"].alias("n_categories"), n["subcategory"].alias("n_subcategories"),
                n["assignment_group"].alias("n_assignment_groups"), "mean_description_length", "mean_short_description_length")


# --- wide correlations, profiles kept up to date ---------------------------------------------------

_EMB = "emb AS (SELECT " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS e{i}" for i in range(64)) + " FROM embeddings)"


@query("wide_correlation", f"""WITH {_EMB}, u AS (UNPIVOT (SELECT row_number() OVER () AS r, * FROM emb) ON COLUMNS('e[0-9]+') INTO NAME c VALUE v)
SELECT a.c AS column_a, b.c AS column_b, round(corr(a.v, b.v), 6) AS r FROM u a JOIN u b ON a.r = b.r GROUP BY a.c, b.c""")
def q_wide_correlation(spark, sf):
    """All pairs of the 64 components of the embeddings."""
    from tixprep.operators.wide import wide_correlation
    e = read_table(spark, sf, "embeddings")
    wide = e.select(*[F.try_element_at("embedding", F.lit(i + 1)).cast("double").alias(f"e{i}") for i in range(64)])
    return wide_correlation(wide, wide.columns).withColumn("r", F.round("r", 6))


_PARTS_SQL = """SELECT '{c}' AS column_name, count({c})::BIGINT AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max,
  TRUE AS quantiles_close, TRUE AS distinct_close FROM orders"""


@query("sketched_profile", " UNION ALL ".join(_PARTS_SQL.format(c=c) for c in ("o_orderkey", "o_custkey", "o_totalprice")))
def q_sketched_profile(spark, sf):
    """Orders in five parts, each sketched on its own; the merged profile is held against the exact operators: quartiles
    within 2 % of the ranks, distinct counts within 3 %."""
    from tixprep.operators import sketches as K
    from tixprep.sources.io import scratch_path
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    orders = read_table(spark, sf, "orders").select(*cols)
    folder = scratch_path(spark, "sketches")
    for k in range(5):
        K.add_part(orders.filter(F.pmod("o_custkey", F.lit(5)) == k), folder, str(k))
    got = K.profile(spark, folder)
    ranks = orders.join(F.broadcast(got.select("column_name", "q0", "q1", "q2")), F.lit(True)).groupBy("column_name").agg(*[  # three rows beside every order
        F.avg((F.when(F.col("column_name") == cols[0], F.col(cols[0])).when(F.col("column_name") == cols[1], F.col(cols[1])).otherwise(F.col(cols[2])) <= F.col(f"q{i}")).cast("double")).alias(f"r{i}") for i in range(3)])
    exact = P.unique_count(orders, cols)
    close = F.lit(True)
    for i, q in enumerate((0.25, 0.5, 0.75)):
        close = close & (F.abs(F.col(f"r{i}") - q) < 0.02)
    return got.join(ranks, "column_name").join(exact, "column_name").select(
        "column_name", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max", close.alias("quantiles_close"),
        (F.abs(F.col("distinct") - F.col("n_unique")) <= 0.03 * F.col("n_unique")).alias("distinct_close"))
