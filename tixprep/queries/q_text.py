"""§2.8 string, array and math scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tixprep.functions import math as M
from tixprep.functions import text as TX
from tixprep.oracle import (D_EMAIL_LOOSE, D_EMAIL_STRICT, D_URL, d_clean_basic, d_clean_profile,
                            d_clean_strict, d_normalize, d_words, rr)
from tixprep.queries import query
from tixprep.queries.common import BASE_CTE, base, docs, sql
from tixprep.sources.tables import read_table


@query("clean_basic", f"SELECT doc_id, {d_clean_basic('text')} AS clean FROM documents")
def q_clean_basic(spark, sf):
    return docs(spark, sf).select("doc_id", TX.clean_basic("text").alias("clean"))


@query("clean_profile", f"SELECT doc_id, {d_clean_profile('text')} AS clean FROM documents")
def q_clean_profile(spark, sf):
    return docs(spark, sf).select("doc_id", TX.clean_profile("text").alias("clean"))


@query("clean_strict", f"SELECT doc_id, {d_clean_strict('text')} AS clean FROM documents")
def q_clean_strict(spark, sf):
    return docs(spark, sf).select("doc_id", TX.clean_strict("text").alias("clean"))


@query("mask_email", f"SELECT doc_id, {rr('text', D_EMAIL_LOOSE, 'EMAIL')} AS loose, "
                     f"{rr('text', D_EMAIL_STRICT, 'EMAIL')} AS strict FROM documents")
def q_mask_email(spark, sf):
    return docs(spark, sf).select("doc_id", TX.mask_email("text").alias("loose"),
                                  TX.mask_email("text", strict=True).alias("strict"))


@query("mask_url", f"SELECT doc_id, {rr('text', D_URL, 'URL')} AS masked FROM documents")
def q_mask_url(spark, sf):
    return docs(spark, sf).select("doc_id", TX.mask_url("text").alias("masked"))


@query("mask_digits", f"SELECT doc_id, {rr('text', chr(92) + 'p{Nd}+', '[NUM]')} AS masked FROM documents")
def q_mask_digits(spark, sf):
    return docs(spark, sf).select("doc_id", TX.mask_digits("text").alias("masked"))


@query("normalize_space", f"SELECT page_id, {d_normalize('html')} AS normalized FROM pages")
def q_normalize_space(spark, sf):
    return read_table(spark, sf, "pages").select("page_id", TX.normalize_space("html").alias("normalized"))


@query("tokenize_words", f"SELECT doc_id, len({d_words('text')})::INTEGER AS n_words, "
                         f"array_to_string({d_words('text')}, ' ') AS words FROM documents")
def q_tokenize_words(spark, sf):
    w = TX.tokenize_words("text")
    return docs(spark, sf).select("doc_id", F.size(w).alias("n_words"), F.array_join(w, " ").alias("words"))


_COMB = "concat_ws(' [SEP] ', short_description, description, coalesce(priority, 'UnknownPriority'), " \
        "coalesce(contact_type, 'OtherContact'), coalesce(location, 'UnknownLocation'), " \
        "coalesce(u_department, 'UnknownDepartment'), coalesce(opened_by_department, 'UnknownDepartment'))"


@query("split_fields", sql(BASE_CTE, body=f"""
SELECT number_fld, len(string_split({_COMB}, ' [SEP] '))::INTEGER AS n_fields,
       string_split({_COMB}, ' [SEP] ')[2] AS field_1,
       string_split({_COMB}, ' [SEP] ')[7] AS field_6
FROM base"""))
def q_split_fields(spark, sf):
    from tixprep.operators.fields import combine_text7, fill_defaults
    d = combine_text7(fill_defaults(base(spark, sf), "main"))
    parts = TX.split_fields("combined_text")
    return d.select("number_fld", F.size(parts).cast("int").alias("n_fields"),
                    F.element_at(parts, 2).alias("field_1"), F.element_at(parts, 7).alias("field_6"))


@query("join_words", f"SELECT doc_id, array_to_string(list_reverse({d_words('text')}), ' ') AS joined FROM documents")
def q_join_words(spark, sf):
    return docs(spark, sf).select("doc_id", TX.join_words(F.reverse(TX.tokenize_words("text"))).alias("joined"))


@query("alpha_candidates", f"""
SELECT doc_id, len(list_filter(w, lambda x: regexp_full_match(x, '\\p{{L}}+') AND length(x) > 3))::INTEGER AS n_candidates
FROM (SELECT doc_id, {d_words('text')} AS w FROM documents)""")
def q_alpha_candidates(spark, sf):
    return docs(spark, sf).select("doc_id", F.size(TX.alpha_candidates(TX.tokenize_words("text"))).cast("int")
                                  .alias("n_candidates"))


@query("prefix_strip_keys", "SELECT doc_id AS id, text AS body, lang AS language FROM documents")
def q_prefix_strip_keys(spark, sf):
    from tixprep.operators.udf import prefix_strip_keys
    d = docs(spark, sf).select(F.col("doc_id").alias("module.id"), F.col("text").alias("module.body"),
                               F.col("lang").alias("module.language"))
    return prefix_strip_keys(d, "module.")


@query("math_weight", """
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
m AS (SELECT max(n) AS mx FROM c)
SELECT lang, n, sqrt(1.0 / n) / sqrt(1.0 / mx) AS level_weight,
       least(10.0, greatest(1.0, pow(sqrt(1.0 / n) / sqrt(1.0 / mx), 1.0 / 3.0))) AS clipped_root
FROM c, m""")
def q_math_weight(spark, sf):
    from tixprep.operators.classes import class_counts, over_all
    c = class_counts(docs(spark, sf), "lang")
    c = c.withColumn("level_weight", M.level_weight("n", over_all(F.min(M.level_weight("n")))))
    return c.withColumn("clipped_root", M.geometric_clip("level_weight", F.lit(1.0), F.lit(1.0)))


@query("percent_round", """
SELECT source, count(*) AS n, round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 2) AS percentage
FROM documents GROUP BY source""")
def q_percent_round(spark, sf):
    from tixprep.operators.classes import class_counts
    d = docs(spark, sf)
    total = d.select(F.count(F.lit(1))).scalar()
    return class_counts(d, "source").select("source", "n", M.percent_round("n", total).alias("percentage"))


@query("arg_max", """
SELECT vec_id, list_position(embedding, list_max(embedding))::INTEGER - 1 AS arg_max FROM embeddings""")
def q_arg_max(spark, sf):
    return read_table(spark, sf, "embeddings").select("vec_id", M.arg_max("embedding").alias("arg_max"))


@query("clip", sql(BASE_CTE, body="""
SELECT number_fld, CASE WHEN length(description) IS NULL THEN NULL
       ELSE greatest(0, least(1000, length(description))) END::INTEGER AS description_length_clipped
FROM base"""))
def q_clip(spark, sf):
    return base(spark, sf).select("number_fld", M.clip(F.length("description"), 0, 1000).cast("int")
                                  .alias("description_length_clipped"))
