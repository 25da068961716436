"""§2.1 scans/sinks and §2.2 projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.functions.text import char_length_nan, clean_basic
from tixprep.oracle import d_clean_basic, d_clean_profile
from tixprep.operators import fields as FL
from tixprep.queries import query
from tixprep.queries.common import BASE_CTE, base, sql, tk
from tixprep.sources import io as IO

ALL = ("number_fld, short_description, description, category, subcategory, assignment_group, priority, "
       "contact_type, location, u_department, opened_by_department, date_opened, total_price, value")


@query("scan_tickets", sql(body=f"SELECT {ALL} FROM tickets"))
def q_scan_tickets(spark, sf):
    path = IO.scratch_path(spark, "tickets")
    tk(spark, sf).write.parquet(path)
    return IO.scan_tickets(spark, path)


@query("scan_typed", sql(body=f"SELECT {ALL} FROM tickets"))
def q_scan_typed(spark, sf):
    return IO.scan_typed(tk(spark, sf))


@query("scan_guarded", "SELECT doc_id, lang, n_chars FROM documents")
def q_scan_guarded(spark, sf):
    d = IO.scan_guarded(spark, f"{sf}/documents.parquet")
    missing = IO.scan_guarded(spark, f"{sf}/no_such_table.parquet", d.schema)
    return d.unionByName(missing).select("doc_id", "lang", "n_chars")


@query("sink_csv", sql(body=f"SELECT {ALL} FROM tickets"))
def q_sink_csv(spark, sf):
    return IO.sink_csv_roundtrip(tk(spark, sf), S.TICKET_SCHEMA)


@query("drop_if_present", sql(body="SELECT number_fld, category, total_price FROM tickets"))
def q_drop_if_present(spark, sf):
    d = tk(spark, sf).select("number_fld", "category", "total_price", "value")
    return FL.drop_if_present(d, "value", "resolved_by")


@query("has_column_guard", sql(body="""
SELECT 'category' AS column_name, category AS value, count(*) AS n FROM tickets WHERE category IS NOT NULL GROUP BY category
UNION ALL
SELECT 'subcategory', subcategory, count(*) FROM tickets WHERE subcategory IS NOT NULL GROUP BY subcategory"""))
def q_has_column_guard(spark, sf):
    from tixprep.operators.classes import class_counts
    d = tk(spark, sf)
    out = None
    for c in ["category", "subcategory", "u_submitted_by"]:
        if not FL.has_columns(d, c):  # plan-time guard: absent column -> step skipped
            continue
        part = class_counts(d, c).select(F.lit(c).alias("column_name"), F.col(c).alias("value"), "n")
        out = part if out is None else out.unionByName(part)
    return out


_MAIN_FILL = """coalesce(priority, 'UnknownPriority') AS priority, coalesce(contact_type, 'OtherContact') AS contact_type,
  coalesce(location, 'UnknownLocation') AS location, coalesce(u_department, 'UnknownDepartment') AS u_department,
  coalesce(opened_by_department, 'UnknownDepartment') AS opened_by_department"""


@query("fill_defaults", sql(body=f"""
SELECT number_fld, coalesce(short_description, '') AS short_description, coalesce(description, '') AS description,
  {_MAIN_FILL} FROM tickets"""))
def q_fill_defaults(spark, sf):
    d = FL.fill_defaults(tk(spark, sf), "main")
    return d.select("number_fld", *S.TEXT_FIELDS, *S.META_FIELDS)


@query("fill_nan_strings", sql(body="""
SELECT number_fld,
  CASE WHEN category IS NULL OR category = 'nan' THEN 'Unknown' ELSE category END AS category,
  CASE WHEN assignment_group IS NULL OR assignment_group = 'nan' THEN 'Unknown' ELSE assignment_group END AS assignment_group,
  CASE WHEN priority IS NULL OR priority = 'nan' THEN 'Unknown' ELSE priority END AS priority,
  CASE WHEN location IS NULL OR location = 'nan' THEN 'Unknown Location' ELSE location END AS location,
  CASE WHEN opened_by_department IS NULL OR opened_by_department = 'nan' THEN 'Unknown Department' ELSE opened_by_department END AS opened_by_department
FROM tickets"""))
def q_fill_nan_strings(spark, sf):
    cols = ["category", "assignment_group", "priority", "location", "opened_by_department"]
    return FL.fill_nan_strings(tk(spark, sf), cols).select("number_fld", *cols)


@query("drop_missing_targets", sql(body="""
SELECT number_fld, category, subcategory, assignment_group FROM tickets
WHERE category IS NOT NULL AND subcategory IS NOT NULL AND assignment_group IS NOT NULL"""))
def q_drop_missing_targets(spark, sf):
    return FL.drop_missing_targets(tk(spark, sf)).select("number_fld", *S.TARGETS)


_D_PARSE = ("coalesce(try_strptime(date_opened, '%Y-%m-%d %H:%M:%S'), try_strptime(date_opened, '%Y-%m-%d'), "
            "try_strptime(date_opened, '%m/%d/%Y %H:%M:%S'), try_strptime(date_opened, '%m/%d/%Y'))")


@query("parse_dates_mixed", sql(body=f"SELECT number_fld, date_opened, {_D_PARSE} AS opened_at FROM tickets"))
def q_parse_dates_mixed(spark, sf):
    return tk(spark, sf).select("number_fld", "date_opened",
                                FL.parse_dates_mixed("date_opened").cast("timestamp_ntz").alias("opened_at"))


@query("parse_dates_inferred", sql(body=f"SELECT number_fld, date_opened, {_D_PARSE} AS opened_at FROM tickets"))
def q_parse_dates_inferred(spark, sf):
    """The same dates as with the list of formats, found from the values' shapes."""
    from tixprep.operators.dates import parse_dates_inferred
    return parse_dates_inferred(tk(spark, sf).select("number_fld", "date_opened"), "date_opened", "opened_at")


@query("date_report", sql(body=f"""
SELECT regexp_replace(regexp_replace(trim(date_opened), '[0-9]', '9', 'g'), '\\p{{L}}+', 'A', 'g') AS shape, count(*) AS n,
       count(*) FILTER (WHERE {_D_PARSE} IS NOT NULL) AS parsed, round(1 - count(*) FILTER (WHERE {_D_PARSE} IS NOT NULL) / count(*), 9) AS failed_share
FROM tickets WHERE date_opened IS NOT NULL GROUP BY 1"""))
def q_date_report(spark, sf):
    from tixprep.operators.dates import date_report
    return date_report(tk(spark, sf), "date_opened").withColumn("failed_share", F.round("failed_share", 9))


@query("date_to_string", sql(body=f"""
SELECT number_fld, coalesce(strftime({_D_PARSE}, '%Y-%m-%d %H:%M:%S'), 'NaT') AS opened_text FROM tickets"""))
def q_date_to_string(spark, sf):
    return tk(spark, sf).select("number_fld", FL.date_to_string(FL.parse_dates_mixed("date_opened")).alias("opened_text"))


@query("select_numeric", sql(body="SELECT number_fld, total_price, value FROM tickets"))
def q_select_numeric(spark, sf):
    d = tk(spark, sf)
    return d.select(*FL.select_numeric(d))


@query("select_categorical", sql(body="""
SELECT short_description, description, category, subcategory, assignment_group, priority, contact_type, location,
       u_department, opened_by_department, date_opened FROM tickets"""))
def q_select_categorical(spark, sf):
    d = tk(spark, sf)
    return d.select(*FL.select_categorical(d))


@query("project_processed", sql(body=f"""
SELECT number_fld, {d_clean_profile('short_description')} AS processed_short_description,
       {d_clean_profile('description')} AS processed_description FROM tickets"""))
def q_project_processed(spark, sf):
    d = FL.project_processed(tk(spark, sf), S.TEXT_FIELDS, "profile")
    return d.select("number_fld", "processed_short_description", "processed_description")


@query("snake_length_name", sql(body="""
SELECT number_fld, length(coalesce(short_description, 'nan'))::INTEGER AS short_description_length,
       length(coalesce(description, 'nan'))::INTEGER AS description_length FROM tickets"""))
def q_snake_length_name(spark, sf):
    d = tk(spark, sf)
    return d.select("number_fld", *[char_length_nan(c).alias(FL.snake_length_name(c)) for c in ["short_description", "description"]])


_COMB7 = ("concat_ws(' [SEP] ', short_description, description, coalesce(priority, 'UnknownPriority'), "
          "coalesce(contact_type, 'OtherContact'), coalesce(location, 'UnknownLocation'), "
          "coalesce(u_department, 'UnknownDepartment'), coalesce(opened_by_department, 'UnknownDepartment'))")


@query("combine_text7", sql(BASE_CTE, body=f"SELECT number_fld, {_COMB7} AS combined_text FROM base"))
def q_combine_text7(spark, sf):
    return FL.combine_text7(FL.fill_defaults(base(spark, sf), "main")).select("number_fld", "combined_text")


@query("combine_text2", sql(BASE_CTE, body="""
SELECT number_fld, concat_ws(' [SEP] ', short_description, description) AS combined_text FROM base"""))
def q_combine_text2(spark, sf):
    return FL.combine_text2(base(spark, sf)).select("number_fld", "combined_text")


_CLEAN7 = ", ".join(d_clean_basic(c) for c in S.COMBINED_FIELDS)


@query("combine_text7_clean", sql(body=f"SELECT number_fld, concat_ws(' [SEP] ', {_CLEAN7}) AS combined_text FROM tickets"))
def q_combine_text7_clean(spark, sf):
    return FL.combine_text7_clean(tk(spark, sf)).select("number_fld", "combined_text")


@query("filter_lookup", sql(body=f"SELECT {ALL} FROM tickets WHERE number_fld = 42 ORDER BY number_fld LIMIT 1"))
def q_filter_lookup(spark, sf):
    return FL.filter_lookup(tk(spark, sf), 42)


@query("threshold_filter", sql(BASE_CTE, body="""
SELECT category, subcategory, assignment_group, count(*) AS n FROM base
GROUP BY category, subcategory, assignment_group HAVING count(*) < 10"""))
def q_threshold_filter(spark, sf):
    from tixprep.operators.classes import triple_counts
    return FL.threshold_filter(triple_counts(base(spark, sf)), "n", 10, "<")


_ = clean_basic, d_clean_basic
