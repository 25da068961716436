"""Shared inputs of the registered queries and the matching SQL CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tixprep import schema as S
from tixprep.oracle import TICKETS_CTE, d_clean_basic
from tixprep.plans.prepare import base_rows
from tixprep.session import cut_lineage
from tixprep.sources.tables import read_table, tickets


def tk(spark: SparkSession, sf: str) -> DataFrame:
    return tickets(spark, sf)


def base(spark: SparkSession, sf: str) -> DataFrame:
    """Tickets with the two text fields filled and cleaned, rows without targets dropped."""
    return base_rows(tickets(spark, sf))


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


BASE_CTE = f"""base AS (
  SELECT number_fld, {d_clean_basic('short_description')} AS short_description,
         {d_clean_basic('description')} AS description,
         category, subcategory, assignment_group, priority, contact_type, location, u_department,
         opened_by_department, date_opened, total_price, value
  FROM tickets
  WHERE category IS NOT NULL AND subcategory IS NOT NULL AND assignment_group IS NOT NULL
)"""


def sql(*ctes: str, body: str) -> str:
    """WITH tickets AS (...), <ctes>; a body starting with its own WITH is merged into the list."""
    b = body.strip()
    if b[:5].upper() == "WITH ":
        return "WITH " + ",\n".join([TICKETS_CTE, *ctes]) + ",\n" + b[5:]
    return "WITH " + ",\n".join([TICKETS_CTE, *ctes]) + "\n" + b


def merged(spark: SparkSession, sf: str) -> DataFrame:
    """Base rows with rare classes (< 50) of each target merged into 'Other'."""
    from tixprep.operators.classes import merge_rare_targets
    return merge_rare_targets(base(spark, sf))


def labels(spark: SparkSession, sf: str) -> DataFrame:
    """Key and targets of the base rows, written once: queries that read them several times derive the tickets once."""
    return cut_lineage(base(spark, sf).select(S.NUMBER, *S.TARGETS))


def merged_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Key and targets of ``merged``, over written rows."""
    from tixprep.operators.classes import merge_rare_targets
    return merge_rare_targets(labels(spark, sf))


MERGED_CTE = """merged AS (
  SELECT number_fld, short_description, description,
    CASE WHEN count(*) OVER (PARTITION BY category) < 50 THEN 'Other' ELSE category END AS category,
    CASE WHEN count(*) OVER (PARTITION BY subcategory) < 50 THEN 'Other' ELSE subcategory END AS subcategory,
    CASE WHEN count(*) OVER (PARTITION BY assignment_group) < 50 THEN 'Other' ELSE assignment_group END AS assignment_group,
    priority, contact_type, location, u_department, opened_by_department
  FROM base
)"""
