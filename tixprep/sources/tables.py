"""Reading the driver tables and deriving the ``tickets`` view from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tixprep import schema as S

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tickets(spark: SparkSession, sf_dir: str, of_texts: Callable[[Column, Column], list[Column]] | None = None) -> DataFrame:
    """Ticket table derived from documents + orders + customer + nation + region + events.

    Every document joins exactly one order; events are optional (left join). Nulls are injected
    by fixed residues of the key so that the fill/drop operators have work to do. ``of_texts`` names columns
    that a caller takes from (short description, description): they are added to the row and worked out where the
    text lies, so that a caller who reads them alone moves no text.
    """
    t = lambda n: read_table(spark, sf_dir, n)
    lead = F.regexp_extract("text", "^[A-Za-z]+", 0)  # cut out before the join: labels travel without the texts
    k = F.col("doc_id")

    def null_on(m: int, v):
        return F.when(k % m == 0, F.lit(None).cast("string")).otherwise(v)

    short, desc = null_on(13, F.substring_index("text", "\n", 1)), null_on(19, F.col("text"))
    d = t("documents").select("doc_id", "text", "lang", "n_chars", F.nullif(F.lower(lead), F.lit("")).alias("lead"),
                              *(of_texts(short, desc) if of_texts else []))
    own = d.columns[5:]
    o = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = t("region").select("r_regionkey", "r_name")
    e = t("events").select("event_id", "event_type", "value")
    # the narrow tables meet first, for the orders that have a document; a text is moved once, to its order
    o = o.join(t("documents").select(F.col("doc_id").alias("_doc")), F.col("o_orderkey") == F.col("_doc"), "left_semi")
    o = (
        o.join(e, o.o_orderkey == e.event_id, "left")
        .join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
    )
    j = d.join(o, d.doc_id == o.o_orderkey)
    nc = F.col("n_chars")
    sub = (
        F.when(nc < 100, "xs").when(nc < 300, "s").when(nc < 1000, "m")
        .when(nc < 3000, "l").when(nc < 10000, "xl").otherwise("xxl")
    )
    date_txt = (
        F.when(k % 37 == 0, F.lit("not a date"))
        .when(k % 10 == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.col("o_orderdate").cast("string"))
    )
    return j.select(
        k.alias(S.NUMBER),
        short.alias(S.SHORT),
        desc.alias(S.DESC),
        F.col("lang").alias(S.CATEGORY),
        sub.alias(S.SUBCATEGORY),
        F.col("lead").alias(S.GROUP),
        null_on(17, F.col("o_orderpriority")).alias(S.PRIORITY),
        null_on(11, F.col("event_type")).alias(S.CONTACT),
        null_on(23, F.col("n_name")).alias(S.LOCATION),
        F.col("c_mktsegment").alias(S.U_DEPT),
        null_on(29, F.col("r_name")).alias(S.OPENED_DEPT),
        date_txt.alias(S.DATE_OPENED),
        F.col("o_totalprice").alias("total_price"),
        F.col("value"),
        *own,
    )
