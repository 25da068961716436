"""Registered queries of the training-data operators: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tixprep.llm import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def twin(sql: str):
    """Registers a query with the SQL that gives the same rows."""
    def add(fn):
        ORACLE[fn.__name__] = sql
        return query(fn)
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@twin(sql.decontaminate())
def op1_decontaminate(spark, sf_dir):
    """Whole documents against all benchmark items."""
    from tixprep.llm.decontaminate import contamination
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("matches")


@query
def op7_simhash_dedup(spark, sf_dir):
    """Fingerprint and group of every document."""
    from tixprep.llm.simhash import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op3_pack(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    from tixprep.llm.packing import pack
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@twin(sql.pii())
def op8_pii(spark, sf_dir):
    """Personal data in every document."""
    from tixprep.llm.pii import pii_report
    return pii_report(_table(spark, sf_dir, "documents"))


@query
def op5_quality(spark, sf_dir):
    """Quality of every document, learnt from the labels that are not held out."""
    from tixprep.llm.quality import quality_scores
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@twin(sql.licenses())
def op4_licenses(spark, sf_dir):
    """License notices in every document."""
    from tixprep.llm.licenses import find_licenses
    found = F.transform("found", lambda x: F.concat_ws(":", x["license"], x["line"].cast("string"), x["n_lines"].cast("string")))
    return find_licenses(_table(spark, sf_dir, "documents")).withColumn("found", F.array_join(found, ","))


@query
def op4_notices(spark, sf_dir):
    """License notices in every document, wherever lines break and whatever surrounds them."""
    from tixprep.llm.licenses import find_notices
    found = F.transform("found", lambda x: F.concat_ws(":", x["license"], x["word"].cast("string"), x["n_words"].cast("string")))
    return find_notices(_table(spark, sf_dir, "documents")).withColumn("found", F.array_join(found, ","))


@twin(sql.cover_tree())
def op10_cover_tree(spark, sf_dir):
    """Links and groups of all embeddings at cosine 0.9."""
    from tixprep.llm.cover_tree import near_duplicate_vectors
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


@query
def op6_main_text(spark, sf_dir):
    """Main text of every page."""
    from tixprep.llm.html_extract import main_text
    return main_text(_table(spark, sf_dir, "pages"))


@twin(sql.repeats())
def op9_repeats(spark, sf_dir):
    """Repeated strings of 100 bytes removed from every document."""
    from tixprep.llm.repeats import without_repeats
    return without_repeats(_table(spark, sf_dir, "documents"))


@query
def op2_lm_score(spark, sf_dir):
    """All documents scored by a suffix tree learnt from those that are not held out."""
    from tixprep.llm.suffix_lm import lm_scores
    return lm_scores(_table(spark, sf_dir, "documents"))


@twin(sql.fill_in_middle())
def op13_fill_middle(spark, sf_dir):
    """Every document turned for filling in the middle, and restored from what came out."""
    from tixprep.llm.fill_middle import fill_in_middle, restore
    back = restore(fill_in_middle(_table(spark, sf_dir, "documents")))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"))


@twin(sql.divergence())
def op11_source_divergence(spark, sf_dir):
    """How far the sources of every language diverge, and in which terms."""
    from tixprep.llm.divergence import source_divergence
    return source_divergence(_table(spark, sf_dir, "documents"))


@query
def op12_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from the labels that are not held out."""
    from tixprep.llm.toxicity import toxicity_scores
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
