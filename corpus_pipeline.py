"""Five operators in a row over ``documents``: scores of quality, groups of near copies, benchmark passages, personal
details, fixed-length sequences. A stage reads the Parquet that the stage before it wrote; every stage but the last hands
on the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tixprep.llm.tables import Steps


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a quality score of 0.5 or more."""
    from tixprep.llm.quality import keep_good
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies, that with the smallest id."""
    from tixprep.llm.simhash import keep_one_of_each
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of whose words fewer than 5 in 100 lie in windows of benchmark items."""
    from tixprep.llm.decontaminate import remove_contaminated
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the kind of a personal detail in its place; ``n_chars`` is counted anew."""
    from pyspark.sql import functions as F

    from tixprep.llm.pii import mask_pii
    out = mask_pii(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, with their ids."""
    import public_tokenizers

    from tixprep.llm.packing import pack
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; a stage's input is removed when the next one has been written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables, before = Steps(docs), None
    for _, stage in STAGES:
        after = tables.write(stage(spark, docs, sf_dir))
        if before is not None:
            tables.drop(before)
        docs = before = after
    return docs


# SQL expresses neither the classifier nor the tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL = None
