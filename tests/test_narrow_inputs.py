"""Queries that read labels several times read written narrow rows; a bundle's texts are written once."""

import pytest
from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep import session
from tixprep.operators.sampling import stratified_split
from tixprep.plans.prepare import prepare_training_set, sample_keys

SF = "/root/testdata/sf0.001"


@pytest.fixture
def written(monkeypatch):
    """Columns of every table written to the checkpoint folder."""
    found, write = [], session.write_table
    monkeypatch.setattr(session, "write_table", lambda df: found.append(df.columns) or write(df))
    return found


@pytest.mark.parametrize("name", ["weighted_sample_replace", "weight_lookup", "label_decode", "unseen_combos", "stratified_split_by_source"])
def test_tickets_are_derived_once(spark, written, name):
    from tixprep.queries import QUERIES, load_all
    load_all()
    out = QUERIES[name](spark, SF)
    assert [S.NUMBER, *S.TARGETS] in written
    assert not any(f.endswith(("documents.parquet", "orders.parquet")) for f in out.inputFiles())


def test_texts_are_not_written_before_the_bundle(spark, written):
    from tixprep.queries import q_evaluate as Q
    path = Q._bundle(spark, SF)
    assert "text" in spark.read.parquet(f"{path}/samples").columns
    assert written and not any("text" in columns for columns in written)


def ticket_rows(spark):
    """Labels of three sizes, nulls among them, keys that repeat or are null."""
    rows = [(k % 97 if k % 11 else None, f"short {k}", f"some longer words {k}", "abcc"[k % 4], "x" if k % 6 else "y", "gh"[k % 2] if k % 13 else None)
            for k in range(400)]
    names = [S.NUMBER, S.SHORT, S.DESC, *S.TARGETS]
    df = spark.createDataFrame(rows, "a long, b string, c string, d string, e string, f string").toDF(*names)
    return df.select("*", *[F.lit(None).cast("string").alias(f.name) for f in S.TICKET_SCHEMA.fields if f.name not in names])


def test_keys_of_samples_are_those_of_the_training_set(spark):
    lexicon = spark.createDataFrame([("words", ["terms", "signs"]), ("some", ["few"])], "word string, synonyms array<string>")
    t = ticket_rows(spark)
    columns = ["src_id", "aug_no", *S.TARGETS]
    key = lambda r: tuple(str(x) for x in r)
    whole = sorted(map(key, prepare_training_set(t, lexicon).select(*columns).collect()))
    assert sorted(map(key, sample_keys(t).select(*columns).collect())) == whole
    assert len(whole) > 400


def test_split_by_keys_from_elsewhere(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("label"), F.lit("text").alias("text"))
    want = {r["k"]: r["split"] for r in stratified_split(df, "label", "k").collect()}
    got = {r["k"]: r["split"] for r in stratified_split(df, "label", "k", keys=df.select("label", "k")).collect()}
    assert got == want and set(want.values()) == {"train", "val"}


def test_chain_writes_one_text_a_row(spark, written):
    from tixprep.queries import QUERIES, load_all
    load_all()
    QUERIES["oversample_chain"](spark, SF)
    texts = [columns for columns in written if {"combined_text", S.SHORT, S.DESC} & set(columns)]
    assert [sorted(columns) for columns in texts] == [sorted([S.NUMBER, *S.TARGETS, "combined_text", "f1", "f2", "f3", "_rid"])]


def test_label_tables_are_sent_to_the_texts(spark, monkeypatch):
    """Beyond the planner's threshold too; a larger table is joined by sorting, with the same rows."""
    from tixprep.operators.classes import merge_rare_targets
    t = ticket_rows(spark)
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    bag = lambda df: sorted(map(str, df.collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = merge_rare_targets(t)
        assert "BroadcastHashJoin" in plan(sent) and "SortMergeJoin" not in plan(sent)
        monkeypatch.setattr(session, "LABEL_TABLE_MB", -1)
        sorted_by_label = merge_rare_targets(t, counted=t.select(*S.TARGETS))
        assert "SortMergeJoin" in plan(sorted_by_label)
        assert bag(sent) == bag(sorted_by_label)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
