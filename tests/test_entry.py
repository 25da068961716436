import __spark_entry__ as E
from tests.paths import SF01


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"src_id", "aug_no", "text", "sample_weight", "category_code"} <= set(df.columns)


def test_known_answer_sf01(spark):
    # after the 52-row drop, merge at 50 and the chained oversampling: 1,780 rows
    df = E.queries()["prepare_training_set"](spark, SF01)
    assert df.count() == 1780


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
