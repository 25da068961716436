from pyspark.sql import functions as F

from tixprep.operators import augment as A


def test_a_word_is_exchanged_without_a_list_of_words(spark):
    text = "one two [SEP] three"
    rows = [(text, k, "new", 4) for k in range(4)] + [("one", 0, "new", 1)]
    d = spark.createDataFrame(rows, "t string, at int, w string, n int")
    got = [r.x for r in d.select(A._with_word(F.col("t"), F.col("at"), F.col("w"), F.col("n")).alias("x")).collect()]
    assert got == ["new two [SEP] three", "one new [SEP] three", "one two new three", "one two [SEP] new", "new"]
    plan = A._with_word(F.col("t"), F.col("at"), F.col("w"), F.col("n"))
    assert "split" not in str(plan) and "slice" not in str(plan)
