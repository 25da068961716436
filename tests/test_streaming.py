from tixprep import schema as S
from tixprep.streaming import prepare_stream


def test_prepare_stream_on_a_file_stream(spark, tmp_path):
    src = tmp_path / "in"
    rows = [(1, "Hello WORLD 42", None, "a", "b", "c", None, None, None, None, None, None, 1.0, 2.0)]
    spark.createDataFrame(rows, S.TICKET_SCHEMA).write.parquet(str(src))
    stream = spark.readStream.schema(S.TICKET_SCHEMA).parquet(str(src))
    q = prepare_stream(stream).writeStream.format("memory").queryName("prep_out").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.sql("SELECT combined_text FROM prep_out").collect()
    assert got[0].combined_text.startswith("hello world [num] [SEP] ")
