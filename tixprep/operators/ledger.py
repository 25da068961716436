"""A caller's text function over a table in chunks, with a ledger: what is done stays done, what failed is
kept with its error, and a second run does only what is missing.

The folder holds the input once (keys, texts, chunk numbers) and one committed table per wave of chunks. A
chunk that raises is a ledger row with the error's text and no results; the other chunks of its wave are not touched. When the
driver dies, the waves that were committed stay."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tixprep import schema as S
from tixprep.operators.ranking import range_rank

WAVE_CHUNKS = 10_000


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


class ChunkLedger:
    """The ledger of one transform in ``folder``, which driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, key_cols: Sequence[str], text_col: str = "text"):
        self.spark, self.folder, self.keys, self.text = spark, folder.rstrip("/"), list(key_cols), text_col

    def start(self, df: DataFrame, chunk: int = S.TRANSLATE_CHUNK) -> None:
        """Writes the input in chunks of ``chunk`` rows in key order, unless a whole one is there already."""
        if _exists(self.spark, f"{self.folder}/input/_SUCCESS"):
            return
        ranked = range_rank(df.select(*self.keys, self.text), [F.col(k) for k in self.keys] + [F.col(self.text)], out="_r")
        rows = ranked.select(*self.keys, self.text, F.floor((F.col("_r") - 1) / chunk).alias("chunk"))
        rows.write.mode("overwrite").parquet(f"{self.folder}/input")

    def _input(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/input")

    def _entries(self) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.folder}/waves/*") if _exists(self.spark, f"{self.folder}/waves") else None

    def _waves(self) -> int:
        if not _exists(self.spark, f"{self.folder}/waves"):
            return 0
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/waves")
        names = [s.getPath().getName() for s in path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
        return 1 + max((int(n) for n in names), default=-1)

    def ledger(self) -> DataFrame:
        """(chunk, status, error, attempts): 'done', 'failed' (with the last error) or 'open'."""
        chunks = self._input().select("chunk").distinct()
        seen = self._entries()
        if seen is None:
            return chunks.select("chunk", F.lit("open").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(0).cast("long").alias("attempts"))
        marks = seen.filter("mark").groupBy("chunk").agg(F.max(F.col("error").isNull()).alias("ok"), F.max(F.struct("wave", "error")).alias("last"), F.count(F.lit(1)).alias("attempts"))
        return chunks.join(marks, "chunk", "left").select(
            "chunk", F.when(F.col("ok"), "done").when(~F.col("ok"), "failed").otherwise("open").alias("status"),
            F.when(~F.col("ok"), F.col("last.error")).alias("error"), F.coalesce("attempts", F.lit(0)).alias("attempts"))

    def run(self, fn: Callable[[list[str]], list[str]], wave_chunks: int = WAVE_CHUNKS) -> DataFrame:
        """Calls ``fn`` (texts to as many texts) on every chunk that is not done, one committed wave after the
        other, and returns the ledger."""
        todo = self.ledger().filter("status <> 'done'").select("chunk")
        todo = range_rank(todo, [F.col("chunk")], out="_r").withColumn("turn", F.floor((F.col("_r") - 1) / wave_chunks)).drop("_r")
        turns = todo.agg(F.max("turn")).first()[0]
        keys, text = self.keys, self.text
        source = self._input()
        schema = T.StructType([*[source.schema[k] for k in keys], T.StructField("new_text", T.StringType()), T.StructField("chunk", T.LongType()),
                               T.StructField("mark", T.BooleanType()), T.StructField("error", T.StringType())])

        def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: list[pd.DataFrame] = []

            def finish() -> Iterator[pd.DataFrame]:
                rows = pd.concat(held)
                held.clear()
                error, found = None, None
                try:
                    found = list(fn(rows[text].tolist()))
                    if len(found) != len(rows):
                        raise ValueError(f"{len(found)} texts for {len(rows)}")
                except Exception as ex:  # noqa: BLE001 - a caller's function may raise anything; the ledger keeps it
                    error = f"{type(ex).__name__}: {ex}"
                chunk = int(rows["chunk"].iloc[0])
                mark = pd.DataFrame({**{k: [None] for k in keys}, "new_text": [None], "chunk": [chunk], "mark": [True], "error": [error]})
                yield mark.astype({k: "object" for k in keys})
                if error is None:
                    out = rows[keys].copy()
                    out["new_text"], out["chunk"], out["mark"], out["error"] = found, chunk, False, None
                    yield out
            for frame in frames:
                for _, part in frame.groupby("chunk", sort=False):
                    if held and held[0]["chunk"].iloc[0] != part["chunk"].iloc[0]:
                        yield from finish()
                    held.append(part)
            if held:
                yield from finish()

        if turns is not None:
            for turn in range(turns + 1):
                wave = self._waves()
                now = source.join(F.broadcast(todo.filter(F.col("turn") == turn).select("chunk")), "chunk")  # at most wave_chunks numbers
                dealt = now.repartition("chunk").sortWithinPartitions("chunk", *keys, text)
                nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
                dealt.select(*keys, text, "chunk").mapInPandas(call, nullable).withColumn("wave", F.lit(wave)).write.mode("overwrite").parquet(f"{self.folder}/waves/{wave}")
        return self.ledger()

    def results(self) -> DataFrame:
        """(key_cols, new_text) of all chunks that are done."""
        seen = self._entries()
        if seen is None:
            return self._input().select(*self.keys, F.lit(None).cast("string").alias("new_text")).limit(0)
        return seen.filter("NOT mark").select(*self.keys, "new_text")
