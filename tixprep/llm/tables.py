"""Intermediate tables in this application's part of the shared checkpoint folder (removed when the
driver ends), and early removal of those that no later plan reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tixprep.session import table_folder


class Steps:
    """Tables written one after another; ``drop`` removes one that later plans no longer read."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.root = f"{table_folder(self.spark)}/{uuid.uuid4().hex}"
        self.written: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame, **options) -> DataFrame:
        path = f"{self.root}/{len(self.written)}"
        df.write.mode("overwrite").options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.written.append((out, path))
        return out

    def drop(self, df: DataFrame) -> None:
        path = next(path for out, path in self.written if out is df)
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to be none of the columns (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
