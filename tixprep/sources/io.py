"""Guarded and typed scans, CSV sink, and the Parquet training bundle.

Files written by the library go under the shared folder named by ``spark.checkpoint.dir`` unless
the caller passes a path, so they survive executor loss and are visible to every executor.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tixprep import schema as S
from tixprep.session import table_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{table_folder(spark, 'tixprep-out')}/{name}-{uuid.uuid4().hex}"


def scan_tickets(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a ticket export with the declared schema (no inference)."""
    r = spark.read.schema(S.TICKET_SCHEMA)
    if fmt == "csv":
        return r.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return r.parquet(path)


def scan_typed(df: DataFrame, schema: T.StructType = S.TICKET_SCHEMA) -> DataFrame:
    """Cast an existing frame to the declared ticket schema (columns it lacks are skipped)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns])


def scan_guarded(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A missing path -> an empty table (callers gate on ``isEmpty()``). Any other fault, such as a
    schema that does not fit or a missing permission, is raised."""
    try:
        return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema or S.TICKET_SCHEMA)


def sink_csv(df: DataFrame, path: str) -> str:
    """Header, no index; texts with newlines are quoted."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def sink_csv_roundtrip(df: DataFrame, schema: T.StructType) -> DataFrame:
    path = sink_csv(df, scratch_path(df.sparkSession, "csv"))
    return (df.sparkSession.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').csv(path))


def sink_bundle(samples: DataFrame, dictionary: DataFrame, level_weights: DataFrame | None, path: str,
                partition_col: str | None = "split") -> str:
    """Three Parquet tables: samples (partitioned by split when present), label_dict, level_weights."""
    w = samples.write.mode("overwrite")
    if partition_col and partition_col in samples.columns:
        w = w.partitionBy(partition_col)
    w.parquet(f"{path}/samples")
    dictionary.write.mode("overwrite").parquet(f"{path}/label_dict")
    if level_weights is not None:
        level_weights.write.mode("overwrite").parquet(f"{path}/level_weights")
    return path


def scan_bundle(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(samples, label_dict, level_weights) of a bundle; level_weights is empty if none were written."""
    levels = scan_guarded(spark, f"{path}/level_weights", T.StructType([
        T.StructField("target", T.StringType()), T.StructField("value", T.StringType()),
        T.StructField("n", T.LongType()), T.StructField("level_weight", T.DoubleType())]))
    return spark.read.parquet(f"{path}/samples"), spark.read.parquet(f"{path}/label_dict"), levels


def sink_report(report: DataFrame, path: str) -> str:
    """Long report table as Parquet plus a text rendering (one line per metric)."""
    report.write.mode("overwrite").parquet(f"{path}/table")
    line = F.format_string("%s | %s | %s | %s", "section", "item", "metric", "value")
    report.select(line.alias("value")).write.mode("overwrite").text(f"{path}/text")
    return path
