"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per operator key, and
its DuckDB twin (when the operator is SQL-expressible). Every query reads the driver tables (or
data Spark derives from them) in full."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    from tixprep.queries import (  # noqa: F401
        q_augment, q_classes, q_evaluate, q_fields, q_hierarchy, q_profile, q_sampling, q_text,
    )
