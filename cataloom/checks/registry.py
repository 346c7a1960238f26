"""Registered queries: a Spark job over the driver tables and, where SQL can say
the same over whole tables, its SQL text."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators.changes import Audit
from ..session import shared_folder, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AUDIT = Audit(datetime(2024, 1, 2, 3, 4, 5), 7)
NOW_SQL = "TIMESTAMP '2024-01-02 03:04:05'"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """New folder for written tables."""
    return f"{shared_folder(spark)}/cataloom-{uuid.uuid4().hex}"
