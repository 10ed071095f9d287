"""Name -> query and name -> SQL of the operators in this subpackage."""

from __future__ import annotations

import functools
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from starfold.queries.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers look for this library where the driver has it, beside their own path.

    That is enough for local sessions and shared installations started from another folder; a cluster is given the package
    with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def query(function: Query, sql: str | None = None) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    if sql is not None:
        SQL[function.__name__] = sql
    return function
