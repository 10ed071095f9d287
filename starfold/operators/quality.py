"""Checks on finished tables; each is one aggregate row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_uniqueness(dim: DataFrame, keys: Sequence[str], surrogate: str) -> DataFrame:
    """Rows, distinct natural keys and distinct surrogate keys.

    Counted in two steps: one row per (natural key, surrogate) first, which is
    combined in each task, then one per surrogate.
    """
    per_key = dim.groupBy(*keys, surrogate).agg(F.count(F.lit(1)).alias("_rows"))
    per_surrogate = per_key.groupBy(surrogate).agg(
        F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_keys")
    )
    return per_surrogate.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("_keys"), F.lit(0)).alias("n_keys"),
        F.count(F.lit(1)).alias("n_surrogates"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and, per column, how many of them are null."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns),
    )


def unresolved_keys(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key column, how many fact rows point at no dimension row (nulls not counted)."""
    checks = []
    for column, (dim, surrogate) in dims.items():
        used = fact.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter(F.col(column).isNotNull())
        missing = used.join(dim.select(F.col(surrogate).alias(column)), column, "left_anti")
        checks.append(
            missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_unresolved")).select(
                F.lit(column).alias("foreign_key"), "n_unresolved"
            )
        )
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report
