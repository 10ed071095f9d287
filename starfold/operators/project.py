"""Projection and null-filter helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.functions.keys import all_present


def pick(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select columns under new names (new name -> old name)."""
    return df.select(*(F.col(old).alias(new) for new, old in columns.items()))


def drop_if_any_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spelled as null tests, which unlike ``dropna`` reach the file scan."""
    return df.filter(all_present(columns))


def drop_if_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns]))
