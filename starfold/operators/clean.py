"""Cleaning steps: feed DataFrame in, feed DataFrame out, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.functions.text import digits_to_date, fold_accents, null_token
from starfold.schema import DOSE_DATE, FEED, LOT


# From so many text columns on, their whole-stage code may be one method longer than the JVM compiles.
WIDE = 12


def map_text_columns(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Apply ``change`` to every string column; other columns pass through.

    In a wide table the first text column is changed by a higher-order function. Spark keeps a projection with one out of
    whole-stage code and generates a method per column for it, which the JVM compiles, whatever the session's settings.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    apart = names[0] if len(names) >= WIDE else None

    def changed(name: str) -> Column:
        if name == apart:
            return F.get(F.transform(F.array(name), change), F.lit(0)).alias(name)
        return change(F.col(name)).alias(name) if name in names else F.col(name)

    return df.select(*map(changed, df.columns))


def clean_text_columns(df: DataFrame, fold: str = "default") -> DataFrame:
    """Strip spaces and fold accents in every text column.

    Folding never yields a space, so stripping may come last, where it is written once.
    """
    return map_text_columns(df, lambda text: F.trim(fold_accents(text, fold)))


def null_tokens(df: DataFrame) -> DataFrame:
    """Turn "no value" texts into nulls in every text column."""
    return map_text_columns(df, null_token)


def normalise_lot(df: DataFrame, column: str = LOT) -> DataFrame:
    return df.withColumn(column, F.upper(column))


def normalise_date(df: DataFrame, column: str = DOSE_DATE) -> DataFrame:
    """Read a date out of a text; a column that already is a date stays."""
    if isinstance(df.schema[column].dataType, T.DateType):
        return df
    return df.withColumn(column, digits_to_date(F.col(column).cast("string")))


def flatten_hits(df: DataFrame) -> DataFrame:
    """Search hits to flat rows."""
    return df.select("_source.*")


def pick_feed(df: DataFrame) -> DataFrame:
    """The feed columns, in feed order, types untouched."""
    return df.select(*FEED.names)


def conform(df: DataFrame) -> DataFrame:
    """The feed columns in their declared types; what cannot be cast becomes null.

    The dose date is read as a date here, which also accepts partial ISO texts;
    what that cast refuses still gets the digits rule.
    """

    def conformed(field: T.StructField) -> Column:
        column = F.col(field.name)
        if field.name == DOSE_DATE:
            text = column.cast("string")
            return F.coalesce(text.try_cast("date"), digits_to_date(text)).alias(field.name)
        return column.try_cast(field.dataType).alias(field.name)

    return df.select(*(conformed(f) for f in FEED))


def clean(df: DataFrame, dates: bool = True, fold: str = "default") -> DataFrame:
    """All cleaning steps in order."""
    cleaned = normalise_lot(null_tokens(clean_text_columns(df, fold)))
    return normalise_date(cleaned) if dates else cleaned
