"""Doors into the lake: delimited files, search hits, and silver itself."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.paths import ALL_DATES, DAY_IN_PATH, dated, dated_days, dated_range, day_of
from starfold.schema import CORRUPT, DOSE_DATE, FEED, HIT, SILVER
from starfold.sources import files


def read_feed_csv(spark: SparkSession, path: str, schema: T.StructType | None = FEED) -> DataFrame:
    """``;``-separated files with a header line.

    The schema is applied by position and a cell that does not fit it becomes
    null. ``schema=None`` infers types instead, at the price of a second pass.
    """
    reader = spark.read.option("sep", ";").option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_hits_json(
    spark: SparkSession, path: str, multi_line: bool = False, schema: T.StructType | None = HIT
) -> DataFrame:
    """Search hits, one row per hit; what cannot be read is one row with its text in ``_corrupt_record``.

    Line mode expects an object or an array of hits per line, and splits large files between tasks. ``multi_line`` reads
    a page however it is laid out, one task per file. ``schema=None`` infers types in a second pass.
    """
    reader = spark.read.option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_hits_for(spark: SparkSession, base: str, day: str | date = ALL_DATES, **options) -> DataFrame:
    """Search hits landed on one day, or on all days."""
    return read_hits_json(spark, dated(base, day), **options)


def bad_hit(hits: DataFrame) -> Column:
    """Whether a row is no hit: its text could not be read, or it has no source."""
    broken = F.col("_source").isNull()
    return broken | F.col(CORRUPT).isNotNull() if CORRUPT in hits.columns else broken


def days_below(spark: SparkSession, base: str) -> list[date]:
    """Days that have a folder below ``base``, in order."""
    return [day for day in map(day_of, files.matching(spark, dated(base, ALL_DATES))) if day is not None]


def read_silver(
    spark: SparkSession,
    base: str,
    day: str | date = ALL_DATES,
    until: str | date | None = None,
    schema: T.StructType = SILVER,
) -> DataFrame:
    """Silver of one run date, of all run dates, or of ``[day, until)``; only those folders are listed.

    Silver has one schema, which is not looked for in the files. Folders within a day belong to it.
    """
    path = dated(base, day) if until is None else dated_range(base, day, until)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def read_silver_days(spark: SparkSession, base: str, days: Iterable[date], day_column: str | None = None) -> DataFrame:
    """Silver of some run dates, with the date in ``day_column`` if asked for.

    Dates never loaded have no rows; folders of other dates are not listed.
    """
    loaded = files.matching(spark, dated_days(base, days))
    if not loaded:
        schema = SILVER if day_column is None else T.StructType([*SILVER, T.StructField(day_column, T.DateType())])
        return spark.createDataFrame([], schema)
    silver = spark.read.schema(SILVER).option("recursiveFileLookup", True).parquet(*loaded)
    return silver if day_column is None else with_day(silver, day_column)


def with_day(silver: DataFrame, column: str) -> DataFrame:
    """Rows read from day folders with their folder's day."""
    digits = F.regexp_replace(F.col("_metadata.file_path"), DAY_IN_PATH, "$1-$2-$3")
    return silver.select("*", digits.cast("date").alias(column))


def read_untyped(spark: SparkSession, base: str, day: str | date = ALL_DATES) -> DataFrame:
    """Untyped silver of one run date or of all, conformed: each day is read in its own types first."""
    from starfold.operators.clean import clean, conform

    days = days_below(spark, base) if day == ALL_DATES else [day]
    frames = [clean(conform(spark.read.parquet(dated(base, d)))) for d in days]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], SILVER)


def read_trusted(
    spark: SparkSession, path: str, start: str | date | None = None, until: str | date | None = None
) -> DataFrame:
    """Silver laid out by dose date, or the doses of ``[start, until)``; folders of other dates are not listed.

    Doses without date are there only when no bound is given.
    """
    silver = spark.read.schema(SILVER).parquet(path).select(*SILVER.names)
    if start is not None:
        silver = silver.filter(F.col(DOSE_DATE) >= F.lit(str(start)).cast("date"))
    if until is not None:
        silver = silver.filter(F.col(DOSE_DATE) < F.lit(str(until)).cast("date"))
    return silver
