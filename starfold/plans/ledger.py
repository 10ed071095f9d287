"""Which landed days are loaded, from which files; and loading those that are not."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.operators.compare import row_hash
from starfold.paths import DAY_IN_PATH, LakePaths, dated, parse_day
from starfold.plans.pipeline import load_landed_days
from starfold.plans.serving import written
from starfold.sources import files
from starfold.sources.tables import LOAD_DATE, SnapshotTable

STATE = T.StructType(
    [
        T.StructField("day", T.DateType()), T.StructField("n_files", T.LongType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("newest", T.TimestampType()), T.StructField("files_sum", T.DecimalType(38, 0)),
    ]
)


def landing_state(spark: SparkSession, base: str) -> DataFrame:
    """What lies in each day's landing folder: files, bytes, newest file time, and a sum over names, sizes and times.

    Files are listed by Spark and never opened. A file that was added, replaced or taken away changes the sum.
    """
    if not files.matching(spark, dated(base, "*")):
        return spark.createDataFrame([], STATE)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(dated(base, "*"))
    listed = listed.select("path", "modificationTime", "length").filter(
        ~F.substring_index("path", "/", -1).rlike("^[_.]")
    )
    day = F.regexp_replace("path", DAY_IN_PATH, "$1-$2-$3").cast("date")
    rows = listed.select("*", day.alias("day"), row_hash(["path", "modificationTime", "length"]).alias("_hash"))
    state = rows.groupBy("day").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"), F.max("modificationTime").alias("newest"),
        F.sum(F.col("_hash").cast("decimal(20,0)")).cast("decimal(38,0)").alias("files_sum"),
    )
    return state.filter(F.col("day").isNotNull())


def ledger_table(spark: SparkSession, paths: LakePaths) -> SnapshotTable:
    return SnapshotTable(spark, paths.ledger, T.StructType([*STATE, T.StructField(LOAD_DATE, T.DateType())]))


def read_ledger(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The state each day was last loaded from."""
    table = ledger_table(spark, paths)
    return table.read().drop(LOAD_DATE) if table.exists() else spark.createDataFrame([], STATE)


def due(state: DataFrame, ledger: DataFrame) -> DataFrame:
    """Days whose files are not those they were loaded from, never loaded ones among them."""
    loaded = ledger.select(F.col("day").alias("_day"), F.col("n_files").alias("_n_files"), F.col("files_sum").alias("_files_sum"))
    same = (F.col("day") == F.col("_day")) & (F.col("n_files") == F.col("_n_files")) & (F.col("files_sum") == F.col("_files_sum"))
    return state.join(loaded, same, "left_anti")


def catch_up(
    spark: SparkSession,
    paths: LakePaths,
    until: str | date | None = None,
    multi_line: bool = True,
    most_days: int | None = None,
    **options,
) -> list[date]:
    """Load every landed day that is not loaded from the files it has now, oldest first; returns the days loaded.

    Days from ``until`` on are left alone; ``most_days`` bounds one run, the next goes on. What lay in the folders is looked
    at before anything is loaded, and recorded after the star is committed: a file that arrives meanwhile makes its day due
    again, and a run that failed is simply repeated.
    """
    state = landing_state(spark, paths.landing_json)
    if until is not None:
        state = state.filter(F.col("day") < F.lit(parse_day(until)))
    open_days = written(due(state, read_ledger(spark, paths)), "days-due")
    days = sorted(row["day"] for row in open_days.select("day").collect())[:most_days]
    if not days:
        return []
    load_landed_days(spark, paths, days, multi_line, **options)
    loaded = open_days.filter(F.col("day").isin([F.lit(d) for d in days])).withColumn(LOAD_DATE, F.col("day"))
    ledger_table(spark, paths).load_batches(loaded, [str(d) for d in days])
    return days
