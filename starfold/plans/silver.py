"""Bronze to silver."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starfold.operators.clean import clean, conform, flatten_hits, pick_feed
from starfold.paths import ALL_DATES, LakePaths, one_day
from starfold.schema import CORRUPT, DOSE_DATE, FEED
from starfold.session import release
from starfold.sources import files
from starfold.sources.feed import bad_hit, days_below, read_feed_csv, read_hits_for
from starfold.sources.sinks import write_day, write_partitioned


def silver_from_csv(raw: DataFrame, fold: str = "default") -> DataFrame:
    return clean(raw, fold=fold)


def silver_from_hits(hits: DataFrame, conformed: bool = True, fold: str = "default") -> DataFrame:
    """Hits to silver rows; ``conformed=False`` keeps the types as read and leaves dates alone.

    Records that could not be read are no hits and make no rows.
    """
    flat = flatten_hits(hits.filter(~bad_hit(hits)))
    rows = conform(flat) if conformed else pick_feed(flat)
    return clean(rows, dates=conformed, fold=fold)


def rejected_texts(hits: DataFrame) -> DataFrame:
    """The records that could not be read, as texts."""
    return hits.filter(bad_hit(hits)).select(F.coalesce(CORRUPT, F.to_json(F.struct("*"))).alias("value"))


def load_csv(spark: SparkSession, paths: LakePaths, day: str | date, infer: bool = False) -> None:
    """All landed delimited files to the silver folder of a run date.

    ``infer`` keeps inferred types and goes to the untyped folder.
    """
    raw = read_feed_csv(spark, paths.landing_csv, None if infer else FEED)
    write_day(silver_from_csv(raw), paths.untyped if infer else paths.silver, day)
    release(spark)


def load_csv_by_dose_date(spark: SparkSession, paths: LakePaths) -> None:
    """All landed delimited files to silver laid out by dose date."""
    write_partitioned(silver_from_csv(read_feed_csv(spark, paths.landing_csv)), paths.trusted, DOSE_DATE)
    release(spark)


def load_hits(
    spark: SparkSession,
    paths: LakePaths,
    day: str | date,
    multi_line: bool = True,
    conformed: bool = True,
    mode: str = "overwrite",
) -> int:
    """The hits landed on a day to the silver folder of that day, or all landed days each to its own.

    Records that could not be read are set aside in the rejected folder of their day; returns how many there were.
    ``conformed=False`` keeps types as read and goes to the untyped folder.
    """
    if day == ALL_DATES:
        days = days_below(spark, paths.landing_json)
        return sum(load_hits(spark, paths, d, multi_line, conformed, mode) for d in days)
    hits = read_hits_for(spark, paths.landing_json, day, multi_line=multi_line)
    seen = Observation()
    counted = hits.observe(seen, F.count_if(bad_hit(hits)).alias("bad"))
    write_day(silver_from_hits(counted, conformed), paths.silver if conformed else paths.untyped, day, mode)
    bad = seen.get["bad"]
    if mode == "overwrite":
        # What the day's earlier loads set aside is no longer so.
        files.delete(spark, one_day(paths.rejected, day))
    if bad:
        rejected_texts(hits).write.mode(mode).text(one_day(paths.rejected, day))
    return bad
