"""Whether the landed pages of a day are all there, once each, in order.

A day is fetched page by page, each asked for after the last cursor (``sort``) of the page before, and written as one
numbered file. So numbers run on from 1, cursors rise from page to page, and every page but the last is full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starfold.paths import ALL_DATES, DAY_IN_PATH
from starfold.schema import FEED
from starfold.sources.feed import bad_hit, read_hits_for

PAGE_NUMBER = r"(?:_|page=)(\d+)(?:\.json|/)"
MISSING, TWICE, OVERLAP, SHORT, REPEATED, BROKEN = "missing", "twice", "overlap", "short", "repeated hits", "broken"


def cursor(sort: Column) -> Column:
    """A cursor in its order: times as numbers, then as texts, then ids."""
    return F.struct(
        F.get(sort, F.lit(0)).try_cast("bigint").alias("time"), F.get(sort, F.lit(0)).alias("time_text"),
        F.get(sort, F.lit(1)).alias("id"),
    )


def landed_pages(spark: SparkSession, base: str, day: str = ALL_DATES, multi_line: bool = True, number: str = PAGE_NUMBER) -> DataFrame:
    """One row per page: day, number, hits, first and last cursor, and a sum over the hits."""
    hits = read_hits_for(spark, base, day, multi_line=multi_line)
    path = F.col("_metadata.file_path")
    rows = hits.select(
        F.regexp_replace(path, DAY_IN_PATH, "$1-$2-$3").cast("date").alias("day"),
        F.regexp_extract(path, number, 1).try_cast("int").alias("page"),
        bad_hit(hits).alias("_bad"), cursor(F.col("sort")).alias("_cursor"),
        F.xxhash64(*(F.col(f"_source.{name}") for name in FEED.names), "sort").alias("_hash"),
    )
    good = F.when(~F.col("_bad"), F.col("_cursor"))
    return rows.groupBy("day", "page").agg(
        F.count_if(~F.col("_bad")).alias("n_hits"), F.count_if("_bad").alias("n_bad"), F.min(good).alias("first"),
        F.max(good).alias("last"), F.sum(F.when(~F.col("_bad"), F.col("_hash").cast("decimal(20,0)"))).alias("hits_sum"),
        F.count_distinct(good).alias("n_cursors"),
    )


def page_gaps(pages: DataFrame, page_size: int | None = None) -> DataFrame:
    """What is wrong with the pages of each day: ``day``, ``page``, ``problem``; no rows if nothing is.

    ``missing`` numbers between 1 and the last page (a lost last page leaves no number, but the page before it is full);
    pages landed ``twice``; pages that begin before the last cursor of those before them (``overlap``); pages with
    ``repeated hits``; ``broken`` pages; with ``page_size``, pages before the last that are ``short``. A day has one row per
    ten thousand hits or so, and is looked through in one task.
    """
    day = Window.partitionBy("day")
    before = day.orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    alike = Window.partitionBy("day", "n_hits", "first", "last", "hits_sum").orderBy("page")
    seen = pages.select(
        "*", F.lag("page", 1, 0).over(day.orderBy("page")).alias("_previous"), F.max("last").over(before).alias("_reached"),
        F.max("page").over(day).alias("_end"), (F.row_number().over(alike) > 1).alias("_twice"),
    )
    twice = F.col("_twice") & (F.col("n_hits") > 0)
    lost = F.when(F.col("page") > F.col("_previous") + 1, F.sequence(F.col("_previous") + 1, F.col("page") - 1))
    gaps = seen.select("day", F.explode(lost).alias("page"), F.lit(MISSING).alias("problem"))
    found = [
        F.when(twice, TWICE), F.when(~twice & (F.col("first") <= F.col("_reached")), OVERLAP),
        F.when(F.col("n_cursors") < F.col("n_hits"), REPEATED), F.when(F.col("n_bad") > 0, BROKEN),
    ]
    if page_size is not None:
        found.append(F.when((F.col("page") < F.col("_end")) & (F.col("n_hits") < page_size), SHORT))
    wrong = seen.select("day", "page", F.explode(F.array_compact(F.array(*found))).alias("problem"))
    return gaps.unionByName(wrong)
