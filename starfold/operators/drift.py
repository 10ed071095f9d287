"""How landed hits depart from the declared feed: fields that are unknown, missing or of another type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.paths import ALL_DATES, DAY_IN_PATH, dated
from starfold.schema import FEED
from starfold.session import scratch_dir

UNKNOWN, MISSING, RETYPED = "unknown", "missing", "retyped"
# What a declared type looks like in JSON; a null tells nothing.
EXPECTED = {f.name: "BIGINT" if isinstance(f.dataType, T.IntegerType) else "STRING" for f in FEED}
NO_TYPE = "VOID"


def landed_variants(spark: SparkSession, base: str, day: str = ALL_DATES, multi_line: bool = True) -> DataFrame:
    """``day`` and ``hit``, a variant with every member the hit came with; what cannot be parsed is left out.

    Line mode expects an object or an array of hits per line; ``multi_line`` one array per file.
    """
    texts = spark.read.text(dated(base, day), wholetext=multi_line)
    texts = texts.select("value", F.regexp_replace(F.col("_metadata.file_path"), DAY_IN_PATH, "$1-$2-$3").cast("date").alias("day"))
    # Objects become arrays of one, so that both forms are unfolded alike.
    hits = F.from_json(
        F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), "value", F.lit("]"))),
        T.ArrayType(T.VariantType()),
    )
    return texts.select("day", F.explode(hits).alias("hit")).filter(F.col("hit").isNotNull())


def unfolded(hits: DataFrame, member: str = "$._source") -> DataFrame:
    """A row per field of the member, with ``pos`` from 0; of a hit without fields one row without any."""
    sources = hits.select("day", F.try_variant_get("hit", member, "variant").alias("source"))
    return sources.lateralJoin(hits.sparkSession.tvf.variant_explode_outer(F.col("source").outer()))


def fields_found(hits: DataFrame, member: str = "$._source") -> DataFrame:
    """``day``, ``field``, ``found`` (the type as in the hits), in how many hits, and of how many it is the first; the member's
    own fields. Hits without any field are counted under none."""
    return unfolded(hits, member).groupBy("day", F.col("key").alias("field"), F.schema_of_variant("value").alias("found")).agg(
        F.count(F.lit(1)).alias("n_hits"), F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("n_first")
    )


def schema_drift(hits: DataFrame) -> DataFrame:
    """Per landing day what departs from the feed: ``day``, ``field``, ``drift``, ``found``, ``n_hits``.

    ``unknown`` fields with their type over all hits of the day (``schema_of_variant_agg`` merges them); declared fields that
    hits lack (``missing``); declared fields in another type than the feed's (``retyped``). Nulls are of no type.

    The hits are gone through once, here, and days with unknown fields a second time for the types of these.
    """
    spark = hits.sparkSession
    path, counted = scratch_dir(spark, "fields-found"), fields_found(hits)
    counted.write.parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)
    found = counted.filter(F.col("field").isNotNull())
    declared = spark.createDataFrame(list(EXPECTED.items()), "declared string, expected string")
    met = found.join(declared, F.col("field") == F.col("declared"), "left")
    retyped = met.filter((F.col("found") != F.col("expected")) & (F.col("found") != NO_TYPE)).select(
        "day", "field", F.lit(RETYPED).alias("drift"), "found", "n_hits"
    )
    unknown = found.join(declared, F.col("field") == F.col("declared"), "left_anti")
    days = [row["day"] for row in unknown.select("day").distinct().collect()]
    merged = unknown_types(hits.filter(reduce(lambda a, b: a | b, [F.col("day").eqNullSafe(F.lit(d)) for d in days], F.lit(False)))).join(
        unknown.groupBy("day", "field").agg(F.sum("n_hits").alias("n_hits")), ["day", "field"]
    ).select("day", "field", F.lit(UNKNOWN).alias("drift"), "found", "n_hits")
    totals = counted.groupBy("day").agg(F.sum("n_first").alias("n_all"))
    present = met.filter(F.col("declared").isNotNull()).groupBy("day", "field").agg(F.sum("n_hits").alias("n_present"))
    every = totals.crossJoin(F.broadcast(declared.select(F.col("declared").alias("field"))))
    lacking = every.join(present, ["day", "field"], "left").select(
        "day", "field", F.lit(MISSING).alias("drift"), F.lit(None).cast("string").alias("found"),
        (F.col("n_all") - F.coalesce("n_present", F.lit(0))).alias("n_hits"),
    )
    return retyped.unionByName(merged).unionByName(lacking.filter("n_hits > 0"))


def unknown_types(hits: DataFrame) -> DataFrame:
    """``day``, ``field`` and the one type that all its values of the day have room in, of fields the feed does not declare."""
    others = unfolded(hits).filter(F.col("key").isNotNull() & ~F.col("key").isin(*EXPECTED))
    return others.groupBy("day", F.col("key").alias("field")).agg(merged_type(F.col("value")).alias("found"))


def merged_type(value: Column) -> Column:
    return F.schema_of_variant_agg(value)
