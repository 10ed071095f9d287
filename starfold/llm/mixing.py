"""Mixing sources to target weights with exact budgets.

Every document gets a hash-random key. Within its source the keys are sorted by range: the key's first digits name one
of a fixed number of equal ranges, each range is sorted on its own, and the ranges' totals give the word count at which
each range starts. Each document thus knows the words before it in its source. The source's target is a number of whole
epochs and a rest; the documents before the rest's cut are taken once more, the one at the cut as far as the cut.

A null source is a source, last in order. A null text has no words and is taken never. Keys hash the document id, ties go
by size; equal rows are interchangeable. Reruns and other partitionings give the same mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.recovery import written

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]"
# Hexadecimal digits of the key that name its range: 4096 ranges a source.
RANGE_DIGITS = 3
MOST_EPOCHS = 3


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size", cap: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: ``source``, ``source_size`` and ``target``.

    Sources in code point order weigh 1, 2, 3, 1, 2, 3, ... and share all words; none gets more than ``cap`` times its
    own, and what is cut off is shared by weight among the others. Sources are few beside documents: their totals are
    ordered in one task.
    """
    totals = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    weighed = totals.selectExpr(
        "source", "source_size", "(row_number() over (order by source nulls last) - 1) % 3 + 1 as weight"
    )
    # Sources fill up in the order of cap per weight; the first that does not fill sets the share per weight of the rest.
    filling = weighed.selectExpr(
        "*", f"{cap} * source_size / weight as fills_at", f"{cap} * source_size as most", "sum(source_size) over () as words"
    ).selectExpr(
        "*",
        "coalesce(sum(most) over (order by fills_at, source rows between unbounded preceding and 1 preceding), 0) as gone",
        "sum(weight) over (order by fills_at desc, source desc) as weight_left",
    )
    shared = filling.selectExpr("*", "(words - gone) / weight_left as share").selectExpr(
        "*", "max(case when share <= fills_at then share end) over () as level"
    )
    return shared.selectExpr(
        "source", "source_size", "case when fills_at <= level then cast(most as double) else level * weight end as target"
    )


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size", cap: int = MOST_EPOCHS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """What the mix takes of each row: ``key``, ``source``, ``size``, ``source_size``, ``target``, ``taken``.

    ``docs`` holds the three columns; of others those to ``carry`` stay, the rest is left behind. ``taken`` counts words over all epochs; a source's sum is
    its target rounded down.
    """
    rows = docs.select(
        F.col(key).alias("__key"), F.col(source).alias("__source"), F.col(size).cast("long").alias("__size"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("__at"), *carry,
    ).withColumn("__range", F.substring("__at", 1, RANGE_DIGITS))
    # Three passes follow; written once, the sizes are not counted from the texts each time.
    rows = written(rows, "mix-sizes")
    targets = source_targets(rows, "__source", "__size", cap)
    ranges = rows.groupBy("__source", "__range").agg(F.sum("__size").alias("__total"))
    starts = ranges.select(
        F.col("__source").alias("__s"), F.col("__range").alias("__r"),
        F.expr("sum(__total) over (partition by __source order by __range) - __total").alias("__start"),
    ).join(targets, F.col("__s").eqNullSafe(F.col("source")))
    inside = rows.withColumn(
        "__before",
        F.expr("""sum(__size) over (partition by __source, __range order by __at, __key, __size
                  rows between unbounded preceding and current row) - __size"""),
    )
    placed = inside.join(starts, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__range") == F.col("__r")))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    last = F.least(F.greatest(rest - (F.col("__start") + F.col("__before")), F.lit(0)), F.col("__size"))
    return placed.select(
        F.col("__key").alias(key), F.col("__source").alias(source), F.col("__size").alias(size),
        "source_size", "target", *carry, (epochs * F.col("__size") + last).cast("long").alias("taken"),
    )


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its ``words``-th word, of texts with more words than that."""
    # A leading gap makes an empty first piece; the last piece is what follows the gap after the last word wanted.
    pieces = words + F.when(text.rlike(f"^{GAP}"), 2).otherwise(1)
    rest = F.element_at(F.split(text, f"{GAP}+", pieces.cast("int")), -1)
    return F.rtrim(F.substring(text, F.lit(1), F.char_length(text) - F.char_length(rest)), F.lit(" \t\n\x0b\x0c\r"))
