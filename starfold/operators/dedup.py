"""One row per key, with a survivor that does not depend on row order or partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def one_per_key(
    df: DataFrame,
    keys: Sequence[str],
    lead: Sequence[str] = (),
    filled: Sequence[str] = (),
    few: bool = False,
) -> DataFrame:
    """Keep the smallest remaining row of each key, nulls first.

    ``lead`` columns are compared first; rows with a value in a ``filled``
    column win over rows without one. Both forms reduce each task's rows to one
    per key before the shuffle, so a hot key costs one row per task.

    ``few``: set it when the rows repeat a lot (small dimensions). Equal rows are
    then first removed by hashing, and only what is left needs the sort that a
    minimum over whole rows implies.
    """
    rest = [*lead, *(c for c in df.columns if c not in keys and c not in lead)]
    if not rest:
        return df.select(*keys).distinct()
    rows = _distinct(df) if few else df
    order = [F.col(c).isNull().alias(f"_no_{c}") for c in filled] + [F.col(c) for c in rest]
    survivor = rows.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_row"))
    return survivor.select(*(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns))


def _distinct(df: DataFrame) -> DataFrame:
    """Equal rows removed for good: Spark takes a plain ``distinct`` below a minimum for redundant and drops it."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 0).drop("_n")


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Keep the row with the latest ``by`` of each key; ties go to the smallest row.

    The rank filter lets Spark cut each task to one row per key before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c != by]
    order = [F.col(by).desc_nulls_last(), *(F.col(c).asc_nulls_first() for c in rest)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
