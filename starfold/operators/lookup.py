"""Surrogate-key lookups against dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.functions.keys import all_present, surrogate_key
from starfold.operators.dedup import one_per_key

# Into how many parts rows with a null key part are dealt where they may match.
SALTS = 64


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    surrogate: str,
    role: str | None = None,
    null_safe: bool = False,
    unique: bool = True,
    spread: str | None = None,
) -> DataFrame:
    """Add the surrogate key of the matching dimension row, null if there is none.

    ``on`` maps columns of ``df`` to key columns of ``dim``; ``role`` names the
    added column, so one dimension can be looked up several times. With
    ``unique=False`` the dimension is first reduced to one row per looked-up key,
    so that a lookup never multiplies rows.

    No side is forced into a broadcast: Spark broadcasts the dimension while its
    size is below the session threshold and shuffles beyond it. For a dimension
    expected beyond it, ``spread`` names a well-spread column of ``df``: rows with
    a null key part are then dealt out by it instead of meeting in one task. With
    ``null_safe`` they may match, so the few dimension rows with a null part are
    repeated for every salt. A hot key that is not null is split by adaptive
    execution.
    """
    role = role or surrogate
    left_keys, right_keys = list(on), [f"_k{n}" for n, _ in enumerate(on)]
    side = dim.select(
        *(F.col(c).alias(k) for c, k in zip(on.values(), right_keys)), F.col(surrogate).alias(role)
    )
    if not unique:
        side = one_per_key(side, right_keys, few=True)

    condition = F.lit(True)
    for left, right in zip(left_keys, right_keys):
        same = F.col(left).eqNullSafe(F.col(right)) if null_safe else F.col(left) == F.col(right)
        condition = same if left == left_keys[0] else condition & same

    if spread:
        dealt = F.xxhash64(spread) if not null_safe else F.pmod(F.xxhash64(spread), F.lit(SALTS))
        df = df.withColumn("_deal", F.when(all_present(left_keys), surrogate_key(left_keys)).otherwise(dealt))
        side = side.withColumn("_dealt", surrogate_key(right_keys))
        if null_safe:
            salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
            places = F.when(all_present(right_keys), F.array("_dealt")).otherwise(salts)
            side = side.withColumn("_dealt", F.explode(places))
        condition = (F.col("_deal") == F.col("_dealt")) & condition
    return df.join(side, condition, "left").drop(*right_keys, "_deal", "_dealt")


def derive(df: DataFrame, keys: list[str], role: str, null_safe: bool = False) -> DataFrame:
    """Add the surrogate key without reading the dimension.

    Equal to ``lookup`` when the dimension is known to hold every key of ``df``:
    the key is then a pure function of the row. Without ``null_safe`` a key with
    a null part finds nothing, as in the join.
    """
    key = surrogate_key(keys, null_safe)
    return df.withColumn(role, key if null_safe else F.when(all_present(keys), key))
