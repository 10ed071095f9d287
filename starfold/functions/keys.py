"""Hash surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(columns: Sequence[str], null_safe: bool = False) -> Column:
    """64-bit key of a natural key.

    The hash skips nulls, so (null, 5) and (5, null) share a key by default, as
    published. ``null_safe`` adds the null pattern to the hash input.
    """
    parts = [F.col(c) for c in columns]
    if null_safe:
        parts += [F.col(c).isNull() for c in columns]
    return F.xxhash64(*parts)


def all_present(columns: Sequence[str]) -> Column:
    """True where no part of the key is null."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
