"""Keyed merges as pure DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.operators.dedup import latest_per_key


def _same_key(key: Sequence[str]) -> Column:
    """Key equality in which null equals null, as it does when removing duplicates."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])


def _keys_of(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(k).alias(f"_{k}") for k in key))


def not_in(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose key does not occur in ``new``."""
    return old.join(_keys_of(new, key), _same_key(key), "left_anti")


def newest(old: DataFrame, new: DataFrame, key: Sequence[str], by: str) -> DataFrame:
    """The latest row by ``by`` of each key of ``new``, stored ones included; ties go to the smallest row.

    Of the stored side only rows with a key of the batch take part; a small batch is broadcast to find them.
    """
    met = old.join(_keys_of(new, key), _same_key(key), "left_semi")
    return latest_per_key(met.unionByName(new), key, by)


def filled_from(rows: DataFrame, others: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``rows`` with the values of the row of ``others`` with the same key where they have none in ``columns``."""
    taken = others.select(*(F.col(k).alias(f"_{k}") for k in key), *(F.col(c).alias(f"_other_{c}") for c in columns))
    met = rows.join(taken, _same_key(key), "left").withColumns({c: F.coalesce(c, f"_other_{c}") for c in columns})
    return met.select(*rows.columns)


def winners(
    old: DataFrame, new: DataFrame, key: Sequence[str], newer_by: str | None = None, keep_filled: Sequence[str] = ()
) -> DataFrame:
    """The row that each key of ``new`` has after a merge.

    In the columns ``keep_filled`` a value is not wiped by the lack of one: what the winning row lacks it takes from the other
    side. Both sides have one row per key.
    """
    rows = new if newer_by is None else newest(old, new, key, newer_by)
    if keep_filled:
        rows = filled_from(rows, old, key, keep_filled)
        if newer_by is not None:
            rows = filled_from(rows, new, key, keep_filled)
    return rows


def merge_frames(
    old: DataFrame, new: DataFrame, key: Sequence[str], newer_by: str | None = None, keep_filled: Sequence[str] = ()
) -> DataFrame:
    """Upsert: rows of ``new`` replace rows of ``old`` with the same key, others are added.

    A small batch is broadcast into the anti join, so the stored side is scanned but not shuffled. With ``newer_by`` the
    newer row stays, whichever side it is on: batches may arrive in any order, and again. ``keep_filled`` as in ``winners``.
    """
    return winners(old, new, key, newer_by, keep_filled).unionByName(not_in(old, new, key))


def known_among(stored: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of ``batch`` that are already stored.

    The semi join goes first, from the stored side: with a small batch only its
    keys travel, and what comes out is never larger than the batch's matches.
    """
    candidates = _keys_of(batch, key).distinct()
    return stored.select(*key).join(candidates, _same_key(key), "left_semi").distinct()
