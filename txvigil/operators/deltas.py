"""Comparing two tables on the reference number and putting them together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from txvigil.schema import REF

_HASH = "_hash"


def per_key(rows: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregates per key, combined before the shuffle, for joins to rows with uneven keys.

    Adaptive execution splits the large partition of a hot or null key on the left of a
    join only if both sides come straight from a shuffle. A result clustered by just the
    join keys would be joined as it is; the hash beside them makes Spark shuffle these few
    columns once more, and the split possible.
    """
    grouped = rows.groupBy(*keys, F.xxhash64(*keys).alias(_HASH))
    return grouped.agg(*aggregates).drop(_HASH)


def known_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Distinct non-null keys, like ``per_key``."""
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    return rows.select(*keys, F.xxhash64(*keys).alias(_HASH)).distinct().drop(_HASH)


def rows_not_in(rows: DataFrame, other: DataFrame, key: str = REF) -> DataFrame:
    """Rows whose key the other table lacks. A null key is never found, so its row stays."""
    return rows.join(known_keys(other, key), key, "left_anti").select(rows.columns)


def new_keys(unique: DataFrame, other: DataFrame, key: str = REF) -> DataFrame:
    """The same for rows with a unique key, of which there are few beside the other table.

    Only keys of the other table that the rows have as well are kept before anything is
    compared, so a large table is filtered while it is scanned (by broadcast or a run-time
    filter) instead of being shuffled and made distinct.
    """
    known = other.select(key).join(unique.select(key), key, "left_semi")
    return unique.join(known, key, "left_anti").select(unique.columns)


def delta_new(daily: DataFrame, history: DataFrame, key: str = REF) -> DataFrame:
    """Daily rows the history does not have yet."""
    return rows_not_in(daily, history, key)


def delta_old(daily: DataFrame, history: DataFrame, key: str = REF) -> DataFrame:
    """History rows the daily data does not have."""
    return rows_not_in(history, daily, key)


def append_delta(history: DataFrame, delta: DataFrame) -> DataFrame:
    """All rows of both; columns are matched by name and must be the same."""
    return history.unionByName(delta)


def symmetric_difference(daily: DataFrame, history: DataFrame, key: str = REF) -> DataFrame:
    """Rows of either table whose key the other one lacks."""
    return append_delta(delta_new(daily, history, key), delta_old(daily, history, key))
