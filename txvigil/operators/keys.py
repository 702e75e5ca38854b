"""Distinct keys, duplicates and merges per key.

Everything here is combined on the map side, so a key that repeats any number of times
reaches its reducer as a few rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from txvigil.operators.deltas import known_keys, per_key
from txvigil.schema import ACCOUNT, REF


def dedupe(rows: DataFrame, key: str = REF, first_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by the given columns, then by all others.

    Null keys count as equal. Spark limits each map task to its first row per key before
    the shuffle (WindowGroupLimit).
    """
    order = [*first_by, *[c for c in rows.columns if c != key and c not in first_by]]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def distinct_keys(rows: DataFrame, keys: Sequence[str] = (ACCOUNT, REF)) -> DataFrame:
    return rows.select(*keys).distinct()


def semi_by_keys(
    rows: DataFrame, keyed: DataFrame, keys: Sequence[str] = (ACCOUNT, REF)
) -> DataFrame:
    """Rows whose keys occur in the other table."""
    return rows.join(known_keys(keyed, *keys), list(keys), "left_semi").select(rows.columns)


def find_duplicates(rows: DataFrame, keys: Sequence[str] = (REF,)) -> DataFrame:
    """Rows whose keys occur more than once, null keys among them."""
    counts = per_key(rows, keys, F.count("*").alias("_n")).withColumnsRenamed(
        {k: f"_{k}" for k in keys}
    )
    repeated = counts.filter(F.col("_n") > 1)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(repeated, same, "left_semi")


def merge_by_max(rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per key the largest value of every column, nulls aside."""
    return rows.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])
