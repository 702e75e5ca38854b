"""Flag columns: presence, type and merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from txvigil.operators.deltas import known_keys
from txvigil.operators.keys import semi_by_keys
from txvigil.schema import ACCOUNT, FLAG, FLAG_TYPE, REF


def add_missing_flags(rows: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Adds the flags the table lacks, as 0."""
    missing = [f for f in flags if f not in rows.columns]
    return rows.withColumns({f: F.lit(0).cast(FLAG_TYPE) for f in missing})


def normalise_flags(rows: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Turns Boolean flags into 0/1."""
    boolean = [f for f in flags if f in rows.columns and rows.schema[f].dataType == T.BooleanType()]
    return rows.withColumns({f: F.col(f).cast(FLAG_TYPE) for f in boolean})


def fill_flags(rows: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Takes a flag that is null, as where a part of a table lacks the column, for 0."""
    return rows.withColumns({f: F.coalesce(f, F.lit(0)).cast(FLAG_TYPE) for f in flags})


def set_flag(rows: DataFrame, flag: str = FLAG) -> DataFrame:
    """Adds or replaces the flag by 1."""
    return rows.withColumn(flag, F.lit(1).cast(FLAG_TYPE))


def mark_by_keys(
    rows: DataFrame, keyed: DataFrame, flag: str, keys: Sequence[str] = (ACCOUNT, REF)
) -> DataFrame:
    """Sets the flag to 1 where the keys occur in the other table and keeps it elsewhere."""
    return merge_flags(rows, set_flag(known_keys(keyed, *keys), flag), [flag], keys)


def merge_flags(
    history: DataFrame, hits: DataFrame, flags: Sequence[str], keys: Sequence[str] = (REF,)
) -> DataFrame:
    """Sets every flag that is 1 in ``hits``; a flag that is set stays set.

    ``hits`` holds the keys, unique, and one column per flag. All flags of a family are
    merged in this one join.
    """
    named = hits.select(*keys, *[F.col(f).alias(f"_hit_{f}") for f in flags])
    merged = {
        f: F.when(F.col(f"_hit_{f}") == 1, 1).otherwise(F.col(f)).cast(FLAG_TYPE) for f in flags
    }
    return history.join(named, list(keys), "left").withColumns(merged).select(history.columns)


def unflagged(history: DataFrame, refs: DataFrame, flag: str, key: str = REF) -> DataFrame:
    """History rows that the reference numbers would newly flag."""
    return semi_by_keys(history.filter(F.col(flag) == 0), refs, [key])


def unflagged_count(history: DataFrame, refs: DataFrame, flag: str, key: str = REF) -> DataFrame:
    return unflagged(history, refs, flag, key).agg(F.count("*").alias("unflagged"))


def all_flagged(history: DataFrame, refs: DataFrame, flag: str, key: str = REF) -> DataFrame:
    """Whether every history row of the reference numbers has the flag; true if there is none."""
    return semi_by_keys(history, refs, [key]).agg(
        F.coalesce(F.bool_and(F.col(flag) == 1), F.lit(True)).alias("all_flagged")
    )
