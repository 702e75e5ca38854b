"""Row selection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from txvigil.schema import AT, CATEGORY, DAY, EVENT_DATE, STATE, STATUS


def filter_eligible(
    rows: DataFrame,
    categories: Sequence[str],
    statuses: Sequence[int] = (0,),
    states: Sequence[int] = (1,),
) -> DataFrame:
    """Successful transactions of the given categories."""
    return rows.filter(
        F.col(STATUS).isin(*statuses)
        & F.col(STATE).isin(*states)
        & F.col(CATEGORY).isin(*categories)
    )


def since(as_of: date, n_days: int, at: str = AT, warmup: timedelta = timedelta()) -> Column:
    """On or after the day ``n_days`` before ``as_of``: n_days + 1 calendar days in all.

    With ``warmup`` so much earlier.
    """
    midnight = datetime.combine(as_of - timedelta(days=n_days), time()) - warmup
    return F.col(at) >= F.lit(midnight.isoformat(sep=" ")).cast("timestamp_ntz")


def between_hours(first: int, last: int, at: str = AT) -> Column:
    """Hour of day from ``first`` to ``last``, both whole hours included."""
    return F.hour(at).between(first, last)


def filter_cutoff(
    rows: DataFrame, as_of: date, n_days: int, at: str = AT, warmup: timedelta = timedelta()
) -> DataFrame:
    """Rows of the lookback period and of the ``warmup`` before it, with their calendar day.

    Compares the timestamp itself, which reaches the Parquet statistics, and the partition
    column where the table has one.
    """
    kept = rows.filter(since(as_of, n_days, at, warmup))
    if EVENT_DATE in rows.columns:
        first = (datetime.combine(as_of - timedelta(days=n_days), time()) - warmup).date()
        kept = kept.filter(F.col(EVENT_DATE) >= F.lit(first))
    return kept.withColumn(DAY, F.to_date(at))


def filter_hours(rows: DataFrame, first: int, last: int, at: str = AT) -> DataFrame:
    return rows.filter(between_hours(first, last, at))
