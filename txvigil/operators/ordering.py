"""Sorting and slices of sorted tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

from txvigil.schema import ACCOUNT, AT, REF


def sort_history(rows: DataFrame) -> DataFrame:
    """Whole table in order of time, then account: a range shuffle, no single task."""
    return rows.orderBy(AT, ACCOUNT)


def latest(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` latest rows."""
    return rows.orderBy(F.desc(AT), REF).limit(n)


def page(rows: DataFrame, offset: int, length: int) -> DataFrame:
    """``length`` rows from position ``offset`` of the table in order of time.

    Rows are counted per day and then, of the days with the page, per minute; the sums of
    these counts say where the page begins. Only the rows of its minutes are sorted, whatever
    the offset. The counts are taken while the plan is built.
    """
    for unit in ("day", "minute"):
        rows, offset = _narrowed(rows, offset, length, unit)
    return rows.orderBy(AT, REF).offset(offset).limit(length)


def _narrowed(rows: DataFrame, offset: int, length: int, unit: str) -> tuple[DataFrame, int]:
    """The rows of the units of time that hold the page, and its position in them."""
    counts = rows.groupBy(F.date_trunc(unit, AT).alias("unit")).agg(F.count("*").alias("n"))
    upto = Window.orderBy("unit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("upto", F.sum("n").over(upto))
    held = placed.filter((F.col("upto") > offset) & (F.col("upto") - F.col("n") < offset + length))
    # Rows without a time come first, as they are sorted.
    first, last, none, before = held.agg(
        F.min("unit"), F.max("unit"), F.max(F.col("unit").isNull()), F.min(F.col("upto") - F.col("n"))
    ).first()
    if before is None:
        return rows.filter(F.lit(False)), 0
    chosen = F.col(AT).isNull() if none else F.lit(False)
    if first is not None:
        step = {"day": timedelta(days=1), "minute": timedelta(minutes=1)}[unit]
        low, high = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (first, last + step))
        chosen = chosen | ((F.col(AT) >= low) & (F.col(AT) < high))
    return rows.filter(chosen), offset - before
