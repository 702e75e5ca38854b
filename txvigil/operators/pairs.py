"""What stands behind a flag: the bursts that cover a row, the amounts that a sum is made of.

Both are joins on account and a range of time, from the flagged rows only. Time is cut into
buckets of a few spans, so that a row meets just the rows of its account in its own and, near its
start, in the bucket before: no account is compared with itself as a whole, and a large account is as
many keys as it has buckets. The result is as large as the pairs that exist, for flagged rows.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from txvigil.functions import epoch_us
from txvigil.operators.deltas import per_key
from txvigil.operators.rolling import Burst, Total, placed, sum_by_ref, trailing
from txvigil.schema import ACCOUNT, AMOUNT, AT, REF

_BUCKET, _US = "_bucket", "_us"
# A bucket is so many spans long: one in so many rows is in two.
_SPANS = 4
RIGHT = "transaction_date_right"


def _bucketed(rows: DataFrame, at: str, span: timedelta, back: bool = False) -> DataFrame:
    """Rows with their time in microseconds, in their bucket and, ``back``, in the one before if the span reaches it."""
    reach = span // timedelta(microseconds=1)
    length = _SPANS * reach
    timed = rows.withColumn(_US, epoch_us(F.col(at)))
    bucket = F.col(_US) - F.pmod(_US, F.lit(length))
    if not back:
        return timed.withColumn(_BUCKET, bucket)
    places = F.array(bucket, F.when(F.col(_US) - reach < bucket, bucket - length))
    return timed.select("*", F.explode(places).alias(_BUCKET)).filter(F.col(_BUCKET).isNotNull())


def burst_pairs(rows: DataFrame, span: timedelta, at_least: int, **options) -> DataFrame:
    """Every row of a burst once per burst that covers it, with its count and the burst's bounds.

    A burst ends at a time at which the account has ``at_least`` rows in the span before;
    equal times are one end. Only account and time are compared; the rows themselves are moved
    once, to be joined with what is found.
    """
    counted = trailing(
        rows.select(ACCOUNT, AT),
        [Total("rolling_count", span, F.lit(1), False)],
        [Burst(RIGHT, "rolling_count", at_least, span)],
        **options,
    ).filter(F.col(RIGHT).isNotNull())
    times = per_key(counted, [ACCOUNT, AT], F.max("rolling_count").alias("rolling_count"))
    ends = times.filter(F.col("rolling_count") >= at_least).select(ACCOUNT, F.col(AT).alias(RIGHT))
    # An end reaches back into its own bucket and perhaps the one before.
    ends = _bucketed(ends, RIGHT, span, back=True).withColumnRenamed(_US, "_end")
    covered = _bucketed(times, AT, span).join(ends, [ACCOUNT, _BUCKET])
    length = span // timedelta(microseconds=1)
    covered = covered.filter(F.col("_end").between(F.col(_US), F.col(_US) + length))
    covered = covered.select(ACCOUNT, AT, "rolling_count", RIGHT)
    found = rows.join(covered, [ACCOUNT, AT]).withColumn("t_start", F.col(RIGHT) - span)
    return found.select(*rows.columns, "rolling_count", RIGHT, "t_start")


def contributors(
    rows: DataFrame, span: timedelta, at_least: float, counted: Column | None = None, **options
) -> DataFrame:
    """Per transaction with a flagged number the transactions that its sum is made of.

    A number is flagged if the trailing amounts of its ``counted`` transactions reach
    ``at_least`` together; ``rolling_sum`` is that amount. The contributors are those of the
    account from ``span`` before up to the transaction's time, itself among them, in columns
    that end in ``_r``.
    """
    sums = sum_by_ref(rows, span, counted, **options).filter(F.col("rolling_sum") >= at_least)
    narrow = placed(rows).select(REF, ACCOUNT, AT, AMOUNT)
    chosen = placed(rows).filter(F.lit(True) if counted is None else counted)
    flagged = chosen.select(REF, ACCOUNT, AT, AMOUNT).join(sums, REF)
    # A row looks back into its own bucket and perhaps the one before.
    flagged = _bucketed(flagged, AT, span, back=True)
    added = _bucketed(narrow, AT, span).withColumnRenamed(_US, "_then")
    added = added.withColumnsRenamed({c: f"{c}_r" for c in (REF, AT, AMOUNT)})
    length = span // timedelta(microseconds=1)
    found = flagged.join(added, [ACCOUNT, _BUCKET])
    found = found.filter(F.col("_then").between(F.col(_US) - length, F.col(_US)))
    return found.select(
        REF, ACCOUNT, AT, AMOUNT, "rolling_sum", f"{REF}_r", f"{AT}_r", f"{AMOUNT}_r"
    )
