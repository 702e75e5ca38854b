"""Trailing totals and bursts per account.

Cost does not depend on how dense an account is. A sliding range frame re-adds every row of
the frame for every row. Here a trailing total is the difference of two totals from the
beginning, of all that has come and of all that has passed; both only ever grow, so each row
is added twice, whatever the span: one sort, no frame to rescan, no pairs of rows.

Cost does not depend on how uneven the accounts are either: rows are grouped by account and
stretch of time, so a large account is as many groups as it has stretches. A stretch is
several spans long. Rows of the last span of a stretch are in the next one too, and those
soon after its end are seen by it, so that it knows the bursts that reach back into it. Only
these few rows are moved twice. There is one plan for all data, with one shuffle, one sort
and no joins, and nothing runs while it is built.

Times are turned into microseconds once, below the step that repeats rows: all above it
works on whole numbers, in methods short enough to be compiled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from txvigil.functions import checked_cast, epoch_us
from txvigil.operators.deltas import per_key
from txvigil.schema import ACCOUNT, AMOUNT, AT, MONEY, REF

_TICK = timedelta(microseconds=1)
# Stretches of this many spans repeat few rows at their edges and still cut a large account.
_SPANS = 8
_SHORTEST = timedelta(hours=1)
_STRETCH, _START, _TIME, _OWN = "_stretch", "_start", "_time", "_at_home"

# Sums of cents are kept as two whole numbers, multiples of this and the rest.
_LIMB_BITS = 30
_LIMB = 1 << _LIMB_BITS
_SUM = "decimal(28,2)"


@dataclass(frozen=True)
class Total:
    """Sum of ``value`` over the rows of the account in the trailing ``span``.

    The left edge is part of the window only if ``left_closed``; rows at the current
    time all are. With ``in_cents`` the value is a whole number of cents and the sum an
    exact decimal.
    """

    name: str
    span: timedelta
    value: Column
    left_closed: bool
    in_cents: bool = False

    @property
    def expiry(self) -> timedelta:
        return self.span + _TICK if self.left_closed else self.span


@dataclass(frozen=True)
class Burst:
    """End of the earliest burst around a row, null outside bursts.

    A burst ends where ``total`` reaches ``at_least`` and covers the ``span`` before it,
    both edges included. Rows that add nothing to ``total`` take no part.
    """

    name: str
    total: str
    at_least: int
    span: timedelta


def money(amount: str = AMOUNT) -> Column:
    """Amount as an exact decimal, nothing where missing."""
    return F.coalesce(checked_cast(F.col(amount), MONEY, amount), F.lit(0).cast(MONEY))


def cents(amount: str = AMOUNT) -> Column:
    """The same as a whole number of cents.

    A double that is the nearest one to so many cents, of no more than 15 digits, stands for
    just these; any other amount takes the way over decimals.
    """
    value = F.col(amount).try_cast("double")
    near = F.rint(value * 100)
    plain = (F.abs(near) < 1e15) & (near / 100 == value)
    exact = (checked_cast(F.col(amount), MONEY, amount) * 100).cast("long")
    return F.coalesce(F.when(plain, near.cast("long")).otherwise(exact), F.lit(0).cast("long"))


def in_money(high: Column, low: Column) -> Column:
    """The decimal for a sum of cents in two parts; beyond a bigint by decimal arithmetic."""
    short = F.abs(high) < 1 << 32
    short = short & (F.abs(low) < 1 << 62)
    long = high.cast("decimal(20,0)") * _LIMB + low.cast("decimal(20,0)")
    whole = F.when(short, (high * _LIMB + low).cast("decimal(28,0)"))
    return (whole.otherwise(long.cast("decimal(28,0)")) * Decimal("0.01")).cast(_SUM)


def placed(rows: DataFrame, account: str = ACCOUNT, at: str = AT) -> DataFrame:
    """Rows that belong to an account and a time."""
    return rows.filter(F.col(account).isNotNull() & F.col(at).isNotNull())


def trailing(
    rows: DataFrame,
    totals: Sequence[Total],
    bursts: Sequence[Burst] = (),
    account: str = ACCOUNT,
    at: str = AT,
    stretch: timedelta | None = None,
) -> DataFrame:
    """Rows with an account and a time, plus one column per total and per burst.

    ``stretch`` changes how rows are grouped, not the result; no span may be longer.
    """
    made = [in_money(*parts(t.name)).alias(t.name) if t.in_cents else F.col(t.name) for t in totals]
    keep = [F.col(c) for c in [*rows.columns, *[b.name for b in bursts]]]
    order = len(rows.columns)
    rolled = trailing_parts(rows, totals, bursts, account, at, stretch)
    return rolled.select(*keep[:order], *made, *keep[order:])


def trailing_parts(
    rows: DataFrame,
    totals: Sequence[Total],
    bursts: Sequence[Burst] = (),
    account: str = ACCOUNT,
    at: str = AT,
    stretch: timedelta | None = None,
) -> DataFrame:
    """The same with totals in cents as their two ``parts``, which can be added up further."""
    longest = max([t.expiry for t in totals] + [b.span for b in bursts])
    stretch = stretch or max(_SPANS * longest, _SHORTEST)
    if stretch < longest:
        raise ValueError(f"a stretch of {stretch} is shorter than {longest}")
    summed = {}
    for total in totals:
        if total.in_cents:
            high, low = (f"_{part}_{total.name}" for part in ("high", "low"))
            summed |= {high: (total, _own(high)), low: (total, _own(low))}
        else:
            summed[total.name] = (total, _own(total.name))
    keep = [*rows.columns, *summed]
    group = Window.partitionBy(account, _STRETCH).orderBy(_TIME)

    def still_there(total: Total, own: str) -> Column:
        come = F.sum(own).over(group.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        passed = group.rangeBetween(Window.unboundedPreceding, -_us(total.expiry))
        gone = F.sum(own).over(passed)
        return come - F.coalesce(gone, F.lit(0))

    spread = _spread(rows, totals, bursts, account, at, stretch)
    rolled = spread.withColumns({name: still_there(*which) for name, which in summed.items()})
    rolled = rolled.withColumns({_end(b.name): _ending(b, at) for b in bursts})
    # The next end of a burst in the same order, so that nothing is sorted again.
    following = f"OVER (PARTITION BY `{account}`, {_STRETCH} ORDER BY {_TIME})"
    rolled = rolled.withColumns(
        {_next(b.name): F.expr(f"lead(`{_end(b.name)}`, 1) IGNORE NULLS {following}") for b in bursts}
    )
    covering = [_covering(b, at).alias(b.name) for b in bursts]
    return rolled.filter(_OWN).select(*keep, *covering)


def parts(total: str) -> tuple[Column, Column]:
    return F.col(f"_high_{total}"), F.col(f"_low_{total}")


def _own(total: str) -> str:
    return f"_own_{total}"


def _end(burst: str) -> str:
    return f"_end_{burst}"


def _next(burst: str) -> str:
    return f"_next_{burst}"


def _covering(burst: Burst, at: str) -> Column:
    end = F.coalesce(_end(burst.name), _next(burst.name))
    return F.when((F.col(_own(burst.total)) > 0) & (end - burst.span <= F.col(at)), end)


def _ending(burst: Burst, at: str) -> Column:
    reached = F.col(burst.total) >= burst.at_least
    return F.when((F.col(_own(burst.total)) > 0) & reached, F.col(at))


def _us(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _spread(
    rows: DataFrame,
    totals: Sequence[Total],
    bursts: Sequence[Burst],
    account: str,
    at: str,
    stretch: timedelta,
) -> DataFrame:
    """Every row in its own stretch and, with no other columns, in those that need it too.

    That is the following one if the row still counts when it begins, and the one before if a
    burst that ends here can reach back into it.
    """
    own = {}
    for total in totals:
        if total.in_cents:
            own[_own(f"_high_{total.name}")] = F.shiftright(total.value, _LIMB_BITS)
            own[_own(f"_low_{total.name}")] = total.value.bitwiseAND(F.lit(_LIMB - 1).cast("long"))
        else:
            own[_own(total.name)] = total.value
    expiry = _us(max(t.expiry for t in totals))
    ahead = max((_us(b.span) for b in bursts), default=0)
    length, time, start = _us(stretch), F.col(_TIME), F.col(_START)
    payload = [c for c in rows.columns if c not in (account, at)]

    timed = placed(rows, account, at).withColumn(_TIME, epoch_us(F.col(at)))
    timed = timed.withColumns({**own, _START: time - F.pmod(time, F.lit(length))})
    places = [start, F.when(time + expiry > start + length, start + length)]
    if bursts:
        places.append(F.when(time < start + ahead, start - length))
    spread = timed.select("*", F.explode(F.array(*places)).alias(_STRETCH))
    spread = spread.filter(F.col(_STRETCH).isNotNull())
    spread = spread.withColumn(_OWN, F.col(_STRETCH) == start).drop(_START)
    return spread.withColumns({c: F.when(F.col(_OWN), F.col(c)) for c in payload})


def rolling_count(rows: DataFrame, span: timedelta, **options) -> DataFrame:
    """Adds the number of rows of the account in (t - span, t], null without account or time."""
    counted = trailing(rows, [Total("rolling_count", span, F.lit(1), False)], **options)
    unplaced = rows.filter(F.col(ACCOUNT).isNull() | F.col(AT).isNull())
    return counted.unionByName(unplaced.withColumn("rolling_count", F.lit(None).cast("long")))


def rolling_sum(rows: DataFrame, span: timedelta, **options) -> DataFrame:
    """Adds the amount of the account in [t - span, t]."""
    return trailing(rows, [Total("rolling_sum", span, cents(), True, in_cents=True)], **options)


def burst_rows(rows: DataFrame, span: timedelta, at_least: int, **options) -> DataFrame:
    """Rows inside a burst, with their count and the bounds of the earliest such burst.

    Being in a burst depends on account and time alone, so only these are grouped; the rows
    themselves are moved once, to be joined with the few that are found.
    """
    counted = trailing(
        rows.select(ACCOUNT, AT),
        [Total("rolling_count", span, F.lit(1), False)],
        [Burst("transaction_date_right", "rolling_count", at_least, span)],
        **options,
    )
    end = F.col("transaction_date_right")
    inside = per_key(
        counted.filter(end.isNotNull()),
        [ACCOUNT, AT],
        *[F.max(c).alias(c) for c in ("rolling_count", "transaction_date_right")],
    )
    found = rows.join(inside, [ACCOUNT, AT]).withColumn("t_start", end - span)
    return found.select(*rows.columns, "rolling_count", "transaction_date_right", "t_start")


def sum_by_ref(
    rows: DataFrame, span: timedelta, counted: Column | None = None, **options
) -> DataFrame:
    """Trailing amounts per reference number; those of a repeated number add up.

    Rows that are not ``counted`` are only in the totals of others.
    """
    total = Total("rolling_sum", span, cents(), True, in_cents=True)
    summed = trailing_parts(rows.select(AT, ACCOUNT, REF, AMOUNT), [total], **options)
    keyed = summed.filter(F.col(REF).isNotNull() & (F.lit(True) if counted is None else counted))
    high, low = (F.sum(part) for part in parts("rolling_sum"))
    return per_key(keyed, [REF], in_money(high, low).alias("rolling_sum"))
