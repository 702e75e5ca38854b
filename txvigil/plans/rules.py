"""The two rule shapes and their evaluation over a history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from txvigil.operators.deltas import per_key
from txvigil.operators.filters import between_hours, filter_cutoff, filter_hours, since
from txvigil.operators.flags import set_flag
from txvigil.operators.keys import dedupe
from txvigil.operators.rolling import (
    Burst,
    Total,
    burst_rows,
    cents,
    in_money,
    parts,
    placed,
    sum_by_ref,
    trailing_parts,
)
from txvigil.schema import ACCOUNT, AMOUNT, AT, DAY, EVENT_DATE, FLAG_TYPE, REF


@dataclass(frozen=True)
class Rule:
    """``lookback`` None takes the whole history; ``hours`` None takes the whole day."""

    name: str
    flag: str
    span: timedelta
    at_least: float
    lookback: int | None = None
    hours: tuple[int, int] | None = None

    def select(
        self, history: DataFrame, as_of: date, warmup: timedelta = timedelta()
    ) -> DataFrame:
        rows = history
        if self.lookback is not None:
            rows = filter_cutoff(rows, as_of, self.lookback, warmup=warmup)
        if self.hours is not None:
            rows = filter_hours(rows, *self.hours)
        return rows

    def selects(self, as_of: date) -> Column:
        """The same choice as a condition on a row."""
        chosen = F.lit(True)
        if self.lookback is not None:
            chosen = chosen & since(as_of, self.lookback)
        if self.hours is not None:
            chosen = chosen & between_hours(*self.hours)
        return chosen


@dataclass(frozen=True)
class BurstRule(Rule):
    """Flags every transaction of a burst: ``at_least`` of one account within ``span``."""


@dataclass(frozen=True)
class SumRule(Rule):
    """Flags a transaction that finds ``at_least`` of its account's amount in the last ``span``.

    The amounts count per reference number: if a number repeats, those of its transactions
    add up. Transactions without account or time are never flagged.
    """


def evaluate(
    rule: Rule,
    history: DataFrame,
    as_of: date,
    flags: Sequence[str] = (),
    warmup: bool = False,
) -> DataFrame:
    """The flagged transactions, without the history's own ``flags``.

    An empty result has the same columns and types as any other. With ``warmup`` the span
    before the lookback is read too, so that its first rows see a whole window; rows of that
    time are never flagged themselves.
    """
    early = rule.span if warmup else timedelta()
    rows = rule.select(history, as_of, early).drop(*flags, EVENT_DATE)
    counted = F.lit(True) if rule.lookback is None else since(as_of, rule.lookback)
    if isinstance(rule, BurstRule):
        inside = burst_rows(rows, rule.span, rule.at_least).filter(counted)
        return set_flag(dedupe(inside, REF, [AT, "transaction_date_right"]))
    sums = sum_by_ref(rows, rule.span, counted)
    above = sums.filter(F.col("rolling_sum") >= rule.at_least).select(REF)
    found = placed(rows).filter(counted).join(above, REF, "left_semi")
    return set_flag(found.select(rows.columns))


def _rolled(rules: Sequence[Rule], history: DataFrame, as_of: date) -> DataFrame:
    """Transactions with the totals and bursts of all rules, from one scan and one shuffle.

    Only the columns that rules need are moved: a row outside a rule's period or hours adds
    nothing to that rule's total.
    """
    lookbacks = [rule.lookback for rule in rules]
    if None not in lookbacks:
        history = filter_cutoff(history, as_of, max(lookbacks))
    columns, totals, bursts = [AT, ACCOUNT, REF], [], []
    for rule in rules:
        chosen = rule.selects(as_of)
        if isinstance(rule, BurstRule):
            value = F.when(chosen, 1).otherwise(0)
            totals.append(Total(_total(rule), rule.span, value, False))
            bursts.append(Burst(_burst(rule), _total(rule), rule.at_least, rule.span))
        else:
            amount = F.when(chosen, cents()).otherwise(F.lit(0).cast("long"))
            totals.append(Total(_total(rule), rule.span, amount, True, in_cents=True))
    if any(isinstance(rule, SumRule) for rule in rules):
        columns.append(AMOUNT)
    return trailing_parts(history.select(columns), totals, bursts)


def _total(rule: Rule) -> str:
    return f"total_{rule.flag}"


def _burst(rule: Rule) -> str:
    return f"burst_{rule.flag}"


def _reached(rule: Rule, as_of: date, within: Column | None, over: Window | None = None) -> Column:
    """Whether the transactions of a number, or of a window, reach the rule's threshold."""
    if isinstance(rule, BurstRule):
        hit = F.max(F.col(_burst(rule)).isNotNull())
        hit = hit if over is None else hit.over(over)
    else:
        counted = rule.selects(as_of) if within is None else rule.selects(as_of) & within
        sums = [F.sum(F.when(counted, part)) for part in parts(_total(rule))]
        hit = in_money(*[s if over is None else s.over(over) for s in sums]) >= rule.at_least
    return F.coalesce(hit, F.lit(False)).cast(FLAG_TYPE).alias(rule.flag)


def _any_flag(rules: Sequence[Rule]) -> Column:
    return F.greatest(*[F.col(rule.flag) for rule in rules], F.lit(0)) == 1


def flagged_refs(rules: Sequence[Rule], history: DataFrame, as_of: date) -> DataFrame:
    """Reference numbers that any of the rules flags, with one 0/1 column per rule."""
    rolled = _rolled(rules, history, as_of).filter(F.col(REF).isNotNull())
    per_ref = per_key(rolled, [REF], *[_reached(rule, as_of, None) for rule in rules])
    return per_ref.filter(_any_flag(rules))


def flagged_rows(
    rules: Sequence[Rule], history: DataFrame, as_of: date, within: Column | None = None
) -> DataFrame:
    """The transactions of such numbers: account, time, flags, and per burst rule count and end.

    Transactions without number are each on their own, flagged by bursts only. ``within`` says
    which transactions a sum is taken of, where the history is a part of the whole.
    """
    rolled = _rolled(rules, history, as_of)
    # Numbers that are missing are spread, not one group.
    spread = F.when(F.col(REF).isNull(), F.xxhash64(ACCOUNT, AT)).otherwise(F.lit(0).cast("long"))
    rolled = rolled.withColumn("_spread", spread)
    same = Window.partitionBy(REF, "_spread")
    flags = {}
    for rule in rules:
        hit = _reached(rule, as_of, within, same)
        if isinstance(rule, SumRule):
            hit = F.when(F.col(REF).isNotNull(), hit).otherwise(F.lit(0).cast(FLAG_TYPE))
        flags[rule.flag] = hit
    bursts = [rule for rule in rules if isinstance(rule, BurstRule)]
    found = rolled.withColumns(flags).filter(_any_flag(rules))
    shown = [F.col(c) for rule in bursts for c in (_total(rule), _burst(rule))]
    return found.select(REF, ACCOUNT, AT, *flags, *shown)


def with_rows(history: DataFrame, found: DataFrame, rules: Sequence[Rule], dropped: Sequence[str] = ()) -> DataFrame:
    """The history's rows of ``flagged_rows``, with their flags and bursts, without other flags."""
    values = [c for c in found.columns if c not in (REF, ACCOUNT, AT)]
    # Rows with the same number, account and time have the same flags and bursts.
    keyed = per_key(found, [REF, ACCOUNT, AT], *[F.max(c).alias(c) for c in values])
    keyed = keyed.withColumnsRenamed({c: f"_{c}" for c in (REF, ACCOUNT, AT)})
    same = F.col(REF).eqNullSafe(F.col(f"_{REF}"))
    same = same & (F.col(ACCOUNT) == F.col(f"_{ACCOUNT}")) & (F.col(AT) == F.col(f"_{AT}"))
    rows = history.drop(*dropped, EVENT_DATE, *[rule.flag for rule in rules])
    return rows.join(keyed, same).drop(f"_{REF}", f"_{ACCOUNT}", f"_{AT}")


def output_of(rule: Rule, rows: DataFrame, rules: Sequence[Rule], as_of: date) -> DataFrame:
    """What ``evaluate`` gives for the rule, from ``with_rows`` of all rules."""
    chosen = rows.filter(rule.selects(as_of))
    if rule.lookback is not None:
        chosen = chosen.withColumn(DAY, F.to_date(AT))
    internal = [rule.flag for rule in rules]
    internal += [name(r) for r in rules if isinstance(r, BurstRule) for name in (_total, _burst)]
    if isinstance(rule, SumRule):
        return set_flag(chosen.filter(F.col(rule.flag) == 1).drop(*internal))
    end = F.col(_burst(rule))
    inside = chosen.filter(end.isNotNull()).withColumns(
        {"_count": F.col(_total(rule)), "_right": end, "_start": end - rule.span}
    )
    inside = inside.drop(*internal).withColumnsRenamed(
        {"_count": "rolling_count", "_right": "transaction_date_right", "_start": "t_start"}
    )
    return set_flag(dedupe(inside, REF, [AT, "transaction_date_right"]))
