"""What of a history has been evaluated, so that the next run goes on from there.

The state of a family is a small file that names the parts of its history that its rules have
seen, and the rules. Parts that are not named hold what came since, be it of the last day or of
a day long past. A new transaction changes the totals of its account for a span after it and
the bursts around it for a span before, so a run reads the days of new parts and a span on
either side; all other days are pruned by their folders.

Tables of flags may be written in between: a part with old rows is read again, no more.

A row is evaluated when it comes and again when another one comes within a span. What a whole
run does beyond that is to look at the first rows of its lookback again, whose windows have
been cut meanwhile; that can flag a row only if amounts are negative. Numbers that repeat on
days apart are not added up.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, SparkSession, functions as F

from txvigil.plans.rules import Rule
from txvigil.schema import AT, EVENT_DATE
from txvigil.sources.files import read_text, replace_text
from txvigil.sources.tables import parts_by_day

_DAY = timedelta(days=1)


@dataclass(frozen=True)
class Stretch:
    """Days to read, and within them the time from which on windows are whole."""

    first: date
    last: date
    whole_from: datetime

    def read(self) -> Column:
        return F.col(EVENT_DATE).between(F.lit(self.first), F.lit(self.last))

    def whole(self) -> Column:
        begin = F.lit(self.whole_from.isoformat(sep=" ")).cast("timestamp_ntz")
        end = datetime.combine(self.last + _DAY, time())
        return (F.col(AT) >= begin) & (F.col(AT) < F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"))


def signature(rules: Sequence[Rule]) -> list[str]:
    return [repr(rule) for rule in rules]


def stretches(days: Sequence[date], span: timedelta) -> list[Stretch]:
    """Days with new rows and a span around them, as few ranges as they make."""
    made: list[Stretch] = []
    for day in sorted(set(days)):
        midnight = datetime.combine(day, time())
        first = (midnight - span).date()
        last = (midnight + _DAY + span).date()
        if made and first <= made[-1].last + _DAY:
            made[-1] = Stretch(made[-1].first, last, made[-1].whole_from)
        else:
            made.append(Stretch(first, last, midnight))
    return made


def unseen(
    spark: SparkSession, history_path: str, state_path: str, rules: Sequence[Rule]
) -> list[Stretch] | None:
    """What to read for the next run; None for everything.

    That is without a state, with other rules than last time, and for a history without
    versions or with rows without a day.
    """
    text = read_text(spark, state_path)
    parts = parts_by_day(spark, history_path)
    if text is None or parts is None:
        return None
    state = json.loads(text)
    if state["rules"] != signature(rules):
        return None
    new = {day for part, day in parts.items() if part not in set(state["parts"])}
    if None in new:
        return None
    return stretches(list(new), max(rule.span for rule in rules))


def remember(spark: SparkSession, history_path: str, state_path: str, rules: Sequence[Rule]) -> None:
    """Everything that the history holds now has been evaluated."""
    parts = parts_by_day(spark, history_path)
    if parts is not None:
        text = json.dumps({"rules": signature(rules), "parts": sorted(parts)})
        replace_text(spark, state_path, text)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))
