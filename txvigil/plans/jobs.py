"""Table maintenance: ingest, rule runs, flag merges and a family's whole run."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from txvigil.operators.deltas import append_delta, new_keys, per_key
from txvigil.operators.filters import filter_cutoff, filter_eligible, since
from txvigil.operators.flags import add_missing_flags, merge_flags
from txvigil.operators.keys import dedupe
from txvigil.plans import progress
from txvigil.plans.families import Family
from txvigil.plans.rules import Rule, evaluate, flagged_rows, output_of, with_rows
from txvigil.schema import AT, DAY, EVENT_DATE, FLAG_TYPE, REF
from txvigil.sources.drops import Drops, read_daily_drops
from txvigil.sources.files import remove, shared_folder
from txvigil.sources.tables import (
    append_flags,
    append_history,
    read_history,
    read_table,
    replace_history,
    replace_table,
    table_exists,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Ingested:
    """Rows added to the history, and rows without reference number if those were written."""

    added: int = 0
    rejected: int | None = None


def new_rows(daily: DataFrame, history: DataFrame | None) -> DataFrame:
    """One row per reference number that the history does not have."""
    first = dedupe(daily.filter(F.col(REF).isNotNull()), REF, [AT])
    return first if history is None else new_keys(first, history)


def ingest(
    spark: SparkSession,
    family: Family,
    drops: Drops,
    history_path: str,
    as_of: date,
    n_days: int | None = None,
    rejects_path: str | None = None,
) -> Ingested:
    """Adds the family's new transactions of the last ``n_days`` drops to its history.

    The history wins over a drop, and of a number that repeats within the drops the first
    transaction is taken. Transactions without a number could never be recognised as known
    and would come again with every run; they go to ``rejects_path`` instead. Only the new
    rows are written, unless the history still has Boolean flags.
    """
    daily = read_daily_drops(
        spark,
        drops,
        as_of,
        family.n_days if n_days is None else n_days,
        by_position=family.by_position,
    )
    if daily is None:
        log.warning("%s: no drops, history left as it is", family.name)
        return Ingested()
    daily = filter_eligible(daily, family.categories, family.statuses, family.states)
    daily = add_missing_flags(daily, family.flags)
    rejected = None
    if rejects_path is not None:
        rejected = replace_table(daily.filter(F.col(REF).isNull()), rejects_path)

    if not table_exists(spark, history_path):
        added = replace_history(new_rows(daily, None), history_path)
    else:
        stored = read_table(spark, history_path)
        history = read_history(spark, history_path, family.flags)
        fresh = new_rows(daily, history)
        extra = set(fresh.columns) ^ (set(history.columns) - {EVENT_DATE})
        if extra:
            raise ValueError(f"columns of drops and history differ: {sorted(extra)}")
        if not boolean_flags(stored, family.flags):
            added = append_history(fresh, history_path)
        else:
            known = stored.count()
            whole = append_delta(history.drop(EVENT_DATE), fresh)
            added = replace_history(whole, history_path) - known
    result = Ingested(added, rejected)
    log.info("%s: %s", family.name, result)
    return result


def run_rule(
    spark: SparkSession,
    rule: Rule,
    family: Family,
    history_path: str,
    output_path: str,
    as_of: date,
    warmup: bool = False,
) -> int:
    """Writes the rule's flagged transactions, none at all included, and returns their number."""
    history = read_history(spark, history_path, family.flags)
    found = replace_table(evaluate(rule, history, as_of, family.flags, warmup), output_path)
    log.info("%s: %d flagged", rule.name, found)
    return found


def output_refs(
    spark: SparkSession,
    outputs: Mapping[str, str],
    as_of: date | None = None,
    n_days: int | None = None,
    dated: bool = False,
) -> DataFrame | None:
    """Reference numbers in rule outputs, given as flag -> path, with one column per flag.

    With ``n_days`` only those of transactions in the lookback period count; with ``dated``
    there is a row per number and day. Outputs that do not exist are left out; None if there
    is none.
    """
    keys = [REF, EVENT_DATE] if dated else [REF]
    parts = []
    for flag, path in outputs.items():
        if not table_exists(spark, path):
            log.warning("no output %s", path)
            continue
        rows = read_table(spark, path).withColumn(EVENT_DATE, F.to_date(AT))
        if n_days is not None:
            rows = rows.filter(since(as_of, n_days))
        hits = {f: F.lit(int(f == flag)).cast(FLAG_TYPE).alias(f) for f in outputs}
        parts.append(rows.filter(F.col(REF).isNotNull()).select(*keys, *hits.values()))
    if not parts:
        return None
    hits = reduce(DataFrame.unionByName, parts)
    return per_key(hits, keys, *[F.max(f).alias(f) for f in outputs])


def update_flags(spark: SparkSession, family: Family, history_path: str, hits: DataFrame) -> int:
    """Merges flags into the history; returns how many transactions got a new one.

    ``hits`` says on which days its reference numbers are; only these days are read, and of
    them only number, day and flags. What is new is written as flags beside the days
    (``append_flags``); no transaction is written again. A history that stores Boolean flags is
    written anew as a whole. ``hits`` is read more than once and should come from a table.
    """
    flags = [f for f in family.flags if f in hits.columns]
    boolean = boolean_flags(read_table(spark, history_path), family.flags)
    history = read_history(spark, history_path, family.flags)
    if not boolean:
        history = history.filter(on_days(hits.select(EVENT_DATE).distinct().collect()))
    hits = per_key(hits, [REF], *[F.max(f).alias(f) for f in flags])
    news = {f: ((F.col(f"_new_{f}") == 1) & (F.col(f) == 0)) for f in flags}
    renamed = hits.select(REF, *[F.col(f).alias(f"_new_{f}") for f in flags])
    before = history.select(REF, EVENT_DATE, *flags).filter(F.col(REF).isNotNull())
    fresh = before.join(renamed, REF).filter(reduce(or_, news.values(), F.lit(False)))
    if boolean:
        changed = fresh.count()
        if changed:
            replace_history(merge_flags(history, hits, flags), history_path)
    else:
        set_now = {f: F.coalesce(new, F.lit(False)).cast(FLAG_TYPE) for f, new in news.items()}
        staged = shared_folder(spark)
        changed = replace_table(fresh.withColumns(set_now).select(REF, EVENT_DATE, *flags), staged)
        if changed:
            append_flags(read_table(spark, staged), history_path)
        remove(spark, staged)
    log.info("%s: %d with new flags", family.name, changed)
    return changed


def boolean_flags(rows: DataFrame, flags: Sequence[str]) -> bool:
    """Whether a stored table has any of its flags as a Boolean column."""
    return any(f in rows.columns and dict(rows.dtypes)[f] == "boolean" for f in flags)


def on_days(rows: list[Row]) -> Column:
    """Whether a row is on one of the days, one row of a list each."""
    days = [row[EVENT_DATE] for row in rows]
    chosen = F.col(EVENT_DATE).isin([day for day in days if day is not None])
    return chosen | F.col(EVENT_DATE).isNull() if None in days else chosen


def run_family(
    spark: SparkSession,
    family: Family,
    drops: Drops,
    history_path: str,
    output_folder: str,
    as_of: date,
    n_days: int | None = None,
    outputs: bool = True,
    rejects_path: str | None = None,
    continued: bool = False,
) -> dict[str, int]:
    """Ingest, then all rules, then one merge of all their flags.

    One pass over the few columns that rules need finds the transactions that any rule flags.
    With ``outputs`` every rule also leaves its flagged transactions in ``output_folder``: what
    was found is joined once with the rest of its columns, and every rule takes its part.

    ``continued`` evaluates only what has come since the last such run, with a span around it
    (``progress``); the outputs then hold what this run has flagged. The first run, and one
    after a change of the rules, evaluates everything.
    """
    ingested = ingest(spark, family, drops, history_path, as_of, n_days, rejects_path)
    report = {"added": ingested.added}
    if not table_exists(spark, history_path):
        return report
    state = f"{output_folder}/{family.name}_evaluated"
    history = read_history(spark, history_path, family.flags)
    todo = progress.unseen(spark, history_path, state, family.rules) if continued else None
    within = None
    if todo is not None:
        history = history.filter(progress.any_of([stretch.read() for stretch in todo]))
        within = progress.any_of([stretch.whole() for stretch in todo])
    path = f"{output_folder}/{family.name}_found"
    replace_table(flagged_rows(family.rules, history, as_of, within), path)
    found = read_table(spark, path)
    if outputs:
        rows = shared_folder(spark)
        lookbacks = [rule.lookback for rule in family.rules]
        if None not in lookbacks:
            history = filter_cutoff(history, as_of, max(lookbacks)).drop(DAY)
        replace_table(with_rows(history, found, family.rules, family.flags), rows)
        flagged = read_table(spark, rows)
        for rule in family.rules:
            output = output_of(rule, flagged, family.rules, as_of)
            report[rule.flag] = replace_table(output, f"{output_folder}/{rule.name}")
        remove(spark, rows)
    hits = found.filter(F.col(REF).isNotNull()).withColumn(EVENT_DATE, F.to_date(AT))
    if family.merge_days is not None:
        hits = hits.filter(since(as_of, family.merge_days))
    hits = hits.select(REF, EVENT_DATE, *family.flags)
    report["updated"] = update_flags(spark, family, history_path, hits)
    progress.remember(spark, history_path, state, family.rules)
    return report
