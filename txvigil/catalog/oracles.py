"""The queries in SQL, each in the most literal form: self joins, no trailing totals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from txvigil.catalog.queries import MERGE_DAYS, RUNS, TUNED, as_of, days, hours, tuned
from txvigil.catalog.views import TX, emit_sql
from txvigil.plans.families import CCW, LISTRIK, TF_ONLINE, Family
from txvigil.plans.rules import BurstRule, Rule

ORACLES: dict[str, str] = {}


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def tx(table: str = "events", where: str = "true") -> str:
    """Common table ``tx``: the chosen transactions with their time ``us`` and row number ``id``."""
    return (
        f"tx AS (SELECT *, epoch_us(transaction_date) AS us, row_number() OVER () AS id "
        f"FROM ({TX[table]}) WHERE {where})"
    )


def counted(span: timedelta) -> str:
    """``rc``: rows of the account in (t - span, t]."""
    return (
        "rc AS (SELECT a.id, count(*) AS rolling_count FROM tx a JOIN tx b "
        "ON a.from_account_number = b.from_account_number "
        f"AND b.us > a.us - {micros(span)} AND b.us <= a.us GROUP BY a.id)"
    )


def inside(span: timedelta, at_least: int) -> str:
    """``burst``: rows of a burst with its earliest end."""
    return (
        f"{counted(span)}, "
        "ends AS (SELECT DISTINCT from_account_number AS account, us AS e FROM tx JOIN rc USING (id) "
        f"WHERE rolling_count >= {at_least}), "
        "burst AS (SELECT tx.*, rolling_count, e FROM tx JOIN rc USING (id) JOIN "
        "(SELECT id, min(e) AS e FROM tx JOIN ends ON from_account_number = account "
        f"AND us >= e - {micros(span)} AND us <= e GROUP BY id) USING (id))"
    )


def burst_columns(span: timedelta) -> list[str]:
    return ["rolling_count", "e AS transaction_date_right_us", f"e - {micros(span)} AS t_start_us"]


def first_per_ref(table: str, order: str) -> str:
    return (
        f"(SELECT * FROM {table} QUALIFY row_number() OVER "
        f"(PARTITION BY no_referensi ORDER BY {order}) = 1)"
    )


_REST = (
    "from_account_number, from_account_owner_name, to_account_number, to_account_owner_name, "
    "to_bank_name, transaction_category, transaction_status, transaction_amount, "
    "transaction_currency, channel_code, transaction_state"
)


def summed(span: timedelta) -> str:
    """``s``: amount of the account in [t - span, t] per row."""
    return (
        "s AS (SELECT a.id, a.no_referensi, sum(CAST(b.transaction_amount AS DECIMAL(18,2))) AS total "
        "FROM tx a JOIN tx b ON a.from_account_number = b.from_account_number "
        f"AND b.us >= a.us - {micros(span)} AND b.us <= a.us GROUP BY a.id, a.no_referensi)"
    )


def above(span: timedelta, at_least: float) -> str:
    """``hit``: reference numbers at or above the threshold."""
    return (
        f"{summed(span)}, hit AS (SELECT no_referensi FROM s GROUP BY no_referensi "
        f"HAVING sum(total) >= {at_least})"
    )


def chosen(rule: Rule, day: date) -> str:
    where = "true"
    if rule.lookback is not None:
        cutoff = day - timedelta(days=rule.lookback)
        where += f" AND CAST(transaction_date AS DATE) >= DATE '{cutoff}'"
    if rule.hours is not None:
        where += f" AND hour(transaction_date) BETWEEN {rule.hours[0]} AND {rule.hours[1]}"
    return where


def rule_sql(name: str) -> str:
    rule, table = tuned(name), TUNED[name][0]
    day = [] if rule.lookback is None else [
        "CAST(CAST(transaction_date AS DATE) AS VARCHAR) AS temp_date_col"
    ]
    rows = tx(table, chosen(rule, as_of(table)))
    if isinstance(rule, BurstRule):
        shown = emit_sql(*day, *burst_columns(rule.span), "1 AS flag")
        first = first_per_ref("burst", f"transaction_date, e, {_REST}")
        return f"WITH {rows}, {inside(rule.span, rule.at_least)} SELECT {shown} FROM {first}"
    return (
        f"WITH {rows}, {above(rule.span, rule.at_least)} SELECT {emit_sql(*day, '1 AS flag')} "
        "FROM tx WHERE no_referensi IN (SELECT no_referensi FROM hit)"
    )


ORACLES.update({f"rule_{name}": rule_sql(name) for name in TUNED})


def warmup_sql(name: str) -> str:
    """A burst rule that also sees the span before its lookback."""
    rule, table = tuned(name), TUNED[name][0]
    first = as_of(table) - timedelta(days=rule.lookback)
    early = f"epoch_us(transaction_date) >= epoch_us(TIMESTAMP '{first}') - {micros(rule.span)}"
    day = "CAST(CAST(transaction_date AS DATE) AS VARCHAR) AS temp_date_col"
    shown = emit_sql(day, *burst_columns(rule.span), "1 AS flag")
    late = f"(SELECT * FROM burst WHERE transaction_date >= TIMESTAMP '{first}')"
    return (
        f"WITH {tx(table, early)}, {inside(rule.span, rule.at_least)} "
        f"SELECT {shown} FROM {first_per_ref(late, f'transaction_date, e, {_REST}')}"
    )


ORACLES["rule_ccw_warmup"] = warmup_sql("ccw")


def rows_sql(where: str = "true", *more: str, table: str = "events") -> str:
    return f"SELECT {emit_sql(*more)} FROM ({TX[table]}) WHERE {where}"


# Sources and sinks

ORACLES["read_daily_drops"] = rows_sql()
ORACLES["typed_scan"] = rows_sql()
ORACLES["positional_rename"] = rows_sql()
ORACLES["append_unique"] = rows_sql()
ORACLES["null_tokens"] = (
    f"SELECT * REPLACE (CASE WHEN transaction_category IN ('view', 'click', 'error', 'signup') "
    f"THEN NULL ELSE transaction_category END AS to_bank_name) FROM ({rows_sql()})"
)
ORACLES["glob_scan"] = (
    "SELECT * REPLACE (strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_date, "
    "CAST(no_referensi AS BIGINT) AS no_referensi, "
    "CAST(from_account_number AS BIGINT) AS from_account_number, "
    "CAST(transaction_status AS INTEGER) AS transaction_status, "
    f"CAST(transaction_state AS INTEGER) AS transaction_state) FROM ({TX['events']})"
)
ORACLES["staged_overwrite"] = rows_sql(
    "true", "CASE WHEN transaction_amount >= 100 THEN 1 ELSE 0 END AS flag"
)
ORACLES["typed_empty"] = rows_sql("true", "0 AS flag")

# Projections and filters

_DAY = "CAST(CAST(transaction_date AS DATE) AS VARCHAR) AS temp_date_col"

ORACLES["filter_eligible"] = rows_sql(
    "transaction_status IN (0) AND transaction_state IN (1) "
    "AND transaction_category IN ('click', 'purchase', 'error')"
)
ORACLES["filter_cutoff"] = rows_sql("CAST(transaction_date AS DATE) >= DATE '2024-01-21'", _DAY)
ORACLES["filter_hours"] = rows_sql("hour(transaction_date) BETWEEN 0 AND 6")
ORACLES["filter_adhoc"] = rows_sql(
    "transaction_state = 1 AND channel_code = 'MB' AND transaction_amount > 50"
)
ORACLES["filter_day"] = rows_sql(
    "CAST(transaction_date AS DATE) = DATE '2024-01-05' AND transaction_amount >= 20"
)
ORACLES["add_missing_flags"] = rows_sql(
    "true",
    "CAST(transaction_status AS INTEGER) AS flag_5min",
    "0 AS flag_10min",
    "0 AS flag_50mio",
    "0 AS flag_50mio_early",
)
ORACLES["normalise_flags"] = rows_sql(
    "true",
    "CASE WHEN transaction_amount > 100 THEN 1 ELSE 0 END AS flag_5min",
    "CAST(transaction_status AS INTEGER) AS flag_10min",
)

# Joins, deltas, keys

_EARLIER = "transaction_date < TIMESTAMP '2024-01-21'"
_LATER = "transaction_date >= TIMESTAMP '2024-01-16'"


def missing_in(where: str) -> str:
    return (
        f"NOT EXISTS (SELECT 1 FROM (SELECT no_referensi AS r FROM ({TX['events']}) "
        f"WHERE {where}) WHERE r = no_referensi)"
    )


ORACLES["mark_by_composite_key"] = rows_sql(
    "true",
    "CASE WHEN (from_account_number, no_referensi) IN (SELECT (from_account_number, no_referensi) "
    f"FROM ({TX['events']}) WHERE transaction_amount >= 100) THEN 1 "
    "ELSE CAST(transaction_status AS INTEGER) END AS flag",
)
ORACLES["delta_new"] = rows_sql(f"{_LATER} AND {missing_in(_EARLIER)}")
ORACLES["delta_old"] = rows_sql(f"{_EARLIER} AND {missing_in(_LATER)}")
ORACLES["symmetric_difference"] = f"{ORACLES['delta_new']} UNION ALL {ORACLES['delta_old']}"
ORACLES["append_delta"] = f"{rows_sql(_EARLIER)} UNION ALL {ORACLES['delta_new']}"
ORACLES["semi_by_keys"] = rows_sql(
    "(from_account_number, no_referensi) IN (SELECT (from_account_number, no_referensi) "
    f"FROM ({TX['lineitem']}) WHERE transaction_amount >= 90000)",
    table="lineitem",
)
ORACLES["dedupe_ref"] = (
    f"SELECT {emit_sql()} FROM "
    + first_per_ref(f"({TX['lineitem']})", f"transaction_date, {_REST}")
)
ORACLES["distinct_keys"] = (
    f"SELECT DISTINCT from_account_number, no_referensi FROM ({TX['lineitem']})"
)
ORACLES["find_duplicates"] = (
    f"SELECT {emit_sql()} FROM (SELECT *, count(*) OVER "
    f"(PARTITION BY no_referensi, from_account_number) AS n FROM ({TX['lineitem']})) WHERE n > 1"
)
ORACLES["merge_flags_max"] = (
    "SELECT from_account_number, no_referensi, "
    "max(CASE WHEN transaction_category = 'A' THEN 1 ELSE 0 END) AS flag_5min, "
    "max(CASE WHEN transaction_amount >= 50000 THEN 1 ELSE 0 END) AS flag_10min "
    f"FROM ({TX['lineitem']}) GROUP BY from_account_number, no_referensi"
)
ORACLES["count_rows"] = f"SELECT count(*) AS rows FROM ({TX['lineitem']})"

# Trailing totals and bursts


def count_sql(table: str, span: timedelta) -> str:
    return f"WITH {tx(table)}, {counted(span)} SELECT {emit_sql('rolling_count')} FROM tx JOIN rc USING (id)"


def sum_sql(table: str, span: timedelta) -> str:
    shown = emit_sql("CAST(total AS DOUBLE) AS rolling_sum").replace(" no_referensi", " tx.no_referensi")
    return f"WITH {tx(table)}, {summed(span)} SELECT {shown} FROM tx JOIN s USING (id)"


def burst_sql(table: str, span: timedelta, at_least: int) -> str:
    shown = emit_sql(*burst_columns(span))
    return f"WITH {tx(table)}, {inside(span, at_least)} SELECT {shown} FROM burst"


ORACLES["rolling_count"] = count_sql("events", hours(6))
ORACLES["rolling_count_ties"] = ORACLES["sliced_count"] = count_sql("orders", days(30))
ORACLES["rolling_sum_24h"] = sum_sql("events", hours(24))
ORACLES["self_range_join"] = ORACLES["sliced_sum"] = sum_sql("lineitem", days(2))
ORACLES["sum24h_by_ref"] = (
    f"WITH {tx('lineitem')}, {summed(days(2))} "
    "SELECT no_referensi, CAST(sum(total) AS DOUBLE) AS rolling_sum FROM s GROUP BY no_referensi"
)
ORACLES["burst_flag"] = (
    f"WITH {tx()}, {inside(hours(6), 3)} SELECT {emit_sql(*burst_columns(hours(6)), '1 AS flag')} "
    f"FROM {first_per_ref('burst', f'transaction_date, e, {_REST}')}"
)
ORACLES["burst_interval_join"] = burst_sql("orders", days(30), 2)
ORACLES["sliced_burst"] = burst_sql("events", hours(6), 3)

# What is behind a flag


def burst_pairs_sql(table: str, span: timedelta, at_least: int) -> str:
    return (
        f"WITH {tx(table)}, {counted(span)}, "
        "ends AS (SELECT DISTINCT from_account_number AS account, us AS e FROM tx JOIN rc USING (id) "
        f"WHERE rolling_count >= {at_least}) SELECT {emit_sql(*burst_columns(span))} "
        "FROM tx JOIN rc USING (id) JOIN ends ON from_account_number = account "
        f"AND us >= e - {micros(span)} AND us <= e"
    )


def contributors_sql(rule: str, span: timedelta) -> str:
    """``rule`` defines ``tx`` and ``hit``(no_referensi, rolling_sum)."""
    return (
        f"WITH {rule} SELECT a.no_referensi, a.from_account_number, a.us AS transaction_date_us, "
        "a.transaction_amount, CAST(hit.rolling_sum AS DOUBLE) AS rolling_sum, "
        "b.no_referensi AS no_referensi_r, b.us AS transaction_date_r_us, "
        "b.transaction_amount AS transaction_amount_r FROM tx a JOIN hit USING (no_referensi) "
        "JOIN tx b ON a.from_account_number = b.from_account_number "
        f"AND b.us >= a.us - {micros(span)} AND b.us <= a.us"
    )


def reached_sql(table: str, span: timedelta, at_least: float, where: str = "true") -> str:
    return (
        f"{tx(table, where)}, {summed(span)}, hit AS (SELECT no_referensi, sum(total) AS rolling_sum "
        f"FROM s GROUP BY no_referensi HAVING sum(total) >= {at_least})"
    )


ORACLES["burst_interval_pairs"] = burst_pairs_sql("orders", days(60), 3)
ORACLES["burst_interval_pairs_dense"] = burst_pairs_sql("events", hours(6), 2)
ORACLES["sum_contributors"] = contributors_sql(reached_sql("lineitem", days(2), 200_000), days(2))
ORACLES["sum_contributors_early"] = contributors_sql(
    reached_sql("events", hours(24), 100, "hour(transaction_date) BETWEEN 0 AND 6"), hours(24)
)

# Sorted tables

ORACLES["sort_history"] = f"{rows_sql()} ORDER BY transaction_date, from_account_number"
ORACLES["latest_top_k"] = f"{rows_sql()} ORDER BY transaction_date DESC, no_referensi LIMIT 20"
ORACLES["page_slice"] = f"{rows_sql()} ORDER BY transaction_date, no_referensi LIMIT 30 OFFSET 10"

ORACLES["page_slice_middle"] = (
    "SELECT * EXCLUDE (place, many) FROM (SELECT *, "
    "row_number() OVER (ORDER BY transaction_date_us, no_referensi, from_account_number, transaction_amount) - 1 AS place, "
    f"count(*) OVER () AS many FROM ({rows_sql(table='lineitem')})) "
    "WHERE place >= many // 2 AND place < many // 2 + 30"
)

# Scalar functions

_SECONDS = "epoch_us(date_trunc('second', transaction_date))"

ORACLES["scalar_time"] = (
    "SELECT no_referensi, CAST(CAST(transaction_date AS DATE) AS VARCHAR) AS day, "
    "CAST(hour(transaction_date) AS INTEGER) AS hour, "
    "epoch_us(transaction_date - INTERVAL 10 MINUTE) AS ten_minutes_before_us, "
    "epoch_us(transaction_date - INTERVAL 24 HOUR) AS day_before_us, "
    f"{_SECONDS} AS parsed_us, epoch_us(transaction_date) AS parsed_iso_us, "
    "strftime(transaction_date, '%Y%m%d') AS stamp, "
    "CASE WHEN transaction_date >= TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END AS second_half "
    f"FROM ({TX['events']})"
)
ORACLES["scalar_logic"] = (
    "SELECT no_referensi, CAST(coalesce(try_cast(CASE WHEN transaction_status = 1 THEN 'no date' "
    "ELSE CAST(CAST(transaction_date AS DATE) AS VARCHAR) END AS DATE), DATE '1970-01-01') "
    "AS VARCHAR) AS lenient_date, "
    "CASE WHEN channel_code = 'MB' THEN transaction_amount ELSE 0.0 END AS filled, "
    "CASE WHEN channel_code = 'MB' THEN 1 ELSE CAST(transaction_status AS INTEGER) END AS set, "
    "CASE WHEN transaction_amount BETWEEN 20 AND 50 THEN 1 ELSE 0 END AS between, "
    "CASE WHEN transaction_status = 1 OR transaction_amount > 100 THEN 1 ELSE 0 END AS either, "
    "CAST(trunc(transaction_amount) AS BIGINT) AS whole "
    f"FROM ({TX['events']})"
)

# Flag merges

_CCW = tuned("ccw")
_CCW_ROWS = f"{tx('events', chosen(_CCW, as_of('events')))}, {inside(_CCW.span, _CCW.at_least)}"


def merged_sql(hits: str) -> str:
    shown = emit_sql(
        f"CASE WHEN no_referensi IN ({hits}) THEN 1 "
        "ELSE CAST(transaction_status AS INTEGER) END AS flag"
    )
    return f"WITH {_CCW_ROWS} SELECT {shown} FROM ({TX['events']})"


ORACLES["flag_merge"] = merged_sql("SELECT no_referensi FROM burst")
ORACLES["flag_merge_cutoff"] = merged_sql(
    "SELECT no_referensi FROM burst WHERE CAST(transaction_date AS DATE) >= DATE '2024-01-21'"
)
ORACLES["unflagged_count"] = (
    f"WITH {_CCW_ROWS} SELECT count(*) AS unflagged FROM ({TX['events']}) "
    "WHERE transaction_status = 0 AND no_referensi IN (SELECT no_referensi FROM burst)"
)
ORACLES["all_flagged"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, CASE WHEN coalesce(bool_and(transaction_status = 1), true) "
    f"THEN 1 ELSE 0 END AS all_flagged FROM ({TX['events']}) WHERE transaction_category = '{kind}'"
    for kind in ("error", "click", "none of them")
)


def family_sql(
    eligible: str, family: Family = TF_ONLINE, runs: Sequence[date] = (), merged: int | None = None
) -> str:
    """Reference numbers of the family's rules with one column per flag, as table ``family``.

    With ``runs`` what the history up to each of these days gives, taken together; with
    ``merged`` of each run only the transactions of so many days.
    """
    parts = []
    for rule in family.rules:
        rule = tuned(rule.name)
        for day in runs or [as_of("events")]:
            until = f"CAST(transaction_date AS DATE) <= DATE '{day}'" if runs else "true"
            rows = tx("events", f"{chosen(rule, day)} AND {eligible} AND {until}")
            if isinstance(rule, BurstRule):
                refs = f"WITH {rows}, {inside(rule.span, rule.at_least)} SELECT no_referensi FROM burst"
                if merged is not None:
                    first = day - timedelta(days=merged)
                    refs += f" WHERE CAST(transaction_date AS DATE) >= DATE '{first}'"
            else:
                refs = f"WITH {rows}, {above(rule.span, rule.at_least)} SELECT no_referensi FROM hit"
            parts.append(f"SELECT no_referensi, '{rule.flag}' AS flag FROM ({refs})")
    shown = ", ".join(
        f"max(CASE WHEN flag = '{f}' THEN 1 ELSE 0 END) AS {f}" for f in family.flags
    )
    return (
        f"family AS (SELECT no_referensi, {shown} FROM ({' UNION ALL '.join(parts)}) "
        "GROUP BY no_referensi)"
    )


def pipeline_sql(family: Family, merged: int | None = None) -> str:
    found = family_sql(_ELIGIBLE, family, [day for day, _ in RUNS], merged)
    shown = emit_sql(_EVENT_DATE, *[f"coalesce({f}, 0) AS {f}" for f in family.flags])
    return (
        f"WITH {found} SELECT {shown} FROM ({TX['events']}) "
        f"LEFT JOIN family USING (no_referensi) WHERE {_ELIGIBLE}"
    )


ORACLES["family_refs"] = f"WITH {family_sql('true')} SELECT * FROM family"

# Table maintenance

_ELIGIBLE = (
    "transaction_status = 0 AND transaction_state = 1 "
    "AND transaction_category IN ('click', 'purchase', 'signup', 'view')"
)
_EVENT_DATE = "CAST(CAST(transaction_date AS DATE) AS VARCHAR) AS event_date"

ORACLES["ingest_append"] = rows_sql(
    _ELIGIBLE, _EVENT_DATE, *[f"0 AS {f}" for f in TF_ONLINE.flags]
)
ORACLES["family_pipeline"] = ORACLES["family_pipeline_refs"] = pipeline_sql(TF_ONLINE)
ORACLES["family_pipeline_continued"] = ORACLES["family_pipeline"]
ORACLES["family_pipeline_ccw"] = ORACLES["family_pipeline_ccw_refs"] = pipeline_sql(CCW, MERGE_DAYS)
ORACLES["family_pipeline_position"] = pipeline_sql(LISTRIK)

_HIT = (
    "CAST(transaction_date AS DATE) IN (DATE '2024-01-15', DATE '2024-01-20') "
    "AND transaction_amount >= 100"
)
ORACLES["flag_merge_evolved"] = rows_sql(
    "true",
    _EVENT_DATE,
    "CAST(transaction_status AS INTEGER) AS flag_5min",
    f"CASE WHEN {_HIT} THEN 1 ELSE 0 END AS flag_10min",
    "0 AS flag_50mio",
    "0 AS flag_50mio_early",
)
ORACLES["flag_merge_boolean"] = rows_sql(
    "true",
    _EVENT_DATE,
    f"CASE WHEN transaction_amount >= 150 OR {_HIT} THEN 1 ELSE 0 END AS flag_5min",
    "0 AS flag_10min",
    "0 AS flag_50mio",
    "0 AS flag_50mio_early",
)
ORACLES["history_compaction"] = rows_sql(
    "true",
    _EVENT_DATE,
    "0 AS flag_5min",
    f"CASE WHEN {_HIT} THEN 1 ELSE 0 END AS flag_10min",
    "0 AS flag_50mio",
    "0 AS flag_50mio_early",
)
