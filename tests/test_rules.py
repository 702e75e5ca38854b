"""Boundaries of the two rule shapes, each both as a whole account and sliced."""

from dataclasses import replace
from datetime import date, timedelta

import pytest

from txvigil.plans.families import FAMILIES, RULES
from txvigil.plans.rules import BurstRule, SumRule, evaluate, flagged_refs

DAY = date(2025, 1, 10)
BURST = BurstRule("burst", "flag", timedelta(minutes=10), 3)
SUM = SumRule("sum", "flag", timedelta(hours=24), 50_000_000)
EARLY = replace(SUM, hours=(0, 6))

D1, D2 = "2025-01-09", "2025-01-10"

CASES = {
    "left edge exclusive": (
        BURST,
        [(f"{D1} 00:00:00", 1), (f"{D1} 00:05:00", 1), (f"{D1} 00:10:00", 1)],
        [],
    ),
    "burst start inclusive": (
        BURST,
        [(f"{D1} 00:00:00", 1), (f"{D1} 00:00:01", 1), (f"{D1} 00:05:00", 1), (f"{D1} 00:10:00", 1)],
        ["r0", "r1", "r2", "r3"],
    ),
    "ties": (BURST, [(f"{D1} 00:00:00", 1)] * 3, ["r0", "r1", "r2"]),
    "accounts separate": (
        BURST,
        [(f"{D1} 00:00:00", 1), (f"{D1} 00:01:00", 1, "B"), (f"{D1} 00:02:00", 1)],
        [],
    ),
    "null account": (BURST, [(f"{D1} 00:00:0{i}", 1, None) for i in range(3)], []),
    "null time": (BURST, [(None, 1)] * 3, []),
    "edge inclusive": (SUM, [(f"{D1} 08:00:00", 30e6), (f"{D2} 08:00:00", 25e6)], ["r1"]),
    "a microsecond beyond": (
        SUM,
        [(f"{D1} 08:00:00", 30e6), (f"{D2} 08:00:00.000001", 25e6)],
        [],
    ),
    "threshold inclusive": (SUM, [(f"{D1} 08:00:00", 50e6)], ["r0"]),
    "missing amount": (SUM, [(f"{D1} 08:00:00", 50e6), (f"{D1} 09:00:00", None)], ["r0", "r1"]),
    "early hours": (EARLY, [(f"{D1} 06:59:59", 50e6), (f"{D1} 07:00:00", 50e6)], ["r0"]),
    "hour zero only": (
        replace(SUM, hours=(0, 0)),
        [(f"{D1} 00:59:59", 50e6), (f"{D1} 01:00:00", 50e6)],
        ["r0"],
    ),
    "only early amounts count": (
        EARLY,
        [(f"{D1} 12:00:00", 40e6), (f"{D2} 01:00:00", 20e6)],
        [],
    ),
    "repeated number": (
        SUM,
        [(f"{D1} 01:00:00", 30e6, "A", "X"), (f"{D1} 02:00:00", 10e6, "A", "X")],
        ["X", "X"],
    ),
    "repeated number, other account": (
        SUM,
        [(f"{D1} 01:00:00", 30e6, "A", "X"), (f"{D1} 02:00:00", 20e6, "B", "X")],
        ["X", "X"],
    ),
    "null number": (SUM, [(f"{D1} 01:00:00", 60e6, "A", None)], []),
    "cents": (SUM, [(f"{D1} 01:00:00", 49_999_999.9)] + [(f"{D1} 01:00:00", 0.01)] * 10, [f"r{i}" for i in range(11)]),
    "lookback": (
        replace(SUM, lookback=2),
        [(f"2025-01-{d:02d} 00:00:00", 50e6) for d in (7, 8, 9, 10)],
        ["r1", "r2", "r3"],
    ),
}


def named(case, rows):
    """The rows of a case with accounts and numbers of their own."""
    for i, row in enumerate(rows):
        at, amount, account, ref = (*row, *("A", f"r{i}")[len(row) - 2 :])
        yield at, amount, account and f"{case}/{account}", ref and f"{case}/{ref}"


@pytest.mark.parametrize("rule", dict.fromkeys(rule for rule, _, _ in CASES.values()), ids=str)
def test_flagged(tx, refs, rule):
    cases = {case: c[1:] for case, c in CASES.items() if c[0] == rule}
    history = tx(*[row for case, (rows, _) in cases.items() for row in named(case, rows)])
    expected = sorted(f"{case}/{ref}" for case, (_, refs_) in cases.items() for ref in refs_)
    assert refs(evaluate(rule, history, DAY)) == expected
    assert refs(flagged_refs([rule], history, DAY)) == sorted(set(expected))


def test_rules_in_one_pass(tx, refs):
    history = tx(*CASES["burst start inclusive"][1], *CASES["early hours"][1])
    rules = [
        replace(BURST, flag="flag_burst"),
        replace(SUM, flag="flag_sum"),
        replace(EARLY, flag="flag_early"),
    ]
    together = {
        row.no_referensi: (row.flag_burst, row.flag_sum, row.flag_early)
        for row in flagged_refs(rules, history, DAY).collect()
    }
    for position, rule in enumerate(rules):
        alone = refs(evaluate(rule, history, DAY))
        assert alone == sorted(r for r, hit in together.items() if hit[position])


def test_output_columns(tx):
    history = tx((f"{D1} 00:00:00", 1)).selectExpr("*", "cast(0 as tinyint) as flag_10min")
    base = [c for c in history.columns if c != "flag_10min"]
    rule = replace(BURST, lookback=2)
    burst = evaluate(rule, history, DAY, ["flag_10min"])
    times = ["rolling_count", "transaction_date_right", "t_start"]
    assert burst.columns == [*base, "temp_date_col", *times, "flag"]
    assert dict(burst.dtypes)["flag"] == "tinyint"
    assert evaluate(SUM, history, DAY, ["flag_10min"]).columns == [*base, "flag"]


def test_burst_bounds_are_those_of_the_earliest_burst(tx):
    history = tx(*[(f"{D1} 00:0{i}:00", 1) for i in range(5)])
    bounds = {
        r.no_referensi: (r.rolling_count, r.transaction_date_right.minute, r.t_start.minute)
        for r in evaluate(BURST, history, DAY).collect()
    }
    assert bounds == {
        "r0": (1, 2, 52),
        "r1": (2, 2, 52),
        "r2": (3, 2, 52),
        "r3": (4, 3, 53),
        "r4": (5, 4, 54),
    }


def test_repeated_number_is_flagged_once_by_a_burst(tx, refs):
    history = tx(*[(f"{D1} 00:00:0{i}", 1, "A", "X") for i in range(3)])
    assert refs(evaluate(BURST, history, DAY)) == ["X"]


def test_registry():
    assert len(RULES) == 15
    assert len(FAMILIES) == 7
    assert all(len(f.flags) == len(set(f.flags)) for f in FAMILIES.values())
