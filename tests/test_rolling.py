"""Trailing totals and bursts against brute force on random accounts."""

import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txvigil.catalog import QUERIES
from txvigil.catalog.views import transactions
from txvigil.operators.rolling import (
    Burst,
    Total,
    _spread,
    burst_rows,
    cents,
    money,
    rolling_count,
    rolling_sum,
    sum_by_ref,
    trailing,
)
from txvigil.plans.rules import BurstRule, SumRule, evaluate, flagged_refs
from txvigil.schema import ACCOUNT, AMOUNT, AT

FOLDER = "/root/testdata/sf0.001"
START = datetime(2025, 3, 30)
SPAN = timedelta(minutes=10)
TICK = timedelta(microseconds=1)


def random_rows(seed, accounts=150):
    """Times a microsecond around the span and on a coarse grid, so edges and ties are common."""
    dice = random.Random(seed)
    rows = []
    for account in range(accounts):
        for _ in range(dice.randint(1, 25)):
            us = dice.choice(
                [
                    dice.randint(0, 8) * 300_000_000,
                    600_000_000 + dice.randint(-1, 1),
                    dice.randint(0, 2 * 86_400_000_000),
                ]
            )
            rows.append((START + timedelta(microseconds=us), dice.randint(-50, 100), f"a{account}"))
    return rows


def brute(rows, at_least):
    accounts = {}
    for t, amount, account in rows:
        accounts.setdefault(account, []).append((t, amount))
    counts = {
        account: [sum(1 for u, _ in own if t - SPAN < u <= t) for t, _ in own]
        for account, own in accounts.items()
    }
    for t, _, account in rows:
        own = accounts[account]
        count = sum(1 for u, _ in own if t - SPAN < u <= t)
        total = sum(x for u, x in own if t - SPAN <= u <= t)
        ends = [
            u
            for (u, _), n in zip(own, counts[account])
            if n >= at_least and u - SPAN <= t <= u
        ]
        yield count, total, min(ends, default=None)


@pytest.mark.parametrize("stretch", [None, SPAN + TICK, timedelta(minutes=13), timedelta(days=9)])
@pytest.mark.parametrize("at_least", [1, 2, 4])
def test_against_brute_force(tx, stretch, at_least):
    rows = random_rows(seed=at_least)
    history = tx(*[(t.isoformat(), amount, account) for t, amount, account in rows])
    rolled = trailing(
        history,
        [Total("n", SPAN, F.lit(1), False), Total("amount", SPAN, money(), True)],
        [Burst("end", "n", at_least, SPAN)],
        stretch=stretch,
    ).collect()
    result = {r.no_referensi: (r.n, r.amount, r.end) for r in rolled}
    assert result == {f"r{i}": expected for i, expected in enumerate(brute(rows, at_least))}


def test_count_keeps_unplaced_rows(tx):
    history = tx(("2025-01-01", 1), ("2025-01-01", 1, None), (None, 1))
    counts = {r.no_referensi: r.rolling_count for r in rolling_count(history, SPAN).collect()}
    assert counts == {"r0": 1, "r1": None, "r2": None}


def test_amount_that_is_no_amount_fails(tx):
    history = tx(("2025-01-01", float("nan")))
    with pytest.raises(Exception, match="transaction_amount"):
        trailing(history, [Total("amount", SPAN, money(), True)]).collect()


@pytest.mark.parametrize("zone", ["Asia/Jakarta", "America/New_York"])
def test_session_time_zone_does_not_matter(spark, tx, zone):
    """02:30 does not exist in New York on that day."""
    history = tx(
        ("2025-03-09T01:55:00", 1), ("2025-03-09T02:30:00", 1), ("2025-03-09T03:01:00", 1)
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for stretch in (None, timedelta(minutes=40)):
            rolled = rolling_count(history, timedelta(minutes=40), stretch=stretch)
            assert {r.no_referensi: r.rolling_count for r in rolled.collect()} == {
                "r0": 1, "r1": 2, "r2": 2,
            }
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_plan_has_one_wide_shuffle_and_no_join(tx):
    history = tx(("2025-01-01", 1))
    rolled = trailing(history, [Total("n", SPAN, F.lit(1), False)], [Burst("end", "n", 3, SPAN)])
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_stretch_covers_the_span(tx):
    with pytest.raises(ValueError, match="shorter"):
        trailing(tx(("2025-01-01", 1)), [Total("n", SPAN, F.lit(1), True)], stretch=SPAN)


def test_many_dense_accounts(tx):
    """Every account is as dense as any other; none is on a list, none is left out."""
    rows = [
        ((START + timedelta(seconds=second)).isoformat(), 1, f"a{account}")
        for account in range(300)
        for second in range(0, 3600, 300)
    ]
    counted = rolling_count(tx(*rows), SPAN)
    assert counted.groupBy("rolling_count").count().orderBy("rolling_count").collect() == [
        (1, 300), (2, 3300),
    ]


def test_building_runs_nothing(spark, tx):
    history = tx(*[(START.isoformat(), 1, f"a{i}") for i in range(50)])
    spark.sparkContext.setJobGroup("building", "")
    try:
        evaluate(BurstRule("r", "flag", SPAN, 3), history, START.date())
        evaluate(SumRule("r", "flag", SPAN, 3), history, START.date())
        flagged_refs([BurstRule("r", "flag", SPAN, 3)], history, START.date())
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_bursts_move_the_payload_past_no_account(tx):
    """Only account and time are shuffled to find bursts."""
    found = burst_rows(tx((START.isoformat(), 1)), SPAN, 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    inlined = next(line for line in plan if "Generate" in line)
    assert "to_bank_name" not in inlined and "no_referensi" not in inlined


@pytest.mark.parametrize("name", ["rolling_count", "sum24h_by_ref", "rule_non_qr_10min", "family_refs"])
@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_generated_methods_are_compiled(spark, name):
    """The JVM interprets methods of more than 8,000 bytes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution()
        stages = plan.debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) < 8000


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("burst", [False, True])
def test_few_rows_are_moved_twice(spark, burst):
    """Day-sized times: no more than a quarter more rows are shuffled than there are."""
    rows = transactions(spark, FOLDER, "lineitem").select(ACCOUNT, AT)
    days = timedelta(days=2)
    bursts = [Burst("end", "n", 4, days)] if burst else []
    rolled = trailing(rows, [Total("n", days, F.lit(1), False)], bursts)
    rolled.write.format("noop").mode("overwrite").save()
    spread = _spread(rows, [Total("n", days, F.lit(1), False)], bursts, ACCOUNT, AT, 8 * days)
    assert spread.count() <= 1.26 * rows.count()


@pytest.mark.parametrize("amount", [9_999_999_999_999_998.0, -9_999_999_999_999_998.0])
def test_sums_beyond_a_bigint(tx, amount):
    """Ten of these are more cents than a bigint can hold."""
    rows = [((START + timedelta(seconds=n)).isoformat(), amount) for n in range(40)]
    sums = {r.no_referensi: r.rolling_sum for r in rolling_sum(tx(*rows), SPAN).collect()}
    assert sums == {f"r{n}": Decimal(int(amount)) * (n + 1) for n in range(40)}
    by_ref = sum_by_ref(tx(*[(at, x, "A", "same") for at, x in rows]), SPAN).collect()
    assert [tuple(r) for r in by_ref] == [("same", Decimal(int(amount)) * (40 * 41 // 2))]


def test_cents_are_the_decimal(spark):
    """Halves of a cent, amounts of 15 digits and more, nothing at all."""
    amounts = [0.005, 1.005, 2.675, 1e15 / 3, 123456789012.34, 9007199254740993.0, -0.015, 1e-9, None]
    amounts += [random.Random(1).uniform(-1e9, 1e9) for _ in range(500)]
    rows = spark.createDataFrame([(x,) for x in amounts], f"{AMOUNT} double")
    wrong = rows.filter((cents().cast("decimal(38,2)") / 100).cast("decimal(20,2)") != money())
    assert wrong.count() == 0


def test_bursts_need_one_sort(tx):
    history = tx(("2025-01-01", 1))
    rolled = trailing(history, [Total("n", SPAN, F.lit(1), False)], [Burst("end", "n", 3, SPAN)])
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert sum(line.lstrip(" :+-*()0123456789").startswith("Sort [") for line in plan.split("\n")) == 1


def test_burst_span_is_covered_too(tx):
    counted = [Total("n", TICK, F.lit(1), False)]
    with pytest.raises(ValueError, match="shorter"):
        trailing(tx(("2025-01-01", 1)), counted, [Burst("end", "n", 1, SPAN)], stretch=TICK)
