"""Pairs behind a flag: edges, ties, and what the plans move."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from txvigil.operators import pairs as joined
from txvigil.operators.pairs import burst_pairs, contributors

SPAN = timedelta(minutes=10)


def at(minute, us=0):
    return (datetime(2025, 1, 1, 8) + timedelta(minutes=minute, microseconds=us)).isoformat()


def test_every_burst_that_covers_a_row(tx):
    """Ends at 8, 10 and 12; the first row is a microsecond too early for the last one."""
    history = tx((at(2, -1), 1), (at(5), 1), (at(8), 1), (at(10), 1), (at(12), 1), (at(8), 1, "B"))
    found = burst_pairs(history, SPAN, 3).collect()
    pairs = sorted((r.no_referensi, r.transaction_date_right.minute, r.rolling_count) for r in found)
    assert pairs == [
        ("r0", 8, 1), ("r0", 10, 1), ("r1", 8, 2), ("r1", 10, 2), ("r1", 12, 2), ("r2", 8, 3),
        ("r2", 10, 3), ("r2", 12, 3), ("r3", 10, 4), ("r3", 12, 4), ("r4", 12, 4),
    ]
    assert all(r.t_start == r.transaction_date_right - SPAN for r in found)


def test_tied_rows_are_one_end(tx):
    history = tx((at(0), 1), (at(0), 1), (at(0), 1), (None, 1), (at(0), 1, None))
    assert sorted(r.no_referensi for r in burst_pairs(history, SPAN, 3).collect()) == ["r0", "r1", "r2"]


def test_what_a_sum_is_made_of(tx):
    """Both edges count; a repeated number has the contributors of each of its transactions."""
    history = tx(
        (at(0), 5), (at(10), 6), (at(10, 1), 7), (at(10), None), (at(0), 50, "B"), (at(30), 4, "A", "x"),
        (at(60), 9, "C", "x"), (at(60), 1, None),
    )
    found = contributors(history, SPAN, 11).collect()
    assert sorted((r.no_referensi, r.no_referensi_r, float(r.rolling_sum)) for r in found) == [
        ("r1", "r0", 11.0), ("r1", "r1", 11.0), ("r1", "r3", 11.0),
        ("r2", "r1", 13.0), ("r2", "r2", 13.0), ("r2", "r3", 13.0),
        ("r3", "r0", 11.0), ("r3", "r1", 11.0), ("r3", "r3", 11.0),
        ("r4", "r4", 50.0), ("x", "x", 13.0), ("x", "x", 13.0),
    ]
    assert contributors(history, SPAN, 1000).count() == 0
    later = F.col("transaction_date") > F.lit(at(20)).cast("timestamp_ntz")
    assert {r.no_referensi for r in contributors(history, SPAN, 11, later).collect()} == {"x"}


def test_range_joins_have_a_bucket_in_their_key(tx):
    for found in (burst_pairs(tx((at(0), 1)), SPAN, 3), contributors(tx((at(0), 1)), SPAN, 3)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        ranges = [line for line in plan.splitlines() if "Join" in line and ">=" in line]
        assert ranges and all("_bucket" in line for line in ranges)
        assert "Cartesian" not in plan and "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_few_rows_are_in_two_buckets(spark):
    """A day-sized time is moved about 1.25 times, and every row is found in its own bucket."""
    days = spark.range(4000).selectExpr("timestamp_ntz '2025-01-01' + make_dt_interval(id) AS at")
    moved = joined._bucketed(days, "at", timedelta(days=2), back=True)
    assert moved.select("at").distinct().count() == 4000
    assert 4000 <= moved.count() <= 1.3 * 4000
