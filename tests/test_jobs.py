"""Ingest, rule runs, flag merges and whole family runs on small drops."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txvigil.plans import jobs
from txvigil.plans.families import CCW, FAMILIES, TF_ONLINE
from txvigil.plans.jobs import (
    Ingested,
    ingest,
    new_rows,
    output_refs,
    run_family,
    run_rule,
    update_flags,
)
from txvigil.plans.rules import evaluate, flagged_refs, flagged_rows, output_of, with_rows
from txvigil.schema import TRANSACTION
from txvigil.sources import tables
from txvigil.sources.drops import Drops

HEADER = "|".join(TRANSACTION.names)
DAY = date(2025, 1, 10)


def line(ref, at, amount=1, category="CCW", status=0, account="A"):
    return f"{at}|{account}|Owner|77|To|B|{category}|{status}|{amount}|IDR|MB|1|{ref}"


@pytest.fixture
def site(spark, tmp_path):
    class Site:
        drops = Drops(str(tmp_path / "in"))
        history = str(tmp_path / "history")
        outputs = str(tmp_path / "out")

        def drop(self, day, *lines):
            (tmp_path / "in").mkdir(exist_ok=True)
            (tmp_path / "in" / f"trx_history_{day}.csv").write_text("\n".join([HEADER, *lines]) + "\n")

        def rows(self, *columns):
            found = tables.read_table(spark, self.history).select("no_referensi", *columns).collect()
            return sorted(tuple(r) for r in found)

        def files(self):
            return {str(p.relative_to(tmp_path)) for p in (tmp_path / "history").rglob("*.parquet")}

    return Site()


def test_ingest(spark, site):
    site.drop(
        "20250110",
        line("a", "2025-01-10 08:00:00"),
        line("a", "2025-01-10 07:00:00"),
        line("null", "2025-01-10 08:00:00"),
        line("b", "2025-01-10 08:00:00", status=1),
        line("c", "2025-01-10 08:00:00", category="OTHER"),
    )
    site.drop("20250109", line("d", "2025-01-09 08:00:00"))
    rejects = f"{site.outputs}/rejects"
    first = ingest(spark, CCW, site.drops, site.history, DAY, rejects_path=rejects)
    assert first == Ingested(added=2, rejected=1)
    assert site.rows("transaction_date", "flag") == [
        ("a", datetime(2025, 1, 10, 7), 0),
        ("d", datetime(2025, 1, 9, 8), 0),
    ]
    assert tables.read_table(spark, rejects).count() == 1

    before = site.files()
    again = ingest(spark, CCW, site.drops, site.history, DAY)
    assert again.added == 0
    assert site.files() == before

    site.drop("20250111", line("a", "2025-01-11 08:00:00"), line("e", "2025-01-11 08:00:00"))
    assert ingest(spark, CCW, site.drops, site.history, date(2025, 1, 11)).added == 1
    assert site.rows() == [("a",), ("d",), ("e",)]
    assert before < site.files()


def test_ingest_without_drops_or_eligible_rows(spark, site):
    assert ingest(spark, CCW, site.drops, site.history, DAY) == Ingested()
    site.drop("20250110", line("a", "2025-01-10 08:00:00", category="OTHER"))
    assert ingest(spark, CCW, site.drops, site.history, DAY).added == 0
    assert site.rows() == []
    site.drop("20250110", line("a", "2025-01-10 08:00:00"))
    assert ingest(spark, CCW, site.drops, site.history, DAY).added == 1
    site.drop("20250110", line("a", "2025-01-10 08:00:00", category="OTHER"))
    assert ingest(spark, CCW, site.drops, site.history, DAY).added == 0
    assert site.rows() == [("a",)]


def test_ingest_updates_the_flags_of_an_old_history(spark, tx, site):
    old = tx(("2025-01-01", 1, "A", "old")).withColumn("flag_5min", F.lit(True))
    tables.replace_history(old, site.history)
    site.drop("20250110", line("new", "2025-01-10 08:00:00", category="TRANSFER_OA"))
    assert ingest(spark, TF_ONLINE, site.drops, site.history, DAY).added == 1
    assert site.rows(*TF_ONLINE.flags) == [("new", 0, 0, 0, 0), ("old", 1, 0, 0, 0)]


def test_ingest_refuses_other_columns(spark, tx, site):
    tables.replace_history(tx(("2025-01-01", 1)).withColumn("note", F.lit("x")), site.history)
    site.drop("20250110", line("new", "2025-01-10 08:00:00"))
    with pytest.raises(ValueError, match="note"):
        ingest(spark, CCW, site.drops, site.history, DAY)


def test_failing_drop_leaves_the_history(spark, site):
    site.drop("20250110", line("a", "2025-01-10 08:00:00"))
    ingest(spark, CCW, site.drops, site.history, DAY)
    before = site.files()
    site.drop("20250110", line("b", "2025-01-10 08:00:00", amount="much"))
    with pytest.raises(Exception, match="transaction_amount"):
        ingest(spark, CCW, site.drops, site.history, DAY)
    assert site.files() == before


def test_only_days_with_new_flags_are_rewritten(spark, site):
    site.drop("20250110", line("a", "2025-01-10 08:00:00"), line("b", "2025-01-09 08:00:00"))
    ingest(spark, CCW, site.drops, site.history, DAY)
    before = site.files()
    hits = spark.createDataFrame(
        [("a", DAY, 1), ("z", DAY, 1)], "no_referensi string, event_date date, flag tinyint"
    )
    assert update_flags(spark, CCW, site.history, hits) == 1
    assert site.rows("flag") == [("a", 1), ("b", 0)]
    after = site.files()
    assert {f for f in before if "2025-01-09" in f} == {f for f in after if "2025-01-09" in f}
    assert {f for f in before if "2025-01-10" in f} != {f for f in after if "2025-01-10" in f}

    assert update_flags(spark, CCW, site.history, hits) == 0
    assert site.files() == after


def hit(spark, ref, day, flag):
    return spark.createDataFrame([(ref, day, 1)], f"no_referensi string, event_date date, {flag} tinyint")


def plain_history(tx, path, **flags):
    rows = tx(*[(f"2025-01-0{day}", 1, "A", f"r{day}") for day in range(1, 6)])
    rows = rows.withColumns({name: F.lit(value) for name, value in flags.items()})
    rows.withColumn("event_date", F.to_date("transaction_date")).write.partitionBy("event_date").parquet(path)


@pytest.mark.parametrize("first", [1, 3, 5])
def test_merging_a_flag_the_history_lacks(spark, tx, site, first):
    plain_history(tx, site.history)
    for day in (first, 4, 2):
        found = hit(spark, f"r{day}", date(2025, 1, day), "flag_10min")
        assert update_flags(spark, TF_ONLINE, site.history, found) == 1
        assert update_flags(spark, TF_ONLINE, site.history, found) == 0
    rows = tables.read_history(spark, site.history, TF_ONLINE.flags).collect()
    assert {r.no_referensi: r.flag_10min for r in rows} == {
        f"r{day}": int(day in (first, 4, 2)) for day in range(1, 6)
    }
    assert {(r.flag_5min, r.flag_50mio, r.flag_50mio_early) for r in rows} == {(0, 0, 0)}


def test_merging_into_boolean_flags(spark, tx, site):
    plain_history(tx, site.history, flag=True)
    assert update_flags(spark, CCW, site.history, hit(spark, "r3", date(2025, 1, 3), "flag")) == 0
    plain = f"{site.history}2"
    plain_history(tx, plain, flag=False)
    found = hit(spark, "r3", date(2025, 1, 3), "flag")
    assert [update_flags(spark, CCW, plain, found) for _ in range(2)] == [1, 0]
    rows = tables.read_history(spark, plain, CCW.flags).collect()
    assert {r.no_referensi: r.flag for r in rows} == {f"r{d}": int(d == 3) for d in range(1, 6)}


def test_merge_reads_only_the_days_of_its_hits(spark, tx, site, monkeypatch):
    rows = tx(("2025-01-09", 1), ("2025-01-10", 1)).withColumn("flag", F.lit(0).cast("tinyint"))
    tables.replace_history(rows, site.history)
    plans = []
    real = jobs.replace_table

    def kept(rows, path):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return real(rows, path)

    monkeypatch.setattr(jobs, "replace_table", kept)
    assert update_flags(spark, CCW, site.history, hit(spark, "r1", DAY, "flag")) == 1
    for scan in plans[0].split("FileScan")[1:]:
        assert "to_bank_name" not in scan and "transaction_amount" not in scan
        if "event_date" in scan:
            assert "event_date" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_ingest_filters_the_history_before_comparing(spark, tx):
    history, daily = tx(*[("2025-01-01", 1)] * 50), tx(("2025-01-02", 1))
    plan = new_rows(daily, history)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" in plan and "Aggregate" not in plan


def test_old_outputs_can_be_cut_off(spark, tx, site):
    path = f"{site.outputs}/ccw"
    tables.replace_table(tx(("2025-01-07", 1), ("2025-01-08", 1), ("2025-01-10", 1)), path)
    hits = output_refs(spark, {"flag": path, "other": f"{site.outputs}/none"}, DAY, 2)
    assert sorted(tuple(r) for r in hits.collect()) == [("r1", 1, 0), ("r2", 1, 0)]
    assert output_refs(spark, {"flag": f"{site.outputs}/none"}) is None


def test_rule_run_replaces_a_stale_output(spark, tx, site):
    tables.replace_history(tx(("2025-01-10", 1)).withColumn("flag", F.lit(0).cast("tinyint")), site.history)
    path, rule = f"{site.outputs}/ccw", CCW.rules[0]
    loose = replace(rule, at_least=1)
    assert run_rule(spark, loose, CCW, site.history, path, DAY) == 1
    schema = tables.read_table(spark, path).schema
    assert run_rule(spark, rule, CCW, site.history, path, DAY) == 0
    assert tables.read_table(spark, path).count() == 0
    assert tables.read_table(spark, path).schema == schema


@pytest.mark.parametrize("outputs", [True, False])
def test_family_run(spark, site, outputs):
    family = FAMILIES["tf_online"]
    site.drop(
        "20250109",
        *[line(f"burst{i}", f"2025-01-09 12:0{i}:00", category="TRANSFER_OA") for i in range(5)],
        line("first", "2025-01-09 13:00:00", 30e6, "TRANSFER_ON_US", account="B"),
        line("early", "2025-01-09 05:00:00", 50e6, "TRANSFER_OFF_US", account="C"),
    )
    run = run_family(
        spark, family, site.drops, site.history, site.outputs, date(2025, 1, 9), outputs=outputs
    )
    # (12:00, 12:04] holds five transactions within five minutes
    flags = {r[0]: r[1:] for r in site.rows(*family.flags)}
    assert flags == {
        **{f"burst{i}": (1, 0, 0, 0) for i in range(5)},
        "first": (0, 0, 0, 0),
        "early": (0, 0, 1, 1),
    }
    assert (run["added"], run["updated"]) == (7, 6)

    site.drop("20250110", line("second", "2025-01-10 13:00:00", 20e6, "TRANSFER_OA", account="B"))
    run = run_family(spark, family, site.drops, site.history, site.outputs, DAY, outputs=outputs)
    assert (run["added"], run["updated"]) == (1, 1)
    flags |= {"second": (0, 0, 1, 0)}
    assert {r[0]: r[1:] for r in site.rows(*family.flags)} == flags

    run = run_family(spark, family, site.drops, site.history, site.outputs, DAY, outputs=outputs)
    assert (run["added"], run["updated"]) == (0, 0)
    assert {r[0]: r[1:] for r in site.rows(*family.flags)} == flags


def test_family_run_without_drops(spark, site):
    assert run_family(spark, CCW, site.drops, site.history, site.outputs, DAY) == {"added": 0}


@pytest.mark.parametrize("name", [n for n in FAMILIES if n != "tf_online"])
def test_every_family_flags_its_categories(spark, site, name):
    family = FAMILIES[name]
    span = timedelta(minutes=1)
    lines = [
        line(f"{c}{i}", datetime(2025, 1, 10, 12) + i * span, 2e6, c, account=c)
        for c in family.categories
        for i in range(5)
    ]
    site.drop("20250110", *lines, line("other", "2025-01-10 12:00:00", 9e9, "OTHER"))
    run_family(spark, family, site.drops, site.history, site.outputs, DAY, n_days=1, outputs=False)
    expected = []
    for c in family.categories:
        for i in range(5):
            sums = (int(i >= 2),) if len(family.flags) == 2 else ()
            expected.append((f"{c}{i}", 1, *sums))
    assert site.rows(*family.flags) == sorted(expected)


def test_merging_flags_writes_no_transactions(spark, tx, site):
    rows = tx(("2025-01-09", 1), ("2025-01-10", 1)).withColumn("flag", F.lit(0).cast("tinyint"))
    tables.replace_history(rows, site.history)
    before = site.files()
    assert update_flags(spark, CCW, site.history, hit(spark, "r1", DAY, "flag")) == 1
    (new,) = site.files() - before
    written = spark.read.parquet(f"{site.history}/../{new}")
    assert set(written.columns) <= {"no_referensi", "flag"} and before <= site.files()
    assert site.rows("flag") == [("r0", 0), ("r1", 1)]
    plan = tables.read_table(spark, site.history).select("no_referensi")._jdf.queryExecution()
    assert "Join" not in plan.optimizedPlan().toString()


def test_compaction(spark, tx, site):
    """Thirty appends to two days and flags in between; a reader before, at and after each step."""
    for n in range(30):
        row = tx((f"2025-01-0{1 + n % 2}", 1, "A", f"r{n:02}")).withColumn("flag", F.lit(0).cast("tinyint"))
        tables.append_history(row, site.history)
    early = hit(spark, "r00", date(2025, 1, 1), "flag")
    assert update_flags(spark, CCW, site.history, early) == 1
    late = hit(spark, "r03", date(2025, 1, 2), "flag")
    assert update_flags(spark, CCW, site.history, late) == 1
    reader = tables.read_table(spark, site.history)
    before = site.rows("flag")
    assert before == [(f"r{n:02}", int(n in (0, 3))) for n in range(30)]
    assert tables.compact_history(spark, site.history) == 2
    assert site.rows("flag") == before and reader.count() == 30
    pointer = tables._pointer(spark, site.history)
    assert len(pointer["parts"]) == 2 and not pointer["flags"]
    assert tables.compact_history(spark, site.history) == 0
    assert update_flags(spark, CCW, site.history, early) == 0
    assert update_flags(spark, CCW, site.history, hit(spark, "r02", date(2025, 1, 1), "flag")) == 1
    assert tables.compact_history(spark, site.history) == 1
    assert site.rows("flag") == [(f"r{n:02}", int(n in (0, 2, 3))) for n in range(30)]


def _daily(site, day):
    """Bursts and sums across midnight, a late transaction of an earlier day among the third drop."""
    d = f"2025-01-{day:02}"
    rows = [line(f"a{day}{i}", f"{d} 23:5{6 + i}:00", 1e6, "TRANSFER_OA", account="A") for i in range(3)]
    rows += [line(f"b{day}{i}", f"{d} 00:00:{10 + i}", 1e6, "TRANSFER_OA", account="A") for i in range(2)]
    rows += [line(f"s{day}", f"{d} {20 - day}:00:00", 26e6, "TRANSFER_ON_US", account="S")]
    if day == 9:
        rows += [line("late", "2025-01-07 12:30:00", 30e6, "TRANSFER_ON_US", account="S")]
    site.drop(f"202501{day:02}", *rows)


def test_three_continued_runs_are_one_whole_run(spark, site, tmp_path):
    family, days = FAMILIES["tf_online"], (7, 8, 9)
    for day in days:
        _daily(site, day)
        run_family(
            spark, family, site.drops, site.history, site.outputs, date(2025, 1, day), 1,
            outputs=False, continued=True,
        )
    whole = str(tmp_path / "whole")
    run_family(spark, family, site.drops, whole, f"{whole}_out", date(2025, 1, 9), 3, outputs=False)
    expected = tables.read_table(spark, whole).select("no_referensi", *family.flags).collect()
    assert site.rows(*family.flags) == sorted(tuple(r) for r in expected)
    flagged = {r[0] for r in site.rows(*family.flags) if any(r[1:])}
    assert {"b80", "s7", "s8", "s9"} <= flagged and "late" not in flagged


def test_continued_run_prunes_old_days(spark, tx, site, monkeypatch):
    family = FAMILIES["tf_online"]
    rows = tx(*[(f"2025-01-0{d}", 1) for d in range(1, 9)], transaction_category="TRANSFER_OA")
    tables.replace_history(rows.withColumns({f: F.lit(0).cast("tinyint") for f in family.flags}), site.history)
    run = dict(outputs=False, continued=True)
    run_family(spark, family, site.drops, site.history, site.outputs, date(2025, 1, 8), 1, **run)
    site.drop("20250109", line("n", "2025-01-09 12:00:00", category="TRANSFER_OA"))
    seen = []
    real = jobs.flagged_rows

    def kept(rules, history, *others):
        seen.append(sorted(str(r[0]) for r in history.select("event_date").distinct().collect()))
        plan = history._jdf.queryExecution().executedPlan().toString()
        if len(seen) == 1:
            assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
        return real(rules, history, *others)

    monkeypatch.setattr(jobs, "flagged_rows", kept)
    run_family(spark, family, site.drops, site.history, site.outputs, date(2025, 1, 9), 1, **run)
    assert seen == [["2025-01-08", "2025-01-09"]]
    tables.compact_history(spark, site.history, 1)
    run_family(spark, family, site.drops, site.history, site.outputs, date(2025, 1, 9), 1, **run)
    assert seen[1:] == [[]]
    tighter = replace(family, rules=(replace(family.rules[0], at_least=4), *family.rules[1:]))
    run_family(spark, tighter, site.drops, site.history, site.outputs, date(2025, 1, 9), 1, **run)
    assert len(seen[2]) == 9 and len(seen) == 3


def test_found_rows_give_the_outputs_of_every_rule(spark, tx):
    """With repeated and missing numbers, ties and rules of other lookbacks."""
    at = [f"2025-01-10T12:0{i % 7}:0{i % 3}" for i in range(60)]
    history = tx(*[
        (t, 2e7 * (i % 4), f"acc{i % 3}", None if i % 11 == 0 else f"r{i % 25}") for i, t in enumerate(at)
    ])
    rules = FAMILIES["tf_online"].rules
    rows = with_rows(history, flagged_rows(rules, history, DAY), rules)
    for rule in rules:
        expected, found = evaluate(rule, history, DAY), output_of(rule, rows, rules, DAY)
        assert found.columns == expected.columns and found.dtypes == expected.dtypes
        assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)


def test_lookback_prunes_days_and_columns(spark, tx, site):
    tables.replace_history(tx(("2025-01-01", 1), ("2025-01-10", 1)), site.history)
    history = tables.read_history(spark, site.history, CCW.flags)
    for found in (evaluate(CCW.rules[0], history, DAY, CCW.flags), flagged_refs(CCW.rules, history, DAY)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "PushedFilters: [IsNotNull(transaction_date)" in plan
    assert "to_bank_name" not in plan
