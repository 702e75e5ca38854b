"""Joins, keys and flags on null and repeated reference numbers."""

import pytest
from pyspark.sql import functions as F

from txvigil.operators import deltas, flags, keys, ordering

T0, T1, T2 = "2025-01-01 00:00:00", "2025-01-01 00:00:01", "2025-01-01 00:00:02"


def flagged(rows, flag="flag"):
    return sorted((r.no_referensi or "", r[flag]) for r in rows.collect())


def with_flag(rows, value=0, flag="flag"):
    return rows.withColumn(flag, F.lit(value).cast("tinyint"))


def hits(spark, *refs, flag="flag"):
    return spark.createDataFrame([(r, 1) for r in refs], f"no_referensi string, {flag} tinyint")


def test_null_number_is_always_new(tx):
    history = tx((T0, 1, "A", None), (T0, 1, "A", "X"))
    daily = tx((T1, 1, "A", None), (T1, 1, "A", "X"), (T1, 1, "A", "Y"))
    new = deltas.delta_new(daily, history)
    assert new.columns == daily.columns
    assert sorted(r.no_referensi or "" for r in new.collect()) == ["", "Y"]


def test_symmetric_difference(tx, refs):
    history, daily = tx((T0, 1, "A", "X"), (T0, 1, "A", "Y")), tx((T0, 1, "A", "Y"), (T0, 1, "A", "Z"))
    assert refs(deltas.symmetric_difference(daily, history)) == ["X", "Z"]


def test_dedupe_takes_the_first_and_one_null(tx):
    rows = tx((T2, 2, "A", "X"), (T1, 1, "A", "X"), (T1, 3, "A", None), (T0, 4, "A", None))
    kept = keys.dedupe(rows, first_by=["transaction_date"]).collect()
    assert sorted((r.no_referensi or "", r.transaction_amount) for r in kept) == [("", 4), ("X", 1)]


def test_dedupe_limits_groups_before_the_shuffle(tx):
    plan = keys.dedupe(tx((T0, 1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_find_duplicates_counts_nulls(tx):
    rows = tx((T0, 1, "A", "X"), (T1, 1, "A", "X"), (T0, 1, "A", None), (T1, 1, "A", None), (T0, 1, "A", "Y"))
    found = keys.find_duplicates(rows).collect()
    assert sorted(r.no_referensi or "" for r in found) == ["", "", "X", "X"]


def test_semi_by_keys_ignores_nulls(tx, refs):
    rows = tx((T0, 1, "A", "X"), (T0, 1, "B", "X"), (T0, 1, None, "Y"))
    keyed = tx((T0, 1, "A", "X"), (T0, 1, None, "Y"))
    assert refs(keys.semi_by_keys(rows, keyed)) == ["X"]


def test_merge_by_max(spark):
    rows = spark.createDataFrame([("k", 0, None), ("k", 1, 2), ("l", None, None)], "k string, a int, b int")
    merged = keys.merge_by_max(rows, ["k"], ["a", "b"]).collect()
    assert sorted(tuple(r) for r in merged) == [("k", 1, 2), ("l", None, None)]


def test_flags_are_sticky(spark, tx):
    history = with_flag(tx((T0, 1, "A", "X")), 1).unionByName(with_flag(tx((T0, 1, "A", "Y"))))
    merged = flags.merge_flags(history, hits(spark, "Y"), ["flag"])
    assert flagged(merged) == [("X", 1), ("Y", 1)]
    assert merged.schema["flag"].dataType == history.schema["flag"].dataType
    assert flagged(flags.merge_flags(merged, hits(spark, "Y"), ["flag"])) == [("X", 1), ("Y", 1)]


def test_unknown_and_null_numbers_change_nothing(spark, tx):
    history = with_flag(tx((T0, 1, "A", "X"), (T0, 1, "A", None)))
    merged = flags.merge_flags(history, hits(spark, "Z", None), ["flag"])
    assert flagged(merged) == [("", 0), ("X", 0)]


def test_several_flags_in_one_merge(spark, tx):
    history = with_flag(with_flag(tx((T0, 1, "A", "X"), (T0, 1, "A", "Y"))), 0, "flag_b")
    both = spark.createDataFrame([("X", 1, 0), ("Y", 0, 1)], "no_referensi string, flag int, flag_b int")
    merged = flags.merge_flags(history, both, ["flag", "flag_b"])
    assert flagged(merged) == [("X", 1), ("Y", 0)]
    assert flagged(merged, "flag_b") == [("X", 0), ("Y", 1)]


def test_mark_by_both_keys(tx):
    history = with_flag(tx((T0, 1, "A", "X"), (T0, 1, "B", "X")))
    assert flagged(flags.mark_by_keys(history, tx((T1, 1, "B", "X"), (T2, 1, "B", "X")), "flag")) == [
        ("X", 0),
        ("X", 1),
    ]


def test_missing_and_boolean_flags(tx):
    rows = tx((T0, 1)).withColumn("flag_a", F.lit(True))
    rows = flags.add_missing_flags(flags.normalise_flags(rows, ["flag_a", "flag_b"]), ["flag_a", "flag_b"])
    assert dict(rows.dtypes)["flag_a"] == dict(rows.dtypes)["flag_b"] == "tinyint"
    assert [(r.flag_a, r.flag_b) for r in rows.collect()] == [(1, 0)]


@pytest.mark.parametrize("refs_, expected", [(["X"], True), (["X", "Y"], False), (["Z"], True)])
def test_all_flagged(spark, tx, refs_, expected):
    history = with_flag(tx((T0, 1, "A", "X")), 1).unionByName(with_flag(tx((T0, 1, "A", "Y"))))
    found = hits(spark, *refs_)
    assert flags.all_flagged(history, found, "flag").head().all_flagged is expected
    assert (flags.unflagged_count(history, found, "flag").head().unflagged == 0) is expected


def test_order(tx):
    rows = tx((T1, 1, "B"), (T1, 1, "A"), (T0, 1, "C"), (T2, 1, "A"))
    assert [r.no_referensi for r in ordering.sort_history(rows).collect()] == ["r2", "r1", "r0", "r3"]
    assert [r.no_referensi for r in ordering.latest(rows, 2).collect()] == ["r3", "r0"]
    assert [r.no_referensi for r in ordering.page(rows, 1, 2).collect()] == ["r0", "r1"]


@pytest.mark.parametrize("spread", ["hot", "null"])
@pytest.mark.parametrize("operator", ["anti", "duplicates", "merge", "mark"])
def test_large_partition_of_a_key_is_split(spark, operator, spread):
    """A third of all rows has the same reference number, or none."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        ids = spark.range(0, 60_000, 1, 4).withColumn("note", F.sha2(F.col("id").cast("string"), 256))
        ref = F.lit("same" if spread == "hot" else None)
        rows = ids.select(
            F.when(F.col("id") % 3 == 0, ref).otherwise(F.col("id").cast("string")).alias("no_referensi"),
            "note",
            F.lit(0).cast("tinyint").alias("flag"),
        )
        other = ids.filter("id % 3 = 1").select(F.col("id").cast("string").alias("no_referensi"))
        result = {
            "anti": lambda: deltas.rows_not_in(rows, other),
            "duplicates": lambda: keys.find_duplicates(rows),
            "merge": lambda: flags.merge_flags(
                rows, deltas.per_key(other, ["no_referensi"], F.max(F.lit(1)).alias("flag")), ["flag"]
            ),
            "mark": lambda: flags.mark_by_keys(rows, other, "flag", ["no_referensi"]),
        }[operator]()
        found = result.agg(F.count("*").alias("n"), F.max("note"))
        expected = {"anti": 40_000, "duplicates": 20_000}.get(operator, 60_000)
        assert found.head().n == expected
        found = result.agg(F.count("*").alias("n"), F.max("note"))
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
