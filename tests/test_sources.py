"""Drops and stored tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from txvigil.schema import TRANSACTION
from txvigil.sources import drops, tables

HEADER = "|".join(TRANSACTION.names)
DAY = date(2025, 1, 10)


def line(ref, at="2025-01-10 08:00:00", amount="12.5", status="0", state="1", bank="B"):
    return f"{at}|0012|Owner|77|To|{bank}|CCW|{status}|{amount}|IDR|MB|{state}|{ref}"


@pytest.fixture
def folder(tmp_path):
    def write(day, *lines, header=HEADER):
        (tmp_path / f"trx_history_{day}.csv").write_text("\n".join([header, *lines]) + "\n")

    write.drops = drops.Drops(str(tmp_path))
    return write


def test_selects_days_and_skips_missing_files(spark, folder):
    folder("20250110", line("1"))
    folder("20250108", line("2", at="2025-01-08 23:59:59.000001"))
    folder("20250107", line("3"))
    rows = drops.read_daily_drops(spark, folder.drops, DAY, 3)
    assert rows.schema == TRANSACTION
    result = {r.no_referensi: (r.transaction_date, r.from_account_number) for r in rows.collect()}
    assert result == {
        "1": (datetime(2025, 1, 10, 8), "0012"),
        "2": (datetime(2025, 1, 8, 23, 59, 59, 1), "0012"),
    }


def test_no_file_at_all(spark, folder):
    assert drops.read_daily_drops(spark, folder.drops, DAY, 3) is None


def test_null_tokens(spark, folder):
    texts = ["null", "NULL", "", "None", "none", " "]
    folder("20250110", *[line(i, bank=t) for i, t in enumerate(texts)])
    rows = drops.read_daily_drops(spark, folder.drops, DAY, 1).orderBy("no_referensi").collect()
    assert [r.to_bank_name for r in rows] == [None, None, None, None, "none", " "]


def test_null_numbers_and_amounts(spark, folder):
    folder("20250110", line("null", amount="null", status="None"))
    row = drops.read_daily_drops(spark, folder.drops, DAY, 1).head()
    assert (row.no_referensi, row.transaction_amount, row.transaction_status) == (None, None, None)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", [{"amount": "x"}, {"status": "300"}, {"at": "yesterday"}])
def test_value_that_does_not_fit_fails(spark, folder, bad, ansi):
    folder("20250110", line("1", **bad))
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a "):
            drops.read_daily_drops(spark, folder.drops, DAY, 1).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_quotes(spark, folder):
    folder("20250110", line("1", bank='"Bank ""X""|Y"'))
    assert drops.read_daily_drops(spark, folder.drops, DAY, 1).head().to_bank_name == 'Bank "X"|Y'


def test_line_with_too_many_fields_fails(spark, folder):
    folder("20250110", line("1") + "|more")
    with pytest.raises(Exception):
        drops.read_daily_drops(spark, folder.drops, DAY, 1).collect()


def test_extra_columns_stay(spark, folder):
    folder("20250110", line("1") + "|memo", header=HEADER + "|note")
    row = drops.read_daily_drops(spark, folder.drops, DAY, 1).head()
    assert row.note == "memo"


def test_missing_column_fails(spark, folder):
    folder("20250110", line("1"), header=HEADER.replace("no_referensi", "reference"))
    with pytest.raises(ValueError, match="no_referensi"):
        drops.read_daily_drops(spark, folder.drops, DAY, 1)


def test_headers_must_agree_unless_by_position(spark, folder):
    folder("20250110", line("1"))
    folder("20250109", line("2"), header=HEADER.replace("no_referensi", "reference"))
    with pytest.raises(Exception):
        drops.read_daily_drops(spark, folder.drops, DAY, 2).collect()
    rows = drops.read_daily_drops(spark, folder.drops, DAY, 2, by_position=True)
    assert sorted(r.no_referensi for r in rows.collect()) == ["1", "2"]


def test_rename_needs_a_name_for_every_column(spark):
    with pytest.raises(ValueError):
        drops.rename_by_position(spark.range(1), ["a", "b"])


def test_glob_scan_infers_types(spark, folder, tmp_path):
    folder("20250110", line("1"))
    folder("20250109", line("2"))
    rows = drops.read_all(spark, f"{tmp_path}/*.csv")
    assert rows.count() == 2
    assert dict(rows.dtypes)["transaction_amount"] == "double"


def days(rows):
    return sorted(str(r.event_date) for r in rows.select("event_date").distinct().collect())


def test_replace_reads_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(3):
        rows = tables.read_table(spark, path) if tables.table_exists(spark, path) else spark.range(2)
        tables.replace_table(rows.withColumn("id", F.col("id") + 1), path)
    assert sorted(r.id for r in tables.read_table(spark, path).collect()) == [3, 4]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_empty_table_keeps_its_schema(spark, tx, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(tx(("2025-01-01", 1)).filter("false"), path)
    assert tables.read_table(spark, path).schema == TRANSACTION


def test_replacing_days_leaves_the_others(spark, tx, tmp_path):
    path = str(tmp_path / "h")
    tables.replace_history(tx(("2025-01-01", 1), ("2025-01-02", 1), (None, 1)), path)
    rows = tables.read_table(spark, path)
    assert days(rows) == ["2025-01-01", "2025-01-02", "None"]
    changed = rows.withColumn("transaction_amount", F.lit(5.0))
    tables.replace_days(changed.filter("event_date = '2025-01-02' or event_date is null"), path)
    amounts = {r.no_referensi: r.transaction_amount for r in tables.read_table(spark, path).collect()}
    assert amounts == {"r0": 1, "r1": 5, "r2": 5}
    assert [p.name for p in tmp_path.iterdir()] == ["h"]


def test_history_without_rows_keeps_its_schema(spark, tx, tmp_path):
    path = str(tmp_path / "h")
    tables.replace_history(tx(("2025-01-01", 1)).filter("false"), path)
    assert tables.read_table(spark, path).columns == [*TRANSACTION.names, "event_date"]
    tables.append_history(tx(("2025-01-01", 1)), path)
    assert tables.read_table(spark, path).count() == 1


@pytest.mark.parametrize("days_only", [False, True])
def test_readers_see_the_whole_old_or_new_table(spark, tx, tmp_path, monkeypatch, days_only):
    """A reader at every step of a write; it changes nothing, and the write ends well."""
    path = str(tmp_path / "h")
    rows = tx(("2025-01-01", 1), ("2025-01-02", 1), ("2025-01-03", 1))
    tables.replace_history(rows, path)
    seen = []

    def look():
        found = tables.read_table(spark, path).collect()
        seen.append(sorted((r.no_referensi, r.transaction_amount) for r in found))

    for name in ("_write_days", "_tidy", "_publish"):
        real = getattr(tables, name)

        def looked(*args, real=real):
            look()
            result = real(*args)
            look()
            return result

        monkeypatch.setattr(tables, name, looked)
    new = tables.read_table(spark, path).withColumn("transaction_amount", F.lit(5.0))
    if days_only:
        tables.replace_days(new.filter("event_date = '2025-01-02'"), path)
    else:
        tables.replace_history(new, path)
    old = [("r0", 1.0), ("r1", 1.0), ("r2", 1.0)]
    changed = [("r0", 1.0), ("r1", 5.0), ("r2", 1.0)] if days_only else [(r, 5.0) for r, _ in old]
    assert seen[-1] == changed
    assert all(s in (old, changed) for s in seen) and old in seen


def test_what_a_crash_leaves_is_removed_by_the_next_write(spark, tmp_path):
    path = tmp_path / "t"
    tables.replace_table(spark.range(1), str(path))
    (path / "v=dead").mkdir()
    tables.replace_table(spark.range(2), str(path))
    assert not (path / "v=dead").exists()
    for n in range(3, 6):
        tables.replace_table(spark.range(n), str(path))
    # The current one, the one it replaced, and the one before, which the next write removes.
    assert len(list(path.glob("v=*"))) == 3
    assert not list(path.glob("*.tmp"))


def test_plain_parquet_is_taken_over(spark, tx, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    assert tables.read_table(spark, path).count() == 2
    tables.append_table(spark.range(1), path)
    assert tables.read_table(spark, path).count() == 3


def test_columns_may_be_added_but_not_changed(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(1), path)
    tables.append_table(spark.range(1).withColumn("note", F.lit("x")), path)
    assert sorted(str(r.note) for r in tables.read_table(spark, path).collect()) == ["None", "x"]
    with pytest.raises(ValueError, match="id"):
        tables.append_table(spark.range(1).selectExpr("'a' AS id"), path)
    assert tables.read_table(spark, path).count() == 2


def test_compression(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(1), path)
    tables.append_table(spark.range(1), path)
    assert len(list((tmp_path / "t").rglob("*.zstd.parquet"))) >= 2
