"""Stored tables: Parquet folders with versions, a history among them partitioned by day.

A table ``t`` holds folders ``v=<id>``, one per write, and the file ``_current``, which lists the
folders that make up the table now (for a history ``v=<id>/event_date=<day>``) and its columns.
A write adds a folder and then replaces that one small file, so a reader finds the whole old
table or the whole new one and never changes anything. One writer at a time: a write begins
by removing what neither the current nor the previous list names, such as the folder of a run
that was cut short. A reader may thus finish on the table that the last write has replaced,
but not on one before.

Flags that are merged into a history are not written into its days. They are folders
``f=<id>/event_date=<day>`` of reference numbers and flags, which the list names beside the days
and a reader joins. ``compact_history`` folds them in, and puts the parts of a day together.

A folder without ``_current`` is read as plain Parquet; its first change writes it as a version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from txvigil.operators.flags import add_missing_flags, fill_flags, normalise_flags
from txvigil.schema import ACCOUNT, AT, EVENT_DATE, FLAG_TYPE, REF
from txvigil.sources.files import children, exists, read_text, remove, replace_text

_POINTER, _VERSION, _FLAGS = "_current", "v", "f"
_OURS = (f"{_VERSION}=", f"{_FLAGS}=")
# Spark's name for the folder of rows without a day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def table_exists(spark: SparkSession, path: str) -> bool:
    return _pointer(spark, path) is not None or _plain(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now; columns that older parts lack are null there."""
    pointer = _pointer(spark, path)
    if pointer is None:
        return spark.read.option("mergeSchema", True).parquet(path)
    schema = T.StructType.fromJson(pointer["schema"])
    if not pointer["parts"]:
        return spark.createDataFrame([], schema)
    rows = _read_parts(spark, path, pointer["parts"], schema, _VERSION)
    return _with_flags(spark, path, pointer, rows) if pointer.get("flags") else rows


def _read_parts(
    spark: SparkSession, path: str, parts: list[str], schema: T.StructType, kind: str
) -> DataFrame:
    """Only folders that are listed are read; they are told by the first part of their name."""
    typed = T.StructType([*schema.fields, T.StructField(kind, T.StringType())])
    rows = spark.read.schema(typed).option("basePath", path)
    return rows.parquet(*[f"{path}/{part}" for part in parts]).select(*schema.names)


def _with_flags(spark: SparkSession, path: str, pointer: dict, rows: DataFrame) -> DataFrame:
    """Sets the flags that were merged since the days were written.

    They are a row per number and day, so a reader that takes no flags does without the join.
    """
    names = pointer["flag_columns"]
    fields = [T.StructField(name, FLAG_TYPE) for name in names]
    key = [T.StructField(REF, T.StringType()), T.StructField(EVENT_DATE, T.DateType())]
    hits = _read_parts(spark, path, pointer["flags"], T.StructType([*fields, *key]), _FLAGS)
    # No day is a day of its own; Spark then knows the keys to be unique.
    day = F.coalesce(EVENT_DATE, F.lit("0001-01-01").cast("date"))
    hits = hits.groupBy(F.col(REF).alias("_ref"), day.alias("_day")).agg(
        *[F.max(name).alias(f"_hit_{name}") for name in names]
    )
    same = (F.col(REF) == F.col("_ref")) & (day == F.col("_day"))
    merged = {
        name: F.when(F.col(f"_hit_{name}") == 1, F.lit(1)).otherwise(F.col(name)).cast(FLAG_TYPE)
        for name in names
    }
    return rows.join(hits, same, "left").withColumns(merged).select(rows.columns)


def read_history(spark: SparkSession, path: str, flags: list[str]) -> DataFrame:
    """History with all its flags as 0/1, also where a part or the whole lacks them."""
    rows = normalise_flags(read_table(spark, path), flags)
    return fill_flags(add_missing_flags(rows, flags), flags)


def parts_by_day(spark: SparkSession, path: str) -> dict[str, date | None] | None:
    """The folders that rows of a history came in, with their days; None for plain Parquet.

    A folder that was made of others with the same rows counts as these.
    """
    pointer = _pointer(spark, path)
    if pointer is None:
        return None
    sources = pointer.get("sources", {})
    parts = [old for part in pointer["parts"] for old in sources.get(part, [part])]
    days = {part: part.split("=")[-1] for part in parts}
    return {part: None if day == _NO_DAY else date.fromisoformat(day) for part, day in days.items()}


def _pointer(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, f"{path}/{_POINTER}")
    return None if text is None else json.loads(text)


def _plain(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder that other means have written, not just a first try of ours."""
    if not exists(spark, path):
        return False
    names = children(spark, path, folders=False)
    return any(not name.startswith((*_OURS, "_", ".")) for name in names)


def _publish(
    spark: SparkSession,
    path: str,
    parts: list[str],
    schema: T.StructType,
    before: dict | None,
    flags: Sequence[str] = (),
    flag_columns: Sequence[str] = (),
    same_rows: Mapping[str, list[str]] | None = None,
) -> None:
    """``same_rows`` names the parts whose rows a new part holds once more."""
    pointer = {"parts": parts, "flags": list(flags), "flag_columns": list(flag_columns)}
    pointer |= {"schema": schema.jsonValue(), "before": [], "sources": {}}
    if before is not None:
        pointer["before"] = [*before["parts"], *before.get("flags", [])]
        known = before.get("sources", {})
        for part, sources in (same_rows or {}).items():
            known = known | {part: [old for source in sources for old in known.get(source, [source])]}
        current = set(parts)
        pointer["sources"] = {part: sources for part, sources in known.items() if part in current}
    replace_text(spark, f"{path}/{_POINTER}", json.dumps(pointer))


def _tidy(spark: SparkSession, path: str) -> dict | None:
    """Removes versions and days that no list names any more; returns the current list."""
    pointer = _pointer(spark, path)
    if pointer is None:
        if exists(spark, path):
            for name in children(spark, path):
                if name.startswith(_OURS):
                    remove(spark, f"{path}/{name}")
        return None
    named = {*pointer["parts"], *pointer["before"], *pointer.get("flags", [])}
    versions = {part.split("/")[0] for part in named}
    for name in children(spark, path):
        if name.startswith(_OURS) and name not in versions:
            remove(spark, f"{path}/{name}")
        elif name in versions and name not in named:
            for day in children(spark, f"{path}/{name}"):
                if f"{name}/{day}" not in named:
                    remove(spark, f"{path}/{name}/{day}")
    return pointer


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Counts rows while they are written.

    To be put on top of a plan: what lies below an empty shuffle is dropped at run time,
    and the count with it.
    """
    written = Observation()
    return rows.observe(written, F.count("*").alias("rows")), written


def _version(kind: str = _VERSION) -> str:
    return f"{kind}={uuid.uuid4().hex}"


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both; a column that both have must have the same type."""
    known = {field.name: field for field in old.fields}
    for field in new.fields:
        if field.name in known and known[field.name].dataType != field.dataType:
            raise ValueError(f"column {field.name} is {known[field.name].dataType.simpleString()}")
    return T.StructType([*old.fields, *[f for f in new.fields if f.name not in known]])


def _write(rows: DataFrame, path: str) -> tuple[str, int]:
    """A new version of plain rows: its folder and the number of rows."""
    version = _version()
    rows, written = _counted(rows)
    rows.write.option("compression", "zstd").parquet(f"{path}/{version}")
    return version, written.get["rows"]


def _write_days(rows: DataFrame, path: str) -> tuple[list[str], int, T.StructType]:
    """A new version of rows by day: its folders, the number of rows and the columns.

    Days are balanced before writing, so a large day becomes several files and a small one
    does not become many.
    """
    version = _version()
    dated = rows.drop(EVENT_DATE).withColumn(EVENT_DATE, F.to_date(AT))
    schema = dated.schema
    dated = dated.hint("rebalance", EVENT_DATE)
    rows, written = _counted(dated.sortWithinPartitions(EVENT_DATE, AT, ACCOUNT))
    rows.write.option("compression", "zstd").partitionBy(EVENT_DATE).parquet(f"{path}/{version}")
    days = children(rows.sparkSession, f"{path}/{version}")
    return [f"{version}/{day}" for day in days], written.get["rows"], schema


def write_table(rows: DataFrame, path: str) -> int:
    """A new table; this and the other writers return the number of rows."""
    if table_exists(rows.sparkSession, path):
        raise FileExistsError(path)
    return replace_table(rows, path)


def append_table(rows: DataFrame, path: str) -> int:
    spark = rows.sparkSession
    before = _tidy(spark, path)
    if before is None and _plain(spark, path):
        replace_table(read_table(spark, path), path)
        before = _pointer(spark, path)
    version, written = _write(rows, path)
    if before is None:
        _publish(spark, path, [version], rows.schema, None)
    else:
        schema = _merged(T.StructType.fromJson(before["schema"]), rows.schema)
        _publish(spark, path, [*before["parts"], version], schema, before)
    return written


def replace_table(rows: DataFrame, path: str) -> int:
    """Replaces the whole table, also by rows that are computed from it."""
    spark = rows.sparkSession
    before = _tidy(spark, path)
    version, written = _write(rows, path)
    _publish(spark, path, [version], rows.schema, before)
    return written


def write_history(rows: DataFrame, path: str) -> int:
    """A new history: pruned by lookback, and rewritten one day at a time."""
    if table_exists(rows.sparkSession, path):
        raise FileExistsError(path)
    return replace_history(rows, path)


def append_history(rows: DataFrame, path: str) -> int:
    spark = rows.sparkSession
    before = _versioned(spark, path)
    parts, written, schema = _write_days(rows, path)
    if before is None:
        _publish(spark, path, parts, schema, None)
        return written
    schema = _merged(T.StructType.fromJson(before["schema"]), schema)
    parts = [*before["parts"], *parts]
    _publish(spark, path, parts, schema, before, *_flags_of(before))
    return written


def replace_history(rows: DataFrame, path: str) -> int:
    """Replaces the whole history, also by rows that are computed from it."""
    spark = rows.sparkSession
    before = _tidy(spark, path)
    parts, written, schema = _write_days(rows, path)
    _publish(spark, path, parts, schema, before)
    return written


def replace_days(rows: DataFrame, path: str) -> int:
    """Replaces those days of the history that occur in the rows."""
    return _replace_days(rows, path, same_rows=False)


def _replace_days(rows: DataFrame, path: str, same_rows: bool) -> int:
    spark = rows.sparkSession
    before = _versioned(spark, path)
    if before is None:
        return replace_history(rows, path)
    parts, written, schema = _write_days(rows, path)
    days = {part.split("/")[1] for part in parts}
    kept = [part for part in before["parts"] if part.split("/")[1] not in days]
    flags, columns = _flags_of(before)
    flags = [part for part in flags if part.split("/")[1] not in days]
    schema = _merged(T.StructType.fromJson(before["schema"]), schema)
    sources = {}
    if same_rows:
        old = _per_day(before["parts"])
        sources = {part: old.get(part.split("/")[1], []) for part in parts}
    _publish(spark, path, [*kept, *parts], schema, before, flags, columns, sources)
    return written


def append_flags(hits: DataFrame, path: str) -> int:
    """Merges flags into the history without writing any of its days.

    ``hits`` has a reference number, its day, and one 0/1 column per flag.
    """
    spark = hits.sparkSession
    before = _versioned(spark, path)
    names = [c for c in hits.columns if c not in (REF, EVENT_DATE)]
    version = _version(_FLAGS)
    rows, written = _counted(hits.select(REF, *names, EVENT_DATE).hint("rebalance", EVENT_DATE))
    rows.write.option("compression", "zstd").partitionBy(EVENT_DATE).parquet(f"{path}/{version}")
    flags, columns = _flags_of(before)
    new = [f"{version}/{day}" for day in children(spark, f"{path}/{version}")]
    schema = T.StructType.fromJson(before["schema"])
    last = [field for field in schema.fields if field.name == EVENT_DATE]
    first = [field for field in schema.fields if field.name != EVENT_DATE]
    added = [T.StructField(name, FLAG_TYPE) for name in names if name not in schema.names]
    schema = T.StructType([*first, *added, *last])
    _publish(spark, path, before["parts"], schema, before, [*flags, *new], sorted({*columns, *names}))
    return written.get["rows"]


def compact_history(spark: SparkSession, path: str, at_least: int = 2) -> int:
    """Writes days anew that are in so many pieces, parts and flags; returns how many days.

    The rows stay the same, the flags are folded in, and readers see the old or the new folders.
    """
    before = _versioned(spark, path)
    if before is None:
        return 0
    pieces = _per_day([*before["parts"], *_flags_of(before)[0]])
    days = [day.split("=")[1] for day, parts in pieces.items() if len(parts) >= at_least]
    if days:
        chosen = F.col(EVENT_DATE).isin([date.fromisoformat(day) for day in days if day != _NO_DAY])
        if _NO_DAY in days:
            chosen = chosen | F.col(EVENT_DATE).isNull()
        _replace_days(read_table(spark, path).filter(chosen), path, same_rows=True)
    return len(days)


def _flags_of(pointer: dict) -> tuple[list[str], list[str]]:
    return pointer.get("flags", []), pointer.get("flag_columns", [])


def _per_day(parts: Sequence[str]) -> dict[str, list[str]]:
    days: dict[str, list[str]] = {}
    for part in parts:
        days.setdefault(part.split("/")[1], []).append(part)
    return days


def _versioned(spark: SparkSession, path: str) -> dict | None:
    """The current list of a history, after writing plain Parquet as a version."""
    before = _tidy(spark, path)
    if before is None and _plain(spark, path):
        replace_history(read_table(spark, path), path)
        before = _pointer(spark, path)
    return before
