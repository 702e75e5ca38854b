"""Daily drops: delimited files named by date."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from txvigil.functions import checked_cast, null_if_token
from txvigil.schema import NULL_TOKENS, TRANSACTION
from txvigil.sources.files import exists

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Drops:
    """Where the daily drops lie: ``folder/prefix<date>suffix``, files or folders."""

    folder: str
    prefix: str = "trx_history_"
    suffix: str = ".csv"
    date_format: str = "%Y%m%d"

    def paths(self, as_of: date, n_days: int) -> list[str]:
        """One path per day, ``as_of`` and the days before it."""
        days = [as_of - timedelta(days=i) for i in range(n_days)]
        names = [f"{self.prefix}{day.strftime(self.date_format)}{self.suffix}" for day in days]
        return [f"{self.folder.rstrip('/')}/{name}" for name in names]

    def present(self, spark: SparkSession, as_of: date, n_days: int) -> list[str]:
        found = []
        for path in self.paths(as_of, n_days):
            if exists(spark, path):
                found.append(path)
            else:
                log.warning("no drop %s", path)
        return found


def read_texts(
    spark: SparkSession, paths: Sequence[str], separator: str = "|", by_position: bool = False
) -> DataFrame:
    """All fields as text.

    Every file must have the header of the first one, unless columns go by position.
    """
    reader = (
        spark.read.option("sep", separator)
        .option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
    )
    header = reader.csv(paths[0]).columns
    texts = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return reader.schema(texts).option("enforceSchema", by_position).csv(list(paths))


def read_all(spark: SparkSession, pattern: str, separator: str = "|") -> DataFrame:
    """Every file of a glob pattern with inferred types, for a first look at the data."""
    return (
        spark.read.option("sep", separator)
        .option("header", True)
        .option("escape", '"')
        .option("inferSchema", True)
        .option("prefersDate", False)
        .csv(pattern)
    )


def rename_by_position(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Column names by position, whatever the header says."""
    if len(rows.columns) != len(names):
        raise ValueError(f"{len(names)} names for {len(rows.columns)} columns: {rows.columns}")
    return rows.toDF(*names)


def normalise_nulls(rows: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Null for every text that stands for a missing value."""
    texts = [f.name for f in rows.schema.fields if f.dataType == T.StringType()]
    return rows.withColumns({c: null_if_token(F.col(c), tokens) for c in texts})


def typed(rows: DataFrame, schema: T.StructType = TRANSACTION) -> DataFrame:
    """Casts the columns of the schema and keeps the others; a value that does not fit fails."""
    missing = [f.name for f in schema.fields if f.name not in rows.columns]
    if missing:
        raise ValueError(f"columns missing from the drop: {missing}")
    return rows.withColumns(
        {
            f.name: checked_cast(F.col(f.name), f.dataType, f.name)
            for f in schema.fields
            if f.dataType != rows.schema[f.name].dataType
        }
    )


def read_daily_drops(
    spark: SparkSession,
    drops: Drops,
    as_of: date,
    n_days: int,
    by_position: bool = False,
    schema: T.StructType = TRANSACTION,
) -> DataFrame | None:
    """Typed rows of the last ``n_days`` drops, or None if there is none."""
    paths = drops.present(spark, as_of, n_days)
    if not paths:
        return None
    texts = read_texts(spark, paths, by_position=by_position)
    if by_position:
        texts = rename_by_position(texts, schema.names)
    return typed(normalise_nulls(texts), schema)
