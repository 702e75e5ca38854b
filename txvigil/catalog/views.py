"""The given tables read as transactions, and results in a comparable form.

``transactions`` and the SQL in ``TX`` say the same. Events are many accounts with distinct
times, orders have tied times, lineitem repeats its reference numbers.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from txvigil.functions import epoch_us
from txvigil.schema import TRANSACTION

# A day after the last event, and one after the last order and shipment.
AS_OF = date(2024, 1, 31)
AS_OF_ORDERS = date(2003, 1, 1)

_MAPPING = {
    "events": {
        "transaction_date": "ts",
        "from_account_number": "cast(user_id as string)",
        "from_account_owner_name": "concat('owner ', user_id)",
        "to_account_number": "concat('shop ', event_type)",
        "to_account_owner_name": "upper(event_type)",
        "to_bank_name": "case when event_type = 'view' then 'BANK A' else 'BANK B' end",
        "transaction_category": "event_type",
        "transaction_status": "cast(case when event_type = 'error' then 1 else 0 end as tinyint)",
        "transaction_amount": "value",
        "transaction_currency": "'IDR'",
        "channel_code": "case when event_type in ('click', 'view') then 'MB' else 'IB' end",
        "transaction_state": (
            "cast(case when props like '%0}' then 0 else 1 end as tinyint)"
        ),
        "no_referensi": "cast(event_id as string)",
    },
    "orders": {
        "transaction_date": "o_orderdate",
        "from_account_number": "cast(o_custkey as string)",
        "from_account_owner_name": "concat('customer ', o_custkey)",
        "to_account_number": "'shop'",
        "to_account_owner_name": "o_orderpriority",
        "to_bank_name": "'BANK A'",
        "transaction_category": "o_orderstatus",
        "transaction_status": "cast(0 as tinyint)",
        "transaction_amount": "o_totalprice",
        "transaction_currency": "'IDR'",
        "channel_code": "'IB'",
        "transaction_state": "cast(1 as tinyint)",
        "no_referensi": "cast(o_orderkey as string)",
    },
    "lineitem": {
        "transaction_date": "l_shipdate",
        "from_account_number": "cast(l_suppkey as string)",
        "from_account_owner_name": "concat('supplier ', l_suppkey)",
        "to_account_number": "cast(l_partkey as string)",
        "to_account_owner_name": "l_linestatus",
        "to_bank_name": "'BANK A'",
        "transaction_category": "l_returnflag",
        "transaction_status": "cast(0 as tinyint)",
        "transaction_amount": "l_extendedprice",
        "transaction_currency": "'IDR'",
        "channel_code": "'IB'",
        "transaction_state": "cast(1 as tinyint)",
        "no_referensi": "cast(l_orderkey as string)",
    },
}

TX = {
    table: "SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()).replace(
        "as string)", "as varchar)"
    )
    + f" FROM {table}"
    for table, columns in _MAPPING.items()
}


def transactions(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return rows.selectExpr(*[f"{sql} AS {name}" for name, sql in _MAPPING[table].items()])


def emit(rows: DataFrame) -> DataFrame:
    """Times as microseconds (``_us``), dates as text, small integers as int, decimals as double."""

    def shown(field: T.StructField):
        column = F.col(field.name)
        match field.dataType:
            case T.TimestampNTZType():
                return epoch_us(column).alias(f"{field.name}_us")
            case T.DateType():
                return column.cast("string").alias(field.name)
            case T.ByteType():
                return column.cast("int").alias(field.name)
            case T.DecimalType():
                return column.cast("double").alias(field.name)
        return column

    return rows.select(*[shown(field) for field in rows.schema.fields])


def emit_sql(*more: str) -> str:
    """The columns of a transaction as ``emit`` shows them, and more."""
    shown = []
    for field in TRANSACTION.fields:
        match field.dataType:
            case T.TimestampNTZType():
                shown.append(f"epoch_us({field.name}) AS {field.name}_us")
            case T.ByteType():
                shown.append(f"CAST({field.name} AS INTEGER) AS {field.name}")
            case _:
                shown.append(field.name)
    return ", ".join([*shown, *more])
