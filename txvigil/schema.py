"""Column names and types of the transaction tables."""

from __future__ import annotations

from pyspark.sql import types as T

AT = "transaction_date"
ACCOUNT = "from_account_number"
REF = "no_referensi"
AMOUNT = "transaction_amount"
CATEGORY = "transaction_category"
STATUS = "transaction_status"
STATE = "transaction_state"
CHANNEL = "channel_code"

# Calendar day of AT while a rule runs.
DAY = "temp_date_col"
# Calendar day of AT as the partition column of a stored history.
EVENT_DATE = "event_date"
# Flag column of a rule output.
FLAG = "flag"

# The columns of a daily drop, in file order.
TRANSACTION = T.StructType(
    [
        T.StructField("transaction_date", T.TimestampNTZType()),
        T.StructField("from_account_number", T.StringType()),
        T.StructField("from_account_owner_name", T.StringType()),
        T.StructField("to_account_number", T.StringType()),
        T.StructField("to_account_owner_name", T.StringType()),
        T.StructField("to_bank_name", T.StringType()),
        T.StructField("transaction_category", T.StringType()),
        T.StructField("transaction_status", T.ByteType()),
        T.StructField("transaction_amount", T.DoubleType()),
        T.StructField("transaction_currency", T.StringType()),
        T.StructField("channel_code", T.StringType()),
        T.StructField("transaction_state", T.ByteType()),
        T.StructField("no_referensi", T.StringType()),
    ]
)

# Field texts that stand for a missing value.
NULL_TOKENS = ("null", "NULL", "", "None")

FLAG_TYPE = T.ByteType()

# Amounts are summed as exact decimals, so a threshold test does not depend on row order.
MONEY = T.DecimalType(18, 2)
