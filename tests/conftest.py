import os
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

from txvigil.schema import TRANSACTION

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 6g pyspark-shell")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("txvigil-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tx(spark):
    """Makes transactions from (time, amount[, account[, ref]]) with running numbers as refs."""

    def make(*rows, **columns):
        full = []
        for number, row in enumerate(rows):
            at, amount, account, ref = (*row, *("A", f"r{number}")[len(row) - 2 :])
            values = {name: None for name in TRANSACTION.names}
            values |= {
                "transaction_category": "CCW",
                "transaction_status": 0,
                "transaction_state": 1,
            }
            values |= columns
            values |= {
                "transaction_date": None if at is None else datetime.fromisoformat(at),
                "from_account_number": account,
                "transaction_amount": None if amount is None else float(amount),
                "no_referensi": ref,
            }
            full.append(tuple(values[name] for name in TRANSACTION.names))
        return spark.createDataFrame(full, TRANSACTION)

    return make


@pytest.fixture
def refs():
    """The reference numbers of a result, sorted, repeats included."""

    def of(rows):
        return sorted(row.no_referensi for row in rows.select("no_referensi").collect())

    return of
