"""The commands."""

import pytest

from txvigil.__main__ import arguments, main
from txvigil.schema import TRANSACTION
from txvigil.session import settings
from txvigil.sources import tables


def test_commands(spark, tmp_path):
    lines = [f"2025-01-10 08:0{i}:00|A|O|1|T|B|CCW|0|1|IDR|MB|1|r{i}" for i in range(3)]
    (tmp_path / "trx_history_20250110.csv").write_text("\n".join(["|".join(TRANSACTION.names), *lines]))
    places = ["--history", f"{tmp_path}/history", "--outputs", f"{tmp_path}/out"]
    day = ["--as-of", "2025-01-10"]
    main(["ingest", "ccw", "--drops", str(tmp_path), *places, *day])
    main(["merge", "ccw", *places, *day])
    flags = lambda: [r.flag for r in tables.read_table(spark, f"{tmp_path}/history").collect()]
    assert flags() == [0, 0, 0]
    main(["rule", "ccw", *places, *day])
    main(["merge", "ccw", *places, *day])
    assert flags() == [1, 1, 1]
    main(["run", "ccw", "--drops", str(tmp_path), *places, *day])
    assert flags() == [1, 1, 1]


@pytest.mark.parametrize(
    "argv",
    [
        ["rule", "e_wallet", "--history", "h", "--outputs", "o"],
        ["ingest", "qr_10min", "--history", "h", "--drops", "d"],
        ["run", "ccw", "--history", "h", "--drops", "d"],
    ],
)
def test_wrong_arguments(argv):
    with pytest.raises(SystemExit):
        arguments(argv)


def test_settings_grow_with_the_data():
    partitions = [int(settings(n, 8)["spark.sql.shuffle.partitions"]) for n in (1 << 20, 1 << 40, 1 << 50)]
    assert partitions == [24, 1 << 12, 1 << 22]
    assert settings(1 << 50, 8, 1 << 30)["spark.sql.shuffle.partitions"] == str(1 << 20)
