from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodebar.functions import prices, timebars

TIMES = [
    ("2026-05-20 15:30:00.000", "202605201530"),
    ("2026-05-20 15:30:00.001", "202605201531"),
    ("2026-05-20 09:00:01.000", "202605200901"),
    ("2026-05-20 23:59:30.000", "202605210000"),
    ("2026-12-31 23:59:59.999", "202701010000"),
    ("2024-02-28 23:59:00.500", "202402290000"),
    ("2026-05-20 00:00:00.000", "202605200000"),
]


def test_bars_are_open_on_the_left_and_closed_on_the_right(spark):
    df = spark.createDataFrame(TIMES, "ts string, key string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    end = timebars.bar_end(F.col("ts"))
    rows = df.select("ts", "key", timebars.bar_key(end).alias("got"), timebars.bar_start(end).alias("start"), end.alias("end"), timebars.trading_date(F.col("ts")).alias("date")).collect()
    assert all(r.got == r.key and r.start < r.ts <= r.end for r in rows)
    assert str(rows[3].date) == "2026-05-20"


def test_digits_there_and_back_and_bad_ones(spark):
    df = spark.createDataFrame([("20260520093000999",), ("2026052009300099",), ("20261320093000999",), ("x",), (None,)], "t string")
    got = [r[0] for r in df.select(timebars.parse_digits(F.col("t"))).collect()]
    assert got == [datetime(2026, 5, 20, 9, 30, 0, 999000), None, None, None, None]
    assert df.limit(1).select(timebars.digits(timebars.parse_digits(F.col("t")))).first()[0] == 20260520093000999
    keys = spark.createDataFrame([("202605200930",), ("20260520",), ("2026052009 0",)], "k string").select(timebars.key_to_end(F.col("k"))).collect()
    assert [r[0] for r in keys] == [datetime(2026, 5, 20, 9, 30), None, None]


def test_unknown_width():
    with pytest.raises(ValueError):
        timebars.bar_start(None, "week")


def test_prices(spark):
    rows = [(444000, 2, 443500), (0, 2, 443500), (410000, 0, 0), (5, 6, 5), (12345678900, 1, 1), (-7, 2, 7)]
    df = spark.createDataFrame(rows, "v long, d int, p long")
    got = df.select(
        prices.scaled(F.col("v"), F.col("d")), prices.price_or_null(F.col("v"), F.col("d")), prices.intraday_return(F.col("v"), F.col("p"), F.col("d")),
        prices.number_text(F.col("v"), F.col("d")), prices.fixed_text(prices.scaled(F.col("v"), F.col("d")), F.col("d")),
    ).collect()
    assert [r[0] for r in got] == [4440.0, 0.0, 410000.0, 5e-06, 1234567890.0, -0.07]
    assert got[1][1] is None and got[1][2] == -1.0 and got[2][2] is None and got[3][2] == 0.0 and str(got[3][2]) == "0.0"
    assert [r[3] for r in got] == ["4440.0", "0.0", "410000.0", "0.000005", "1234567890.0", "-0.07"]
    assert [r[4] for r in got][:3] == ["4440.00", "0.00", "410000"]
    repaired = spark.createDataFrame([(-1,), (0,), (6,), (7,)], "d int").select(prices.repaired_decimal(F.col("d"))).collect()
    assert [r[0] for r in repaired] == [0, 0, 6, 0]
