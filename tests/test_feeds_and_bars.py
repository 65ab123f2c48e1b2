import pytest
from pyspark.sql import functions as F

from lodebar.functions.timebars import bar_key
from lodebar.operators import bars, control, instruments, sinks, wide
from lodebar.sources import feeds
from lodebar.streaming import tail_source

DAY = "20310307"


def line(symbol, at, last, traded, volume, amount, tail="2,0,0"):
    """A tick: opening values stay the same all day, and what a test looks at is given."""
    return f"{symbol},{DAY}{at},90000,{last},90100,99900,88800,{last},{last},{traded},{volume},{amount},7,,T,0,Y" + (f",{tail},{DAY}{at}" if tail else "")


TICKS = "\n".join(
    [
        "symbol,time,preclose",
        line("X1", "101500250", 91000, 10, 10, 910000),
        line("X1", "101540000", 92500, 30, 40, 3685000),
        line("X2", "101505750", 70100, 5, 5, 350500),
        line("X1", "101601125", 90500, 15, 55, 5042500),
        line("X2", "101659000", 71000, 0, 5, 350500, tail=""),
        line("X2", "101720000", 72000, 8, 13, 926500, tail=""),
    ]
)
QUOTES = "\n".join(["symbol,time,bidprice,bidsize,askprice,asksize", f"X1,{DAY}101510000,90900,3,91100,4", f"X1,{DAY}101630500,90400,6,90600,2", f"X3,{DAY}101702000,12300,9,12400,8"])
CODES = "X1,4,MKT,Old name,EUR,share,plain,,,,,99000,81000,2,0,,0\nX1,4,MKT,New name,EUR,share,plain,,,,,0,80000,0,0,,0\nX2,4,MKT,Trust,EUR,trust,plain\n"


def read(spark, tmp_path, name, text, layout):
    path = tmp_path / name
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return feeds.parsed(tail_source.lines(spark, str(path)).drop("date").withColumnRenamed("position", "seqno"), layout)


@pytest.fixture
def ticks(spark, tmp_path):
    return feeds.accepted(read(spark, tmp_path, f"snapshot.csv.{DAY}", TICKS, feeds.TICKS))


@pytest.fixture
def quotes(spark, tmp_path):
    return feeds.accepted(read(spark, tmp_path, f"order.csv.{DAY}", QUOTES, feeds.QUOTES))


@pytest.fixture
def codes(spark, tmp_path):
    rows = feeds.accepted(read(spark, tmp_path, f"code.csv.{DAY}", CODES, feeds.INSTRUMENTS))
    return instruments.merged(rows.select("symbol", "name", "market", "limitup", "limitdown", "decimal", "seqno"))


def test_optional_columns_and_bad_rows(spark, tmp_path, ticks):
    assert ticks.count() == 6
    last = ticks.where("symbol = 'X2'").orderBy(F.desc("time")).first()
    assert (last.tradetype, last.status, last.pflag, last.decimal, last.rcvtime) == ("", "T", "Y", 2, 0)
    at = f"{DAY}101500000"
    bad = f"a,b\n,{at},5,6,7,8\nX1,{at},five,6,7,8\nX1,{DAY},5,6,7,8\r\nX1,{at},5,6,7,8,2,0,9\nX1,{at}, 5 ,+6,7,8,9\n\n".encode() + f",{at},5,6,7,8".join(["\xff", ""]).encode("latin-1")
    rows = read(spark, tmp_path, "order.csv.other", bad, feeds.QUOTES)
    assert sorted(r.problem for r in feeds.rejected(rows).collect()) == ["no symbol", "not a number", "number of columns", "number of columns", "time"]
    good = feeds.accepted(rows).where("symbol = 'X1'").first()
    assert (good.bidprice, good.bidsize, good.decimal) == (5, 6, 0)
    assert feeds.warnings(ticks).first().rows == 6


def test_bars_and_gaps(ticks, codes):
    rows = {(r.symbol, r.key[-4:]): r for r in bars.kline(ticks, codes).withColumn("key", bar_key(F.col("bar"))).collect()}
    assert set(rows) == {(s, f"10{m}") for s in ("X1", "X2") for m in (16, 17, 18)}
    a, b, gap = (rows["X1", k] for k in ("1016", "1017", "1018"))
    assert (a.open, a.high, a.low, a.close, a.volume, a["count"], a.name) == (910.0, 925.0, 910.0, 925.0, 0, 2, "New name")
    assert (b.volume, b.amount, b.trade_flag) == (15, 13575.0, "Y")
    assert (gap.open, gap.close, gap.volume, gap.update_flag, gap.trade_flag) == (905.0, 905.0, 0, "N", "N")
    assert rows["X2", "1017"].trade_flag == "N" and rows["X2", "1018"].volume == 8
    modes = {m: bars.ohlcv(ticks, "minute", m).where("symbol = 'X1'").orderBy("bar").first().volume for m in ("self", "start", "zero")}
    assert modes == {"self": 0, "start": 30, "zero": 40}
    with pytest.raises(ValueError):
        bars.ohlcv(ticks, "minute", "other")


def test_what_a_day_leaves_to_the_next(spark, codes):
    """Prices are carried over midnight; volumes and quotes start anew unless asked for, and so do the bars' numbers."""
    rows = [(1, "X1", "2031-03-07 23:58:30", 100, 10), (2, "X1", "2031-03-07 23:59:30", 110, 25), (3, "X1", "2031-03-08 00:00:20", 120, 40), (4, "X2", "2031-03-08 00:01:10", 50, 1)]
    kind = "seqno long, symbol string, ts string, lastprice long, totalvol long"
    t = spark.createDataFrame(rows, kind).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    t = t.select("*", F.lit(2).alias("decimal"), F.col("totalvol").alias("totalamount"), F.lit(0).alias("lasttradeqty"), *[F.lit(0).alias(c) for c in ("preclose", "open", "high", "low", "shortsellflag")])
    volume = lambda across: [r.volume for r in bars.ohlcv(t, "minute", "zero", across).where("symbol = 'X1'").orderBy("bar").collect()]
    assert volume(False) == [10, 15, 40] and volume(True) == [10, 15, 15]
    q = spark.createDataFrame([(1, "X1", "2031-03-07 23:58:40", 7)], "seqno long, symbol string, ts string, bidprice long").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    q = q.select("*", *[F.lit(1).alias(c) for c in ("bidsize", "askprice", "asksize")], F.lit(0).alias("decimal"))
    for across in (False, True):
        got = {r.UpdateTime[-8:]: r for r in wide.rows(t, q, codes, carry_quotes_across_days=across).where("InstrumentID = 'X1'").collect()}
        assert [(k, got[k].LastPrice, got[k].BidPrice1, got[k].Seqno) for k in ("23:59:00", "00:00:00", "00:01:00", "00:02:00")] == [
            ("23:59:00", 1.0, 7.0, 1), ("00:00:00", 1.1, 7.0, 2), ("00:01:00", 1.2, 7.0 if across else None, 1), ("00:02:00", 1.2, 7.0 if across else None, 2),
        ]


def test_no_row_is_lost_and_none_comes_from_the_future(ticks, codes):
    rows = bars.snapshot(ticks, codes).collect()
    assert sum(r.update_flag == "Y" for r in rows) == 6 and all(r.ts <= r.bar for r in rows)


def test_sticky_columns_keep_the_last_news(codes):
    got = {r.symbol: r for r in codes.collect()}
    assert (got["X1"].name, got["X1"].limitup, got["X1"].limitdown, got["X1"].decimal) == ("New name", 99000, 80000, 2)
    assert (got["X2"].limitup, got["X2"].decimal) == (0, 2)


def test_wide_rows_as_text(ticks, quotes, codes):
    text = wide.as_text(wide.rows(ticks, quotes, codes))
    assert text.columns[1:] == wide.COLUMNS and len(wide.COLUMNS) == 65
    rows = {(r.InstrumentID, r.UpdateTime[-8:]): r for r in text.collect()}
    a = rows["X1", "10:16:00"]
    assert (a.LastPrice, a.UpperLimitPrice, a.BidPrice1, a.BidVolume1, a.AskPrice2, a.Type, a.Seqno, a.IsShortRestricted) == ("910.0", "990.0", "909.0", "3", "NA", "69", "1", "N")
    assert rows["X2", "10:17:00"].LastPrice == "710.0" and rows["X2", "10:16:00"].BidPrice1 == "NA"
    only_quote = rows["X3", "10:18:00"]
    assert (only_quote.LastPrice, only_quote.BidPrice1, only_quote.Volume) == ("NA", "123.0", "NA")


def test_text_rows(ticks, codes):
    rows = sinks.text_rows(bars.snapshot(ticks, codes), sinks.SNAPSHOT_TEXT).where("symbol = 'X1' and update_flag = 'Y'").orderBy("ts")
    n, symbol, name, at, *rest = rows.first().line.split(",")
    assert (symbol, name, at) == ("X1", "New name", f"{DAY}101500250") and rest[-1] == "Y" and len(rest) == 20 and rest[:2] == ["90000", "91000"]


def test_writing_twice_changes_nothing_and_late_rows_are_added_once(spark, tmp_path, ticks, codes):
    product = bars.snapshot(ticks, codes)
    path = f"file://{tmp_path}/out"
    for _ in range(2):
        sinks.write_product(product, path)
    assert spark.read.parquet(path).count() == product.count() == sinks.read_product(spark, path).count()
    part = product.where("symbol = 'X1'").where(bar_key(F.col("bar")) == f"{DAY}1016")
    sinks.write_product(part, path)
    assert spark.read.parquet(path).where("hhmm = '1016'").count() == part.count()
    for batch in (4, 5, 5):
        sinks.append_late(part, path, batch)
    assert sinks.read_product(spark, path).where("hhmm = '1016'").count() == 3 * part.count()
    assert sorted(bar_text.k for bar_text in sinks.produced_bars(spark, path).select(bar_key(F.col("bar")).alias("k")).collect()) == [f"{DAY}10{m}" for m in (16, 17, 18)]
    assert {(r.symbol, r.lastprice) for r in sinks.latest_from(spark, path).collect()} == {("X1", 90500), ("X2", 72000)}
    assert {(r.symbol, r.lastprice) for r in sinks.latest_from(spark, path, f"{DAY}1016").collect()} == {("X1", 92500)}
    none = ticks.limit(0).select("seqno", "symbol", "ts", F.lit(1).alias("bidprice"), F.lit(1).alias("bidsize"), F.lit(1).alias("askprice"), F.lit(1).alias("asksize"), "decimal")
    sinks.write_product(wide.as_text(wide.rows(ticks, none, codes)).withColumn("symbol", F.col("InstrumentID")), f"file://{tmp_path}/csv", "csv")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/csv").count() == 6


def test_control(spark, ticks, monkeypatch):
    rows = bars.with_bar(ticks, "minute")
    on_time, late = control.late_split(rows, rows.where("symbol = 'X1'").select("bar"))
    assert (on_time.count(), late.count()) == (1, 5)
    assert [r.number for r in control.arrival_numbers(ticks, "seqno").orderBy("seqno").collect()] == [1, 2, 3, 4, 5, 6]
    assert control.capped(late, 2).count() == 4 and control.late_statistics(late).first().late_bars == 2


def test_stretches_change_nothing(spark, monkeypatch):
    """The newest bar so far and rows above all before, over one stretch of arrivals and over many."""
    rows = [(n, "a" if n % 3 else "b", (n * 37) % 101) for n in range(200)]
    df = spark.createDataFrame(rows, "seqno long, symbol string, bar long")
    for stretch in (1 << 20, 7):
        monkeypatch.setattr(control, "STRETCH", stretch)
        got = {r.seqno: r.watermark for r in control.running_watermark(df).collect()}
        most = {}
        for n, symbol, bar in rows:
            most[symbol] = max(most.get(symbol, -1), bar)
            assert got[n] == most[symbol]
        up = {r.seqno for r in control.increasing(df, "bar", "symbol", "seqno", control.by_arrival()).collect()}
        assert up == {n for n, symbol, bar in rows if all(b < bar for m, s, b in rows if s == symbol and m < n)}


def test_order_checks_look_over_the_ends_of_stretches(spark):
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate([5, 6, 6, 9, 3, 4, 4, 8])] + [("b", i, v) for i, v in ((0, 2), (5, 1))], "k string, at int, v int")
    got = control.not_increasing(rows, "v", "k", "at", F.floor(F.col("at") / 2)).select("k", "at", "before").collect()
    assert sorted(map(tuple, got)) == [("a", 2, 6), ("a", 4, 9), ("a", 6, 4), ("b", 5, 2)]
