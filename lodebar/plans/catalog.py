"""Queries by name over the driver's tables, and the SQL that gives the same rows.

Grid products use hour bars: minutes times symbols of the event table is a product of its own making.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodebar.functions import prices, timebars
from lodebar.operators import bars, control, instruments, resume, sinks, wide
from lodebar.plans import sqltext as s
from lodebar.sources import feeds, tables
from lodebar.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("bar", timebars.bar_key(F.col("bar")))


def _ins(spark: SparkSession, d: str) -> DataFrame:
    return instruments.merged(tables.instrument_rows(spark, d))


RAW, HOUR, MINUTE = s.RAW, s.bars("hour"), s.bars("minute")
KEY = s.key_of("bar")

# ---- bars and clocks


@query(f"SELECT {s.key_of(s.end_of('ts', 'minute'))} AS bar, count(*) AS events, sum(value) AS total FROM events GROUP BY 1")
def bar_bucket_minute(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    return keyed(e.groupBy(timebars.bar_end(F.col("ts")).alias("bar")).agg(F.count("*").alias("events"), F.sum("value").alias("total")))


@query(f"SELECT {s.key_of(s.end_of('l_shipdate', 'day'))} AS bar, l_partkey % 7 AS part, count(*) AS rows, max(l_extendedprice) AS high, min(l_extendedprice) AS low FROM lineitem GROUP BY 1, 2")
def bar_bucket_day_boundary(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    bar = timebars.bar_end(F.col("l_shipdate"), "day").alias("bar")
    return keyed(rows.groupBy(bar, (F.col("l_partkey") % 7).alias("part")).agg(F.count("*").alias("rows"), F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low")))


@query(
    f"SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST(CAST(floor(extract('microsecond' FROM ts) / 1000) AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS BIGINT) AS digits, {s.key_of('ts')} AS minute FROM events"
)
def parse_17digit_time(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", timebars.digits(F.col("ts")).alias("digits"))
    return e.withColumn("minute", timebars.bar_key(timebars.parse_digits(F.col("digits"))))


@query(
    f"SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f') AS local_time, strftime({s.end_of('ts', 'minute')}, '%Y%m%d %H:%M:00') AS update_time FROM events"
)
def format_local_update_time(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    at = timebars.parse_digits(timebars.digits(F.col("ts")))
    return e.select("event_id", timebars.local_time(at).alias("local_time"), timebars.update_time(timebars.bar_end(F.col("ts"))).alias("update_time"))


@query(f"SELECT {KEY} AS bar, {s.key_of('bar - INTERVAL 1 hour')} AS begins, count(*) AS rows FROM (SELECT {s.end_of('ts', 'hour')} AS bar FROM events) GROUP BY 1, 2")
def bar_limits(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet").groupBy(timebars.bar_end(F.col("ts"), "hour").alias("bar")).agg(F.count("*").alias("rows"))
    back = timebars.key_to_end(timebars.bar_key(F.col("bar")))
    return keyed(e.withColumn("begins", timebars.bar_key(timebars.bar_start(back, "hour"))))


# ---- text feeds


def _tick_lines(spark: SparkSession, d: str, doubtful: bool = False) -> DataFrame:
    """Event rows written as lines of the tick feed, every 50th spoilt in one of four ways; ``doubtful``: some values wrong, too."""
    t = tables.raw_ticks(spark, d)
    n = F.col("seqno")
    spoilt = F.when(n % 200 == 50, "").when(n % 200 == 100, "x").otherwise(F.col("symbol"))
    time = F.when(n % 200 == 150, F.lit("12:00")).otherwise(timebars.digits(F.col("ts")).cast("string"))
    tail = F.when(n % 200 == 0, F.lit(",1")).otherwise(F.lit(""))
    decimal = F.when(n % 11 == 0, 9).otherwise(2)
    wrong = lambda every, value, right: F.when(n % every == 0, value).otherwise(right) if doubtful else right
    price, volume, status = wrong(37, F.lit(-1), F.col("lastprice")), wrong(41, F.lit(-7), F.lit(7)), wrong(43, F.lit("Z"), F.lit("T"))
    fields = [spoilt, time, F.lit(0), price, *[F.lit(0)] * 5, F.col("lasttradeqty"), volume, F.lit(8), F.lit(1), F.lit(""), status, F.lit(0), F.lit("Y"), decimal, F.lit(0), F.col("shortsellflag"), F.lit(0)]
    return t.select("seqno", F.concat(F.concat_ws(",", *[f.cast("string") for f in fields]), tail).alias("line"))


GOOD = "seqno % 200 NOT IN (0, 50, 150)"


@query(f"WITH {RAW} SELECT seqno, CASE WHEN seqno % 200 = 100 THEN 'x' ELSE symbol END AS symbol, {s.key_of('ts')} AS minute, lastprice, lasttradeqty, CASE WHEN seqno % 11 = 0 THEN 0 ELSE 2 END AS decimal, shortsellflag FROM rt WHERE {GOOD}")
def ticks_typed(spark: SparkSession, d: str) -> DataFrame:
    good = feeds.accepted(feeds.parsed(_tick_lines(spark, d), feeds.TICKS))
    return good.select("seqno", "symbol", timebars.bar_key(F.col("ts")).alias("minute"), "lastprice", "lasttradeqty", "decimal", "shortsellflag")


@query(f"WITH {RAW} SELECT seqno % 200 AS kind, CASE seqno % 200 WHEN 0 THEN 'number of columns' WHEN 50 THEN 'no symbol' ELSE 'time' END AS problem, count(*) AS rows FROM rt WHERE seqno % 200 IN (0, 50) GROUP BY ALL UNION ALL SELECT 150, 'time', count(*) FROM (WITH {RAW} SELECT * FROM rt WHERE seqno % 200 = 150)".replace("'time', count", "'not a number', count"))
def ticks_rejected(spark: SparkSession, d: str) -> DataFrame:
    rows = feeds.parsed(_tick_lines(spark, d), feeds.TICKS).where("problem is not null")
    return rows.groupBy((F.col("seqno") % 200).alias("kind"), "problem").agg(F.count("*").alias("rows"))


@query(f"WITH {RAW} SELECT seqno, symbol, {s.key_of('ts')} AS minute, bidprice, bidsize, askprice, asksize, decimal, 0 AS rcvtime FROM q")
def quotes_typed(spark: SparkSession, d: str) -> DataFrame:
    q = tables.quotes(spark, d)
    fields = ["symbol", timebars.digits(F.col("ts")), "bidprice", "bidsize", "askprice", "asksize"]
    lines = q.select("seqno", F.concat_ws(",", *[(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]).alias("line"))
    good = feeds.accepted(feeds.parsed(lines, feeds.QUOTES))
    return good.select("seqno", "symbol", timebars.bar_key(F.col("ts")).alias("minute"), "bidprice", "bidsize", "askprice", "asksize", "decimal", "rcvtime")


@query(f"WITH {RAW} SELECT symbol, name, market, limitup, limitdown, decimal FROM irows")
def instruments_typed(spark: SparkSession, d: str) -> DataFrame:
    rows = tables.instrument_rows(spark, d)
    blank = F.lit("")
    decimal = F.when(F.col("decimal") == 2, "").otherwise(F.col("decimal").cast("string"))  # blank takes the default
    fields = ["symbol", "market", blank, "name", blank, blank, blank, blank, blank, blank, blank, "limitup", "limitdown", decimal]
    lines = rows.select(F.concat_ws(",", *[(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]).alias("line"))
    return feeds.accepted(feeds.parsed(lines, feeds.INSTRUMENTS)).select("symbol", "name", "market", "limitup", "limitdown", "decimal")


@query(
    f"WITH {RAW} SELECT count(*) AS rows, count(*) FILTER (WHERE seqno % 37 = 0) AS negative_price, count(*) FILTER (WHERE seqno % 41 = 0) AS negative_volume, count(*) FILTER (WHERE seqno % 43 = 0) AS unknown_status FROM rt WHERE {GOOD}"
)
def dq_metrics(spark: SparkSession, d: str) -> DataFrame:
    return feeds.warnings(feeds.accepted(feeds.parsed(_tick_lines(spark, d, True), feeds.TICKS)))


@query("SELECT event_id, CASE WHEN event_id % 12 - 2 BETWEEN 0 AND 6 THEN event_id % 12 - 2 ELSE 0 END AS decimal FROM events")
def decimal_repair(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", prices.repaired_decimal(F.col("event_id") % 12 - 2).alias("decimal"))


@query("SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def date_filter(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.where(timebars.trading_date(F.col("ts")) == F.lit("2024-01-15").cast("date")).select("event_id", "user_id", "value")


@query(f"SELECT {KEY} AS bar, count(*) AS rows FROM (SELECT {s.end_of('ts', 'minute')} AS bar FROM events) WHERE strftime(bar, '%H%M') BETWEEN '0900' AND '1130' GROUP BY 1")
def session_filter(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet").select(timebars.bar_end(F.col("ts")).alias("bar"))
    return keyed(e.where(timebars.in_session(F.col("bar"), "0900", "1130")).groupBy("bar").agg(F.count("*").alias("rows")))


@query(f"SELECT event_id, {s.key_of('ts')} AS minute FROM events WHERE {s.key_of('ts')} BETWEEN '202401100900' AND '202401111500'")
def minute_slice(spark: SparkSession, d: str) -> DataFrame:
    low, high = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-10 09:00:00", "2024-01-11 15:01:00"))
    e = spark.read.parquet(f"{d}/events.parquet").where((F.col("ts") >= low) & (F.col("ts") < high))
    return e.select("event_id", timebars.bar_key(F.col("ts")).alias("minute"))


# ---- bars with prices and volumes

OHLCV = "symbol, {key} AS bar, open, high, low, close, {volumes}, count, seqno, any_quantity"


def _ohlcv(first_seen: str, unit: str = "minute", across_days: bool = False) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return keyed(bars.ohlcv(tables.ticks(spark, d), unit, first_seen, across_days)).drop("lastprice", "decimal")

    return run


for _name, _mode in (("ohlcv_bars", "self"), ("ohlcv_volume_start", "start"), ("ohlcv_volume_zero", "zero")):
    QUERIES[_name] = _ohlcv(_mode)
    ORACLES[_name] = f"WITH {MINUTE} SELECT {OHLCV.format(key=KEY, volumes=s.volumes(_mode))} FROM bl"

QUERIES["ohlcv_across_days"] = _ohlcv("self", "hour", True)
ORACLES["ohlcv_across_days"] = f"WITH {HOUR} SELECT {OHLCV.format(key=KEY, volumes=s.volumes('self'))} FROM bx"

QUERIES["ohlcv_volume_self"] = _ohlcv("self", "hour")
ORACLES["ohlcv_volume_self"] = f"WITH {HOUR} SELECT {OHLCV.format(key=KEY, volumes=s.volumes('self'))} FROM bl"

KLINE = f"""
WITH {HOUR}, f AS (SELECT *, {s.volumes("self")} FROM bl), j AS (
  SELECT g.symbol, g.bar, f.* EXCLUDE (symbol, bar), f.bar IS NOT NULL AS own, last_value(f.lastprice IGNORE NULLS) OVER w AS lp, last_value(f.seqno IGNORE NULLS) OVER w AS ls
  FROM g LEFT JOIN f ON f.symbol = g.symbol AND f.bar = g.bar WINDOW w AS (PARTITION BY g.symbol ORDER BY g.bar ROWS UNBOUNDED PRECEDING)
)
SELECT {KEY} AS bar, j.symbol, coalesce(ins.name, '') AS name, ls AS seqno, coalesce(open, lp / 100.0) AS open, coalesce(high, lp / 100.0) AS high, coalesce(low, lp / 100.0) AS low,
       coalesce(close, lp / 100.0) AS close, coalesce(volume, 0) AS volume, coalesce(amount, 0.0) AS amount, coalesce(count, 0) AS count,
       CASE WHEN own AND (volume > 0 OR any_quantity) THEN 'Y' ELSE 'N' END AS trade_flag, CASE WHEN own THEN 'Y' ELSE 'N' END AS update_flag
FROM j LEFT JOIN ins ON ins.symbol = j.symbol"""


@query(KLINE)
def kline_full(spark: SparkSession, d: str) -> DataFrame:
    return keyed(bars.kline(tables.ticks(spark, d), _ins(spark, d), "hour"))


@query(f"SELECT * FROM ({KLINE}) WHERE update_flag = 'Y'")
def kline_updated_only(spark: SparkSession, d: str) -> DataFrame:
    return keyed(bars.kline(tables.ticks(spark, d), _ins(spark, d), "hour", full=False))


SNAPSHOT = f"""
WITH {HOUR}, own AS (
  SELECT symbol, bar, seqno, lastprice, totalvol, totalamount, decimal, 'Y' AS update_flag FROM tb
), l AS (
  SELECT symbol, bar, max(seqno) AS seqno FROM tb GROUP BY symbol, bar
), held AS (
  SELECT symbol, bar, ls FROM (SELECT g.symbol, g.bar, l.seqno AS own, last_value(l.seqno IGNORE NULLS) OVER (PARTITION BY g.symbol ORDER BY g.bar ROWS UNBOUNDED PRECEDING) AS ls
    FROM g LEFT JOIN l ON l.symbol = g.symbol AND l.bar = g.bar) WHERE own IS NULL
), every AS (
  SELECT * FROM own UNION ALL SELECT h.symbol, h.bar, t.seqno, t.lastprice, t.totalvol, t.totalamount, t.decimal, 'N' FROM held h JOIN t ON t.seqno = h.ls
)
SELECT {KEY} AS bar, every.symbol, coalesce(ins.name, '') AS name, every.* EXCLUDE (symbol, bar, decimal), every.decimal FROM every LEFT JOIN ins ON ins.symbol = every.symbol"""
SNAPSHOT_COLUMNS = ("bar", "symbol", "name", "seqno", "lastprice", "totalvol", "totalamount", "update_flag", "decimal")


@query(SNAPSHOT)
def snapshot_full(spark: SparkSession, d: str) -> DataFrame:
    return keyed(bars.snapshot(tables.ticks(spark, d), _ins(spark, d), "hour")).select(*SNAPSHOT_COLUMNS)


@query(f"SELECT * FROM ({SNAPSHOT}) WHERE update_flag = 'Y'")
def snapshot_updated_only(spark: SparkSession, d: str) -> DataFrame:
    return keyed(bars.snapshot(tables.ticks(spark, d), _ins(spark, d), "hour", full=False)).select(*SNAPSHOT_COLUMNS)


@query(f"SELECT * FROM ({SNAPSHOT}) WHERE update_flag = 'N'")
def snapshot_carry_only(spark: SparkSession, d: str) -> DataFrame:
    return keyed(bars.snapshot(tables.ticks(spark, d), _ins(spark, d), "hour")).where("update_flag = 'N'").select(*SNAPSHOT_COLUMNS)


@query(f"WITH {MINUTE} SELECT {KEY} AS bar, seqno, symbol, bidprice, bidsize, askprice, asksize, decimal FROM qb")
def order_minute(spark: SparkSession, d: str) -> DataFrame:
    return keyed(bars.with_bar(tables.quotes(spark, d), "minute")).drop("ts")


@query(f"WITH {MINUTE} SELECT {KEY} AS bar, symbol, max(seqno) AS seqno, arg_max(bidprice, seqno) AS bidprice, arg_max(askprice, seqno) AS askprice FROM qb GROUP BY symbol, bar")
def quotes_sampled_last(spark: SparkSession, d: str) -> DataFrame:
    return keyed(bars.last_in_bar(tables.quotes(spark, d), "minute")).select("bar", "symbol", "seqno", "bidprice", "askprice")


# ---- selection


@query(f"WITH {RAW} SELECT symbol, arg_max(seqno, row(ts, seqno)) AS seqno, arg_max(lastprice, row(ts, seqno)) AS lastprice, arg_max(totalvol, row(ts, seqno)) AS totalvol FROM t GROUP BY symbol")
def latest_tick_per_symbol(spark: SparkSession, d: str) -> DataFrame:
    return bars.latest(tables.ticks(spark, d), "ts").select("symbol", "seqno", "lastprice", "totalvol")


@query(f"WITH {RAW} SELECT symbol, arg_max(seqno, row(ts, seqno)) AS seqno, arg_max(bidprice, row(ts, seqno)) AS bidprice, arg_max(asksize, row(ts, seqno)) AS asksize FROM q GROUP BY symbol")
def latest_quote_per_symbol(spark: SparkSession, d: str) -> DataFrame:
    return bars.latest(tables.quotes(spark, d), "ts").select("symbol", "seqno", "bidprice", "asksize")


def _received(rows: DataFrame) -> DataFrame:
    """Rows whose times are whole days, so that the time of receipt decides, and then arrival."""
    return rows.withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz")).withColumn("rcvtime", (F.col("seqno") * 7919) % 53)


RECEIVED = "SELECT * EXCLUDE (ts), date_trunc('day', ts) AS ts, (seqno * 7919) % 53 AS rcvtime FROM"


@query(f"WITH {RAW}, x AS ({RECEIVED} t) SELECT symbol, arg_max(seqno, row(ts, rcvtime, seqno)) AS seqno, arg_max(lastprice, row(ts, rcvtime, seqno)) AS lastprice FROM x GROUP BY symbol")
def latest_by_rcvtime(spark: SparkSession, d: str) -> DataFrame:
    return bars.latest(_received(tables.raw_ticks(spark, d)), "ts", "rcvtime").select("symbol", "seqno", "lastprice")


@query(f"WITH {RAW}, x AS ({RECEIVED} q) SELECT {s.key_of(s.end_of('ts', 'day'))} AS bar, symbol, arg_min(seqno, row(ts, rcvtime, seqno)) AS seqno FROM x GROUP BY ALL")
def earliest_by_rcvtime(spark: SparkSession, d: str) -> DataFrame:
    return keyed(bars.earliest_in_bar(_received(tables.quotes(spark, d)), "day", "ts", "rcvtime")).select("bar", "symbol", "seqno")


@query(f"WITH {RAW} SELECT seqno, concat_ws(',', seqno, symbol, strftime(ts, '%Y%m%d%H%M%S'), bidprice, bidsize, askprice, asksize, decimal, 0) AS line FROM q")
def order_text_rows(spark: SparkSession, d: str) -> DataFrame:
    q = tables.quotes(spark, d).withColumn("time", F.date_format("ts", "yyyyMMddHHmmss")).withColumn("rcvtime", F.lit(0))
    return sinks.text_rows(q, sinks.ORDER_TEXT).select("seqno", "line")


@query("SELECT event_id, CAST(ts AS DATE) <> DATE '2024-01-15' AS other FROM events")
def other_date(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", timebars.other_date(F.col("ts"), F.lit("2024-01-15").cast("date")).alias("other"))


@query(f"WITH {MINUTE} SELECT {KEY} AS bar, symbol, arg_min(seqno, row(ts, seqno)) AS seqno, arg_min(lastprice, row(ts, seqno)) AS lastprice FROM tb GROUP BY symbol, bar")
def earliest_tick_in_bar(spark: SparkSession, d: str) -> DataFrame:
    return keyed(bars.earliest_in_bar(tables.ticks(spark, d), "minute", "ts")).select("bar", "symbol", "seqno", "lastprice")


@query(f"WITH {MINUTE} SELECT {KEY} AS bar, symbol, arg_min(seqno, row(ts, seqno)) AS seqno, arg_min(bidprice, row(ts, seqno)) AS bidprice FROM qb GROUP BY symbol, bar")
def earliest_quote_in_bar(spark: SparkSession, d: str) -> DataFrame:
    return keyed(bars.earliest_in_bar(tables.quotes(spark, d), "minute", "ts")).select("bar", "symbol", "seqno", "bidprice")


ASOF = "WITH {bars}, d AS (SELECT DISTINCT bar FROM tb), k AS (SELECT DISTINCT symbol FROM {x}), c AS (SELECT d.bar, k.symbol FROM d CROSS JOIN k) SELECT {key} AS bar, c.symbol, x.seqno, x.{v} FROM c ASOF JOIN {x} x ON x.symbol = c.symbol AND x.ts <= c.bar"


@query(ASOF.format(bars=HOUR, x="t", key=s.key_of("c.bar"), v="lastprice"))
def asof_tick_at_bar(spark: SparkSession, d: str) -> DataFrame:
    t = tables.ticks(spark, d)
    return keyed(bars.as_of(t, "hour", bars.grid(bars.with_bar(t, "hour")))).select("bar", "symbol", "seqno", "lastprice")


@query(ASOF.format(bars=HOUR, x="q", key=s.key_of("c.bar"), v="bidprice"))
def asof_quote_at_bar(spark: SparkSession, d: str) -> DataFrame:
    t, q = tables.raw_ticks(spark, d), tables.quotes(spark, d)
    ends = bars.with_bar(t, "hour").select("bar").distinct()
    held = bars.as_of(q, "hour", bars.grid(ends, bars.with_bar(q, "hour")))
    return keyed(held.join(ends, "bar", "left_semi")).select("bar", "symbol", "seqno", "bidprice")


# ---- instruments and single columns


@query(f"WITH {RAW} SELECT * FROM ins")
def instrument_merge_sticky(spark: SparkSession, d: str) -> DataFrame:
    return _ins(spark, d).select("symbol", "name", "market", "limitup", "limitdown", "decimal")


@query(f"WITH {RAW} SELECT seqno, symbol, coalesce(name, '') AS name FROM t LEFT JOIN (SELECT symbol, name FROM ins WHERE CAST(symbol AS BIGINT) % 3 > 0) USING (symbol)")
def name_lookup_left(spark: SparkSession, d: str) -> DataFrame:
    some = _ins(spark, d).where("cast(symbol as bigint) % 3 > 0")
    return bars.named(tables.raw_ticks(spark, d), some).select("seqno", "symbol", "name")


@query(
    f"WITH {RAW} SELECT t.seqno, t.symbol, CASE WHEN limitup <> 0 THEN limitup / pow(10.0, ins.decimal) END AS upper_limit, CASE WHEN limitdown <> 0 THEN limitdown / pow(10.0, ins.decimal) END AS lower_limit FROM t LEFT JOIN ins ON ins.symbol = t.symbol"
)
def limit_price_lookup(spark: SparkSession, d: str) -> DataFrame:
    return instruments.with_limits(tables.raw_ticks(spark, d), _ins(spark, d)).select("seqno", "symbol", "upper_limit", "lower_limit")


@query(f"WITH {RAW} SELECT seqno, round(CASE WHEN preclose <> 0 THEN (lastprice / 100.0 - preclose / 100.0) / (preclose / 100.0) + 0.0 END, 9) AS intraday_return FROM t")
def intraday_return(spark: SparkSession, d: str) -> DataFrame:
    value = prices.intraday_return(F.col("lastprice"), F.col("preclose"), F.col("decimal"))
    return tables.ticks(spark, d).select("seqno", F.round(value, 9).alias("intraday_return"))


@query(f"WITH {RAW} SELECT seqno, CASE shortsellflag WHEN 1 THEN 'Y' WHEN 0 THEN 'N' END AS short_flag FROM t")
def short_flag_map(spark: SparkSession, d: str) -> DataFrame:
    return tables.raw_ticks(spark, d).select("seqno", prices.short_flag(F.col("shortsellflag")).alias("short_flag"))


@query(f"WITH {RAW} SELECT seqno, CASE WHEN seqno % 5 > 0 THEN nullif(lastprice, 0) / 100.0 END AS price FROM t")
def zero_price_to_null(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("seqno") % 5 > 0, F.col("lastprice")).otherwise(0)
    return tables.raw_ticks(spark, d).select("seqno", prices.price_or_null(raw, F.col("decimal")).alias("price"))


WIDE = f"""
WITH {HOUR}, ends AS (SELECT bar, row_number() OVER (PARTITION BY {s.DAY.format(c="bar")} ORDER BY bar) AS seq FROM (SELECT DISTINCT bar FROM tb)), every AS (SELECT bar FROM tb UNION SELECT bar FROM qb),
tf AS (SELECT symbol, bar, arg_min(seqno, row(ts, seqno)) AS f, arg_max(seqno, row(ts, seqno)) AS l FROM tb GROUP BY ALL),
qf AS (SELECT symbol, bar, arg_min(seqno, row(ts, seqno)) AS f, arg_max(seqno, row(ts, seqno)) AS l FROM qb GROUP BY ALL),
tg AS (SELECT e.bar, k.symbol, coalesce(x.f, last_value(x.l IGNORE NULLS) OVER (PARTITION BY k.symbol ORDER BY e.bar ROWS UNBOUNDED PRECEDING)) AS tn FROM every e CROSS JOIN (SELECT DISTINCT symbol FROM t) k LEFT JOIN tf x ON x.symbol = k.symbol AND x.bar = e.bar),
qg AS (SELECT e.bar, k.symbol, coalesce(x.f, last_value(x.l IGNORE NULLS) OVER (PARTITION BY k.symbol, {s.DAY.format(c="e.bar")} ORDER BY e.bar ROWS UNBOUNDED PRECEDING)) AS qn FROM every e CROSS JOIN (SELECT DISTINCT symbol FROM q) k LEFT JOIN qf x ON x.symbol = k.symbol AND x.bar = e.bar),
n AS (SELECT bar, symbol, tn, qn FROM (SELECT * FROM tg WHERE tn IS NOT NULL) FULL JOIN (SELECT * FROM qg WHERE qn IS NOT NULL) USING (bar, symbol))
SELECT {s.key_of("n.bar")} AS bar, n.symbol AS "InstrumentID", strftime(coalesce(t.ts, q.ts), '%Y%m%d') AS "TradingDay", nullif(t.lastprice, 0) / 100.0 AS "LastPrice", nullif(t.preclose, 0) / 100.0 AS "PreClosePrice",
  nullif(t.open, 0) / 100.0 AS "OpenPrice", nullif(t.high, 0) / 100.0 AS "HighestPrice", nullif(t.low, 0) / 100.0 AS "LowestPrice", t.totalvol AS "Volume", t.totalamount / 100.0 AS "Turnover",
  CASE WHEN tn IS NOT NULL AND limitup <> 0 THEN limitup / pow(10.0, ins.decimal) END AS "UpperLimitPrice", CASE WHEN tn IS NOT NULL AND limitdown <> 0 THEN limitdown / pow(10.0, ins.decimal) END AS "LowerLimitPrice",
  strftime(n.bar, '%Y%m%d %H:%M:00') AS "UpdateTime", nullif(q.bidprice, 0) / 100.0 AS "BidPrice1", q.bidsize AS "BidVolume1", nullif(q.askprice, 0) / 100.0 AS "AskPrice1", q.asksize AS "AskVolume1",
  '69' AS "Type", ends.seq AS "Seqno", strftime(coalesce(t.ts, q.ts), '%Y-%m-%d %H:%M:%S.%f') AS "LocalTime",
  round(CASE WHEN t.preclose <> 0 THEN (t.lastprice / 100.0 - t.preclose / 100.0) / (t.preclose / 100.0) + 0.0 END, 9) AS "IntraDailyReturn", CASE t.shortsellflag WHEN 1 THEN 'Y' WHEN 0 THEN 'N' END AS "IsShortRestricted"
FROM n JOIN ends ON ends.bar = n.bar LEFT JOIN t ON t.seqno = tn LEFT JOIN q ON q.seqno = qn LEFT JOIN ins ON ins.symbol = n.symbol"""
WIDE_COLUMNS = "InstrumentID TradingDay LastPrice PreClosePrice OpenPrice HighestPrice LowestPrice Volume Turnover UpperLimitPrice LowerLimitPrice UpdateTime BidPrice1 BidVolume1 AskPrice1 AskVolume1 Type Seqno LocalTime IntraDailyReturn IsShortRestricted".split()


@query(WIDE)
def wide_bar_rows(spark: SparkSession, d: str) -> DataFrame:
    """All of the wide product's columns that ever hold a value."""
    rows = wide.rows(tables.ticks(spark, d), tables.quotes(spark, d), _ins(spark, d), "hour")
    return keyed(rows).select("bar", *WIDE_COLUMNS).withColumn("IntraDailyReturn", F.round("IntraDailyReturn", 9))


# ---- sets and control


@query(f"WITH {RAW} SELECT symbol FROM t UNION SELECT symbol FROM q UNION SELECT symbol FROM ins")
def symbol_universe_union(spark: SparkSession, d: str) -> DataFrame:
    feeds_ = (tables.raw_ticks(spark, d), tables.quotes(spark, d), tables.instrument_rows(spark, d))
    a, b, c = (f.select("symbol") for f in feeds_)
    return a.union(b).union(c).distinct()


def _bars_of(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return bars.with_bar(tables.raw_ticks(spark, d), "minute"), bars.with_bar(tables.quotes(spark, d), "minute")


for _name, _op, _sql in (
    ("minutes_intersect", lambda a, b: a.intersect(b), "INTERSECT"),
    ("minutes_missing", lambda a, b: a.exceptAll(b), "EXCEPT"),
    ("minutes_extra", lambda a, b: b.exceptAll(a), None),
):

    def _sets(spark: SparkSession, d: str, op=_op) -> DataFrame:  # noqa: ANN001
        t, q = _bars_of(spark, d)
        return keyed(op(t.select("bar").distinct(), q.select("bar").distinct()))

    QUERIES[_name] = _sets
    _a, _b = (f"SELECT DISTINCT {KEY} AS bar FROM {x}" for x in (("tb", "qb") if _sql else ("qb", "tb")))
    ORACLES[_name] = f"WITH {MINUTE} {_a} {_sql or 'EXCEPT'} {_b}"


def _committed(spark: SparkSession, d: str) -> DataFrame:
    """Bars of ticks that count as emitted: those of even hours, and one that no feed has."""
    t, _ = _bars_of(spark, d)
    odd = spark.sql("SELECT TIMESTAMP_NTZ '2030-01-01 00:00:00' AS bar")
    return t.where(F.hour("bar") % 2 == 0).select("bar").distinct().union(odd)


COMMITTED = "cm AS (SELECT DISTINCT bar FROM tb WHERE extract('hour' FROM bar) % 2 = 0 UNION ALL SELECT TIMESTAMP '2030-01-01 00:00:00')"


@query(
    f"WITH {MINUTE}, {COMMITTED}, i AS (SELECT bar FROM tb UNION SELECT bar FROM qb) SELECT {s.key_of('coalesce(i.bar, cm.bar)')} AS bar, CASE WHEN i.bar IS NULL THEN 'extra' WHEN cm.bar IS NULL THEN 'missing' ELSE 'complete' END AS status FROM i FULL JOIN cm ON i.bar = cm.bar"
)
def three_way_reconcile(spark: SparkSession, d: str) -> DataFrame:
    return keyed(control.three_way(*_bars_of(spark, d), _committed(spark, d)))


@query(f"WITH {MINUTE}, {COMMITTED} SELECT {KEY} AS bar, seqno, symbol, bar IN (SELECT bar FROM cm) AS late FROM tb")
def late_split(spark: SparkSession, d: str) -> DataFrame:
    on_time, late = control.late_split(_bars_of(spark, d)[0], _committed(spark, d))
    both = on_time.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return keyed(both).select("bar", "seqno", "symbol", "late")


@query(f"WITH {MINUTE}, {COMMITTED} SELECT count(*) AS late_rows, count(DISTINCT bar) AS late_bars FROM tb WHERE bar IN (SELECT bar FROM cm)")
def late_stats(spark: SparkSession, d: str) -> DataFrame:
    return control.late_statistics(control.late_split(_bars_of(spark, d)[0], _committed(spark, d))[1])


@query(f"WITH {HOUR} SELECT {KEY} AS bar, seqno, symbol, place, n AS of FROM (SELECT *, row_number() OVER (PARTITION BY bar ORDER BY seqno) AS place, count(*) OVER (PARTITION BY bar) AS n FROM tb) WHERE place <= 3".replace("n AS of", 'n AS "of"'))
def late_cap(spark: SparkSession, d: str) -> DataFrame:
    """The feed's cap on late rows of a bar, with the number that there were."""
    return keyed(control.capped(bars.with_bar(tables.raw_ticks(spark, d), "hour"), 3)).select("bar", "seqno", "symbol", "place", "of")


@query(f"WITH {MINUTE}, {COMMITTED} SELECT DISTINCT {KEY} AS bar FROM tb WHERE bar NOT IN (SELECT bar FROM cm)")
def committed_skip(spark: SparkSession, d: str) -> DataFrame:
    return keyed(_bars_of(spark, d)[0].select("bar").distinct().join(_committed(spark, d), "bar", "left_anti"))


def _shuffled(spark: SparkSession, d: str) -> DataFrame:
    """Ticks that arrive out of order: every 97th comes 500 places late."""
    t = bars.with_bar(tables.raw_ticks(spark, d), "minute")
    return t.withColumn("seqno", F.col("seqno") * 2 + F.when(F.col("seqno") % 97 == 0, 1001).otherwise(0))


@query(
    f"WITH {MINUTE}, a AS (SELECT symbol, bar, seqno * 2 + CASE WHEN seqno % 97 = 0 THEN 1001 ELSE 0 END AS seqno FROM tb), w AS (SELECT *, max(bar) OVER (PARTITION BY symbol ORDER BY seqno ROWS UNBOUNDED PRECEDING) AS wm FROM a) SELECT seqno, symbol, {KEY} AS bar, {s.key_of('wm')} AS watermark, bar < wm AS behind FROM w"
)
def running_watermark(spark: SparkSession, d: str) -> DataFrame:
    rows = control.running_watermark(_shuffled(spark, d).select("symbol", "bar", "seqno"))
    return keyed(rows.withColumn("watermark", timebars.bar_key(F.col("watermark")))).select("seqno", "symbol", "bar", "watermark", "behind")


@query(f"WITH {RAW} SELECT seqno, symbol, row_number() OVER (ORDER BY seqno) AS number FROM t")
def arrival_seqno(spark: SparkSession, d: str) -> DataFrame:
    return control.arrival_numbers(tables.raw_ticks(spark, d).select("seqno", "symbol"), "seqno")


@query(f"WITH {MINUTE}, b2 AS (SELECT DISTINCT bar FROM tb) SELECT {KEY} AS bar, strftime(bar, '%Y-%m-%d') AS date, row_number() OVER (PARTITION BY CAST(bar AS DATE) ORDER BY bar) AS number FROM b2")
def bar_seqno(spark: SparkSession, d: str) -> DataFrame:
    return keyed(control.bar_numbers(_bars_of(spark, d)[0])).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    f"WITH {MINUTE}, a AS (SELECT symbol, ts, seqno * 2 + CASE WHEN seqno % 97 = 0 THEN 1001 ELSE 0 END AS seqno FROM tb), w AS (SELECT *, lag(seqno) OVER (PARTITION BY symbol ORDER BY ts) AS before FROM a) SELECT symbol, seqno, before FROM w WHERE seqno <= before"
)
def seqno_monotone_check(spark: SparkSession, d: str) -> DataFrame:
    return control.not_increasing(_shuffled(spark, d), "seqno", "symbol", "ts", F.to_date("ts")).select("symbol", "seqno", "before")


@query(
    f"WITH {MINUTE}, a AS (SELECT symbol, ts, seqno * 2 + CASE WHEN seqno % 97 = 0 THEN 1001 ELSE 0 END AS seqno FROM tb), w AS (SELECT *, max(seqno) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS most FROM a) SELECT symbol, seqno FROM w WHERE most IS NULL OR seqno > most"
)
def offset_monotone_filter(spark: SparkSession, d: str) -> DataFrame:
    return control.increasing(_shuffled(spark, d), "seqno", "symbol", "ts", F.to_date("ts")).select("symbol", "seqno")


@query(
    f"WITH {HOUR}, x AS (SELECT bar, count(*) AS n FROM tb GROUP BY bar), y AS (SELECT bar, count(*) AS n FROM tb WHERE seqno % 13 > 0 GROUP BY bar) SELECT {s.key_of('x.bar')} AS bar, x.n AS source_rows, coalesce(y.n, 0) AS output_rows, x.n - coalesce(y.n, 0) AS difference FROM x LEFT JOIN y ON x.bar = y.bar"
)
def minute_counts_source_vs_output(spark: SparkSession, d: str) -> DataFrame:
    """An output that has lost some rows, to be seen by the comparison."""
    t = bars.with_bar(tables.raw_ticks(spark, d), "hour")
    return keyed(control.counts_compared(t, t.where("seqno % 13 > 0")))


@query(
    f"WITH {MINUTE}, {COMMITTED} SELECT count(DISTINCT tb.bar) AS tick_bars, {s.key_of('min(tb.bar)')} AS tick_first, {s.key_of('max(tb.bar)')} AS tick_last, count(*) AS tick_rows, count(DISTINCT symbol) AS tick_symbols,"
    f" (SELECT count(DISTINCT bar) FROM qb) AS quote_bars, (SELECT {s.key_of('min(bar)')} FROM qb) AS quote_first, (SELECT {s.key_of('max(bar)')} FROM qb) AS quote_last, (SELECT count(*) FROM qb) AS quote_rows, (SELECT count(DISTINCT symbol) FROM qb) AS quote_symbols,"
    " count(*) FILTER (WHERE tb.bar IN (SELECT bar FROM cm)) AS late_rows, count(DISTINCT tb.bar) FILTER (WHERE tb.bar IN (SELECT bar FROM cm)) AS late_bars FROM tb"
)
def replay_summary(spark: SparkSession, d: str) -> DataFrame:
    t, q = _bars_of(spark, d)
    out = control.summary(t, q, control.late_split(t, _committed(spark, d))[1])
    return out.select(*[timebars.bar_key(F.col(c)).alias(c) if c.endswith(("_first", "_last")) else F.col(c) for c in out.columns])


@query(f"WITH {MINUTE} SELECT DISTINCT {KEY} AS bar FROM tb ORDER BY 1 LIMIT 10")
def oldest_n_bars(spark: SparkSession, d: str) -> DataFrame:
    return keyed(control.oldest_bars(_bars_of(spark, d)[0], 10))


@query(f"WITH {RAW} SELECT symbol, seqno, place FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY seqno DESC) AS place FROM t) WHERE place <= 10")
def retention_top_n(spark: SparkSession, d: str) -> DataFrame:
    return control.newest(tables.raw_ticks(spark, d), "symbol", "seqno", 10).select("symbol", "seqno", "place")


@query(f"WITH {MINUTE}, w AS (SELECT max(bar) AS wm FROM tb) SELECT DISTINCT {KEY} AS bar, wm >= bar + INTERVAL 90 MINUTE AS due FROM tb, w")
def bars_due(spark: SparkSession, d: str) -> DataFrame:
    own = _bars_of(spark, d)[0].select("bar").distinct()
    newest = own.agg(F.max("bar").alias("watermark"))
    return keyed(own.join(F.broadcast(newest)).select("bar", timebars.due(F.col("watermark"), F.col("bar"), 90).alias("due")))


# ---- streams, each run to its end

QUERIES["stream_bars_append"] = streams.bars_append
ORACLES["stream_bars_append"] = f"WITH {HOUR} SELECT {KEY} AS bar, symbol, open, high, low, close, count, seqno FROM b"
QUERIES["stream_late_append"] = streams.late_append
ORACLES["stream_late_append"] = (
    f"WITH {HOUR}, w AS (SELECT max(ts) - INTERVAL 2 hour AS passed FROM tb WHERE seqno % 97 > 0) SELECT seqno, symbol, {KEY} AS bar, seqno % 97 = 0 AND bar <= passed AS late FROM tb, w"
)
QUERIES["stream_stall_flush"] = streams.stall_flush
ORACLES["stream_stall_flush"] = (
    f"WITH {HOUR} SELECT symbol, {KEY} AS bar, count, close, CASE WHEN bar = max(bar) OVER (PARTITION BY symbol) THEN 'stall' ELSE 'next' END AS why FROM b"
)
QUERIES["stream_late_in_stall"] = streams.late_in_stall
ORACLES["stream_late_in_stall"] = (
    f"WITH {HOUR}, p AS (SELECT symbol, max(bar) AS present FROM tb WHERE seqno % 97 > 0 GROUP BY symbol), m AS ("
    "SELECT tb.*, coalesce(seqno % 97 = 0 AND bar < present, false) AS late FROM tb LEFT JOIN p USING (symbol)), o AS ("
    "SELECT symbol, bar, late, count(*) AS count, arg_max(lastprice, seqno) / 100.0 AS close FROM m GROUP BY ALL)"
    f" SELECT symbol, {KEY} AS bar, count, close, CASE WHEN late THEN 'late' WHEN bar = max(bar) FILTER (WHERE NOT late) OVER (PARTITION BY symbol) THEN 'stall' ELSE 'next' END AS why FROM o"
)
QUERIES["stream_two_feed_gate"] = streams.two_feed_gate
ORACLES["stream_two_feed_gate"] = (
    f"WITH {HOUR}, u AS (SELECT bar, symbol, 1 AS tick FROM tb UNION ALL SELECT bar, symbol, 0 FROM qb) SELECT {KEY} AS bar, symbol, CAST(sum(tick) AS BIGINT) AS ticks, CAST(sum(1 - tick) AS BIGINT) AS quotes FROM u GROUP BY bar, symbol"
)


@query(
    f"WITH {RAW}, k AS (SELECT symbol FROM t UNION SELECT symbol FROM q), a AS (SELECT symbol, max(row(ts, seqno)) AS n, max(CAST(ts AS DATE)) AS day FROM t GROUP BY symbol), b AS (SELECT symbol, max(row(ts, seqno)) AS n FROM q GROUP BY symbol),"
    " f AS (SELECT t.symbol, arg_min(totalvol, row(ts, t.seqno)) AS base FROM t JOIN a ON a.symbol = t.symbol AND CAST(t.ts AS DATE) = a.day GROUP BY t.symbol)"
    " SELECT k.symbol, t.seqno AS tick_seqno, t.lastprice, t.totalvol, t.totalamount, q.seqno AS quote_seqno, q.bidprice, q.asksize, strftime(a.day, '%Y-%m-%d') AS day, t.totalvol - f.base AS day_volume"
    " FROM k LEFT JOIN a USING (symbol) LEFT JOIN t ON t.symbol = k.symbol AND row(t.ts, t.seqno) = a.n LEFT JOIN f ON f.symbol = k.symbol LEFT JOIN b ON b.symbol = k.symbol LEFT JOIN q ON q.symbol = k.symbol AND row(q.ts, q.seqno) = b.n"
)
def stream_latest_state(spark: SparkSession, d: str) -> DataFrame:
    s_ = streams.latest_state(spark, d)
    return s_.select(
        "symbol", "tick_seqno", F.col("tick_lastprice").alias("lastprice"), F.col("tick_totalvol").alias("totalvol"), F.col("tick_totalamount").alias("totalamount"), "quote_seqno",
        F.col("quote_bidprice").alias("bidprice"), F.col("quote_asksize").alias("asksize"), F.date_format("day", "yyyy-MM-dd").alias("day"), "day_volume",
    )


QUERIES["stream_latest_resumed"] = streams.latest_resumed
ORACLES["stream_latest_resumed"] = (
    f"WITH {RAW} SELECT symbol, arg_max(seqno, row(ts, seqno)) AS tick_seqno, arg_max(lastprice, row(ts, seqno)) AS tick_lastprice, arg_max(totalvol, row(ts, seqno)) AS tick_totalvol, arg_max(totalamount, row(ts, seqno)) AS tick_totalamount FROM t GROUP BY symbol"
)


@query(SNAPSHOT)
def stream_snapshot_full(spark: SparkSession, d: str) -> DataFrame:
    return keyed(streams.snapshot_full(spark, d)).select(*SNAPSHOT_COLUMNS)


@query(KLINE)
def stream_kline_full(spark: SparkSession, d: str) -> DataFrame:
    return keyed(streams.kline_full(spark, d))


@query(WIDE)
def stream_wide_rows(spark: SparkSession, d: str) -> DataFrame:
    return keyed(streams.wide_rows(spark, d)).select("bar", *WIDE_COLUMNS).withColumn("IntraDailyReturn", F.round("IntraDailyReturn", 9))


def _until(sql: str, low: str | None, high: str | None) -> str:
    """``sql`` over ticks of a stretch of time only."""
    limits = [f"ts {op} TIMESTAMP '{t}'" for op, t in ((">=", low), ("<", high)) if t]
    return sql.replace("AS bar FROM t)", f"AS bar FROM t WHERE {' AND '.join(limits)})") if limits else sql


@query(f"SELECT *, 1 AS step FROM ({_until(KLINE, None, streams.STEPS[0])}) UNION ALL SELECT *, 2 FROM ({KLINE})")
def stream_open_bars(spark: SparkSession, d: str) -> DataFrame:
    return keyed(streams.open_bars(spark, d))


@query(
    f"WITH {HOUR}, a AS (SELECT bar, CASE WHEN seqno % 97 = 0 THEN 3 WHEN ts < TIMESTAMP '{streams.STEPS[1]}' THEN 1 ELSE 2 END AS step FROM tb),"
    f" c1 AS (SELECT max(bar) AS c FROM (SELECT DISTINCT bar FROM a WHERE step = 1 ORDER BY bar DESC OFFSET {streams.MOST_OPEN})),"
    f" s2 AS (SELECT bar, step, coalesce(step = 2 AND bar <= c, false) AS late FROM a, c1 WHERE step < 3), c2 AS (SELECT max(bar) AS c FROM (SELECT DISTINCT bar FROM s2 WHERE NOT late ORDER BY bar DESC OFFSET {streams.MOST_OPEN})),"
    f" s3 AS (SELECT bar, late FROM s2 UNION ALL SELECT bar, coalesce(bar <= c, false) FROM a, c2 WHERE step = 3), c3 AS (SELECT max(bar) AS c FROM (SELECT DISTINCT bar FROM s3 WHERE NOT late ORDER BY bar DESC OFFSET {streams.MOST_OPEN}))"
    f" SELECT {KEY} AS bar, count(*) FILTER (WHERE NOT late) AS rows, count(*) FILTER (WHERE late) AS late_rows FROM s3, c3 WHERE late OR bar <= c GROUP BY 1"
)
def stream_evicted_bars(spark: SparkSession, d: str) -> DataFrame:
    return streams.evicted_bars(spark, d)


def _quote_lines(spark: SparkSession, d: str) -> DataFrame:
    q = tables.quotes(spark, d)
    fields = ["symbol", timebars.digits(F.col("ts")), "bidprice", "bidsize", "askprice", "asksize"]
    return q.select("seqno", F.concat_ws(",", *[(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]).alias("line"))


_STEP2 = "seqno % 97 = 0"
TEXT = f"""
WITH {RAW}, g AS (SELECT row_number() OVER (ORDER BY {_STEP2}, seqno) AS number, seqno, CASE WHEN seqno % 200 = 100 THEN 'x' ELSE symbol END AS symbol, date_trunc('millisecond', ts) AS ts, lastprice FROM rt WHERE {GOOD}),
qm AS (SELECT seqno, date_trunc('millisecond', ts) AS ts FROM q), gb AS (SELECT *, {s.end_of("ts", "hour")} AS bar FROM g),
w AS (SELECT least((SELECT max(ts) FROM g WHERE NOT {_STEP2}), (SELECT max(ts) FROM qm WHERE NOT {_STEP2})) - INTERVAL 2 hour AS c1, least((SELECT max(ts) FROM g), (SELECT max(ts) FROM qm)) - INTERVAL 2 hour AS c2)
SELECT number AS seqno, symbol, {KEY} AS bar, lastprice, {_STEP2} AND bar <= c1 AS late FROM gb, w WHERE bar <= c2 OR ({_STEP2} AND bar <= c1)"""


def _text_products(spark: SparkSession, d: str) -> streams.TextIntake:
    return streams.text_products(spark, _tick_lines(spark, d), _quote_lines(spark, d), _ins(spark, d))


@query(TEXT)
def stream_products(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the bars that came out of two text feeds, numbered by arrival over a restart, and the late rows beside them."""
    writer = _text_products(spark, d).writer
    columns = ["seqno", "symbol", "bar", "lastprice"]
    own = writer.read(spark, "snapshot").where("update_flag = 'Y'").select(*columns, F.lit(False).alias("late"))
    late = writer.late(spark)
    return keyed(own if late is None else own.unionByName(late.where("feed = 'tick'").select(*columns, F.lit(True).alias("late"))))


@query(
    f"WITH {RAW} SELECT CASE WHEN seqno % 97 = 0 THEN 1 ELSE 0 END AS batch, count(*) AS lines, count(*) FILTER (WHERE tick AND NOT good) AS rejected, count(*) FILTER (WHERE tick AND good) AS ticks, count(*) FILTER (WHERE NOT tick) AS quotes,"
    " count(*) FILTER (WHERE tick AND good AND seqno % 37 = 0) AS negative_price, count(*) FILTER (WHERE tick AND good AND seqno % 41 = 0) AS negative_volume, count(*) FILTER (WHERE tick AND good AND seqno % 43 = 0) AS unknown_status"
    f" FROM (SELECT seqno, true AS tick, {GOOD} AS good FROM rt UNION ALL SELECT seqno, false, true FROM q) GROUP BY 1"
)
def stream_intake_metrics(spark: SparkSession, d: str) -> DataFrame:
    """What each batch of the text feeds held, observed while its good rows were written."""
    return streams.text_products(spark, _tick_lines(spark, d, True), _quote_lines(spark, d), _ins(spark, d)).metrics(spark)


@query(SNAPSHOT)
def resumed_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """A product that lacks every fifth hour and all after a midnight, completed from what it has."""
    ticks, names, path = tables.ticks(spark, d), _ins(spark, d), sinks.scratch(spark, "resumed")
    made = bars.snapshot(ticks.where(F.col("ts") < F.lit(streams.STOPPED).cast("timestamp_ntz")), names, "hour", by_bar=True)
    sinks.write_product(made.where(F.hour("bar") % 5 > 0), path)
    resume.resume(ticks, names, path, "hour")
    return keyed(resume.with_bars(spark.read.parquet(path))).select(*SNAPSHOT_COLUMNS)


@query(f"WITH {RAW} SELECT * FROM ins")
def stream_instruments(spark: SparkSession, d: str) -> DataFrame:
    return streams.master(spark, d).select("symbol", "name", "market", "limitup", "limitdown", "decimal")
