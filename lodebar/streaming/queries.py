"""Streams over the driver's events, each run until its input is used up.

Steps of a feed are written one after the other, by as many tasks as there are, and the stream takes up from its
checkpoint after each: what a step brings is one micro-batch, whatever the number of files.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from lodebar.functions.timebars import bar_key
from lodebar.operators import instruments, sinks
from lodebar.operators import bars as batch_bars
from lodebar.operators.sinks import scratch
from lodebar.sources import tables
from lodebar.streaming import bars, latest, tail_source
from lodebar.streaming.intake import TextIntake, text_schemas
from lodebar.streaming.products import ProductWriter, both_feeds
from lodebar.streaming.tables import MasterTable, Upsert


class Feed:
    """A folder that a stream reads and steps are written to."""

    def __init__(self, spark: SparkSession, like: DataFrame, label: str) -> None:
        self.spark, self.path = spark, scratch(spark, label)
        self.schema = self._stored(like).schema
        self._stored(like.limit(0)).write.parquet(self.path)

    @staticmethod
    def _stored(rows: DataFrame) -> DataFrame:
        return rows.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in rows.columns else rows

    def write(self, rows: DataFrame) -> None:
        self._stored(rows).write.mode("append").parquet(self.path)

    def read(self, **options: int) -> DataFrame:
        rows = self.spark.readStream.schema(self.schema).options(**options).parquet(self.path)
        return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")) if "ts" in rows.columns else rows


def _stepped(
    spark: SparkSession, label: str, steps: list[list[tuple[Feed, DataFrame]]], writer: Callable[[], DataStreamWriter], after: Callable[[int], None] = lambda n: None
) -> None:
    """Writes each step's rows and runs the stream until it has used them up; ``after`` is called with the step's number."""
    checkpoint = scratch(spark, f"{label}-checkpoint")
    for n, step in enumerate(steps):
        for feed, rows in step:
            feed.write(rows)
        writer().option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        after(n)


def _ending(rows: DataFrame) -> DataFrame:
    """A row far ahead of ``rows``, which moves the watermark past all of them."""
    values = {"symbol": F.lit("~end"), "ts": F.lit("2100-01-01 00:30:00").cast("timestamp_ntz"), "seqno": F.lit(1 << 40)}
    return rows.limit(1).select(*[values.get(c, F.col(c)).cast(dict(rows.dtypes)[c]).alias(c) for c in rows.columns])


def bars_append(spark: SparkSession, d: str) -> DataFrame:
    """Watermarked hourly bars in append mode; bars close a batch after the watermark moves, so the end comes twice."""
    rows, out = tables.raw_ticks(spark, d), scratch(spark, "bars")
    feed, end = Feed(spark, rows, "ticks"), _ending(rows)
    _stepped(
        spark, "bars", [[(feed, rows)], [(feed, end)], [(feed, end)]],
        lambda: bars.windowed_bars(feed.read(), "1 hour").writeStream.format("parquet").option("path", out).outputMode("append"),
    )
    return spark.read.parquet(out).where("symbol <> '~end'").withColumn("bar", bar_key(F.col("bar")))


def _in_two(spark: SparkSession, d: str) -> tuple[Feed, list[list[tuple[Feed, DataFrame]]]]:
    """A feed of ticks whose every 97th row comes in a second step."""
    rows = tables.raw_ticks(spark, d)
    feed = Feed(spark, rows, "feed")
    return feed, [[(feed, rows.where("seqno % 97 > 0"))], [(feed, rows.where("seqno % 97 = 0"))]]


def late_append(spark: SparkSession, d: str) -> DataFrame:
    """Rows on time and late, when every 97th comes in a second batch: late are those whose bar the watermark had passed."""
    feed, steps = _in_two(spark, d)
    out = scratch(spark, "written")
    _stepped(spark, "late", steps, lambda: feed.read().writeStream.foreachBatch(bars.BarWriter(out, "hour", "2 hours")))
    both = spark.read.parquet(f"{out}/rows").withColumn("late", F.lit(False)).unionByName(spark.read.parquet(f"{out}/late").withColumn("late", F.lit(True)))
    return both.select("seqno", "symbol", bar_key(F.col("bar")).alias("bar"), "late")


#: Seconds after which a stream that should have run out of bars has failed.
PATIENCE_S = 900


def _stalling(spark: SparkSession, feed: Feed, steps: list[list[tuple[Feed, DataFrame]]]) -> DataFrame:
    """Bars of all steps, the last ones by running out of time: it is over when no symbol has a bar in the making.

    Streams with timers never end by themselves, so all steps run in one: a batch takes the files of the first step, which
    are as many as those of a later one or more, so that one batch follows the other and no symbol runs out of time between.
    """
    files = 0
    for step in steps:
        for own, rows in step:
            own.write(rows)
        files = files or len(spark.read.parquet(feed.path).inputFiles())
    out = scratch(spark, "stalled")
    kind = "symbol string, bar timestamp, count long, close double, why string"
    if spark.read.parquet(feed.path).limit(1).count():
        ticks = feed.read(maxFilesPerTrigger=files)
        writer = bars.stalled_bars(ticks, "hour", 500).writeStream.format("parquet").option("path", out).outputMode("append")
        query = writer.option("checkpointLocation", scratch(spark, "stalled-checkpoint")).trigger(processingTime="0 seconds").start()
        until = time.monotonic() + PATIENCE_S
        while query.isActive:
            if time.monotonic() > until:
                query.stop()
                raise TimeoutError(f"bars are still in the making after {PATIENCE_S} s")
            done = query.lastProgress
            if done and done["stateOperators"] and done["numInputRows"] == 0 and done["stateOperators"][0]["numRowsTotal"] == 0:
                break
            time.sleep(0.2)
        failed = query.exception()
        query.stop()
        if failed is not None:
            raise failed
    else:
        spark.createDataFrame([], kind).write.parquet(out)
    return spark.read.schema(kind).parquet(out).withColumn("bar", bar_key(F.col("bar").cast("timestamp_ntz")))


def stall_flush(spark: SparkSession, d: str) -> DataFrame:
    """Hourly bars of each symbol, emitted as its next one begins, the last ones because nothing more comes."""
    rows = tables.raw_ticks(spark, d)
    feed = Feed(spark, rows, "feed")
    return _stalling(spark, feed, [[(feed, rows)]])


def late_in_stall(spark: SparkSession, d: str) -> DataFrame:
    """The same when every 97th row comes in a second batch: rows behind their symbol's present bar come out as late."""
    feed, steps = _in_two(spark, d)
    return _stalling(spark, feed, steps)


def two_feed_gate(spark: SparkSession, d: str) -> DataFrame:
    """Counts of both feeds for each hour and symbol, once both have passed it."""
    out = scratch(spark, "gated")
    both = [(Feed(spark, r, n), r) for r, n in ((tables.raw_ticks(spark, d), "ticks"), (tables.quotes(spark, d), "quotes"))]
    end = [(feed, _ending(rows)) for feed, rows in both]
    _stepped(
        spark, "gated", [both, end, end],
        lambda: bars.gated_bars(*(feed.read() for feed, _ in both), "1 hour").writeStream.format("parquet").option("path", out).outputMode("append"),
    )
    return spark.read.parquet(out).where("symbol <> '~end'").withColumn("bar", bar_key(F.col("bar")))


def _in_three(rows: DataFrame) -> list[DataFrame]:
    """Rows in three steps, by arrival modulo 3: the later two bring rows that are older than what was there."""
    return [rows.where(F.col("seqno") % 3 == k) for k in range(3)]


def latest_state(spark: SparkSession, d: str) -> DataFrame:
    """Last tick, last quote and the newest day's volume of each symbol, over three batches of which two are late."""
    sides = [(Feed(spark, r, n), r) for r, n in ((tables.ticks(spark, d), "ticks"), (tables.quotes(spark, d), "quotes"))]
    parts = [(feed, _in_three(rows)) for feed, rows in sides]
    table = Upsert(scratch(spark, "latest"), latest.STATE, "symbol")
    with latest.keyed_state(spark):
        _stepped(
            spark, "latest", [[(feed, own[k]) for feed, own in parts] for k in (2, 0, 1)],
            lambda: latest.latest_state(*(feed.read() for feed, _ in sides)).writeStream.foreachBatch(table).outputMode("update"),
        )
    return table.read(spark)


#: The days of the events before and from which the queries of resumed runs stop and go on.
STOPPED = "2024-01-16"


def latest_resumed(spark: SparkSession, d: str) -> DataFrame:
    """Last ticks when a stream stops at midnight and a new one, without its checkpoint, goes on from the written product."""
    ticks = tables.ticks(spark, d)
    first, rest = ticks.where(F.col("ts") < F.lit(STOPPED).cast("timestamp_ntz")), ticks.where(F.col("ts") >= F.lit(STOPPED).cast("timestamp_ntz"))
    product, names = scratch(spark, "product"), tables.instrument_rows(spark, d)
    sinks.write_product(batch_bars.snapshot(first, instruments.merged(names), "hour", by_bar=True), product)
    begin = sinks.staged(latest.feed_rows(sinks.latest_from(spark, product), "tick"), "begin") if not first.isEmpty() else None
    feed, table = Feed(spark, ticks, "ticks"), Upsert(scratch(spark, "latest"), latest.STATE, "symbol")
    if begin is not None:
        table(latest.as_state(begin), 0)
    with latest.keyed_state(spark):
        _stepped(
            spark, "resumed", [[(feed, rest)]],
            lambda: latest.latest_state(feed.read(), first=begin).writeStream.foreachBatch(lambda rows, n: table(rows, n + 1)).outputMode("update"),
        )
    return table.read(spark).select("symbol", "tick_seqno", "tick_lastprice", "tick_totalvol", "tick_totalamount")


#: Days whose ends part the steps of the streams that make products.
STEPS = ("2024-01-08 13:20:00", "2024-01-16 00:00:00")


def _products(spark: SparkSession, d: str, *products: str, steps: tuple[str, ...] = STEPS) -> ProductWriter:
    """Both feeds, parted at the given times and run through a stream that writes ``products``; a last row of each closes all bars."""
    ticks, quotes = tables.ticks(spark, d), tables.quotes(spark, d)
    feeds = [(Feed(spark, r, n), r) for r, n in ((ticks, "ticks"), (quotes, "quotes"))]
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    limits = [None, *steps, None]
    within = lambda rows, low, high: rows.where((F.lit(True) if low is None else F.col("ts") >= at(low)) & (F.lit(True) if high is None else F.col("ts") < at(high)))
    parts = [[(feed, within(rows, low, high)) for feed, rows in feeds] for low, high in zip(limits, limits[1:], strict=False)]
    parts[-1] += [(feed, _ending(rows)) for feed, rows in feeds]
    names = instruments.merged(tables.instrument_rows(spark, d))
    writer = ProductWriter(scratch(spark, "products"), ticks.schema, quotes.schema, lambda s: names, "hour", products=products)
    _stepped(spark, "products", parts, lambda: both_feeds(*(feed.read() for feed, _ in feeds)).writeStream.foreachBatch(writer))
    return writer


def snapshot_full(spark: SparkSession, d: str) -> DataFrame:
    """Ticks and carried rows of every bar, from a stream in two batches that breaks off within a bar."""
    return _products(spark, d, "snapshot", steps=STEPS[:1]).read(spark, "snapshot")


def kline_full(spark: SparkSession, d: str) -> DataFrame:
    """Gap-filled bars with volumes by day, from a stream that breaks off at midnight."""
    return _products(spark, d, "kline", steps=STEPS[1:]).read(spark, "kline")


def wide_rows(spark: SparkSession, d: str) -> DataFrame:
    """The wide product from two feeds: a bar comes out once both have passed it. It breaks off within a bar and at midnight."""
    return _products(spark, d, "wide").read(spark, "wide")


def master(spark: SparkSession, d: str) -> DataFrame:
    """The instrument master after three batches of its rows, of which the later two bring older rows, too."""
    rows = tables.instrument_rows(spark, d)
    feed, table = Feed(spark, rows, "master"), MasterTable(scratch(spark, "master"), rows)
    _stepped(spark, "master", [[(feed, part)] for part in reversed(_in_three(rows))], lambda: feed.read().writeStream.foreachBatch(table))
    return table.read(spark)


def open_bars(spark: SparkSession, d: str) -> DataFrame:
    """Gap-filled bars after each of two steps, of which the first ends within a bar: bars come out open and are replaced as they grow.

    Only bars that are open after the first step are kept aside, as the second replaces them; closed ones stay in the product as they are.
    """
    ticks = tables.ticks(spark, d)
    names = instruments.merged(tables.instrument_rows(spark, d))
    at = F.lit(STEPS[0]).cast("timestamp_ntz")
    feed = Feed(spark, ticks, "ticks")
    writer = ProductWriter(scratch(spark, "open"), ticks.schema, None, lambda s: names, "hour", products=("kline",), open_bars=True)
    closed: list[Column] = []
    growing: list[DataFrame] = []

    def after(n: int) -> None:
        if n == 0:
            closed.append(F.col("bar") <= F.lit(writer.control(spark)["closed"]).cast("timestamp_ntz"))
            growing.append(sinks.staged(writer.read(spark, "kline").where(~closed[0]), "step"))

    _stepped(spark, "open", [[(feed, ticks.where(F.col("ts") < at))], [(feed, ticks.where(F.col("ts") >= at))]], lambda: feed.read().writeStream.foreachBatch(writer), after)
    last = writer.read(spark, "kline")
    first = last.where(closed[0]).unionByName(growing[0])
    return first.withColumn("step", F.lit(1)).unionByName(last.withColumn("step", F.lit(2)))


#: Bars that may be open at once in the stream that evicts.
MOST_OPEN = 24


def evicted_bars(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each bar that came out, on time or late, when nothing but a bound on open bars closes bars; every 97th row comes last."""
    ticks = tables.raw_ticks(spark, d).withColumn("totalvol", F.lit(0).cast("long")).withColumn("totalamount", F.lit(0).cast("long"))
    names = instruments.merged(tables.instrument_rows(spark, d))
    at, last = F.lit(STEPS[1]).cast("timestamp_ntz"), F.col("seqno") % 97 == 0
    feed = Feed(spark, ticks, "ticks")
    writer = ProductWriter(scratch(spark, "evicted"), ticks.schema, None, lambda s: names, "hour", "1000 days", products=("snapshot",), most_open=MOST_OPEN)
    steps = [[(feed, ticks.where(~last & (F.col("ts") < at)))], [(feed, ticks.where(~last & (F.col("ts") >= at)))], [(feed, ticks.where(last))]]
    _stepped(spark, "evicted", steps, lambda: feed.read().writeStream.foreachBatch(writer))
    on_time = writer.read(spark, "snapshot").where("update_flag = 'Y'").select("bar", F.lit(0).alias("late"))
    late = writer.late(spark)
    both = on_time if late is None else on_time.unionByName(late.select("bar", F.lit(1).alias("late")))
    return both.groupBy(bar_key(F.col("bar")).alias("bar")).agg(F.count(F.when(F.col("late") == 0, 1)).alias("rows"), F.sum("late").alias("late_rows"))


def text_products(spark: SparkSession, tick_lines: DataFrame, quote_lines: DataFrame, names: DataFrame) -> TextIntake:
    """Both text feeds, (seqno, line), followed as they grow: every 97th line comes in a second step, after a restart of the stream."""
    schemas = text_schemas(spark)
    writer = ProductWriter(scratch(spark, "text-products"), schemas["tick"], schemas["quote"], lambda s: names, "hour", "2 hours", products=("snapshot",))
    intake = TextIntake(f"{writer.path}/intake", writer)
    folders = {"tick": (scratch(spark, "tick-lines"), tick_lines), "quote": (scratch(spark, "quote-lines"), quote_lines)}
    checkpoint = scratch(spark, "text-checkpoint")
    for condition in ("seqno % 97 > 0", "seqno % 97 = 0"):
        for path, rows in folders.values():  # ranges of arrivals, a file each, in the order of their names
            rows.where(condition).repartitionByRange("seqno").sortWithinPartitions("seqno").select("line").write.mode("append").text(path)
        ticks, quotes = (tail_source.follow(spark, f"{path}/part-*").withColumn("feed", F.lit(f)) for f, (path, _) in folders.items())
        stream = ticks.unionByName(quotes).writeStream.foreachBatch(intake).option("checkpointLocation", checkpoint).start()
        try:
            stream.processAllAvailable()
        finally:
            stream.stop()
    return intake
