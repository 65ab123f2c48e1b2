"""Bars from streams: watermarked windows, late rows kept apart, stalls flushed, and two feeds waiting for each other."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lodebar.functions.prices import scaled
from lodebar.functions.timebars import bar_end
from lodebar.operators.bars import latest, named
from lodebar.streaming.tables import Versions


def windowed_bars(ticks: DataFrame, width: str, delay: str = "0 seconds") -> DataFrame:
    """Open, high, low, close, count and last arrival of each bar and symbol, emitted once the watermark has passed it.

    Windows are shifted by a microsecond, so that an instant on a boundary falls into the bar that ends there. A bar
    closes a micro-batch after the data that moves the watermark; rows that come later are dropped here and are what
    ``late_rows`` is for.
    """
    price = scaled(F.col("lastprice"), F.col("decimal"))
    window = F.window("ts", width, width, "1 microsecond")
    rows = ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).withColumn("price", price)
    grouped = rows.groupBy(window.alias("w"), "symbol").agg(
        F.min_by("price", "seqno").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "seqno").alias("close"),
        F.count("*").alias("count"), F.max("seqno").alias("seqno"),
    )
    bar = (F.col("w.end") - F.expr("INTERVAL 1 MICROSECOND")).cast("timestamp_ntz")
    return grouped.select(bar.alias("bar"), "symbol", "open", "high", "low", "close", "count", "seqno")


class BarWriter:
    """A micro-batch sink: rows of bars that the watermark had passed before their batch are late, others make up bars.

    The watermark is the newest event time of all earlier batches less ``delay``, kept in one row for each batch; a bar may arrive in any number of batches
    until then. Late rows leave their bars alone but count for the latest state. Every output has a folder for each batch,
    and a batch that runs again replaces its own, so nothing is doubled.
    """

    def __init__(self, path: str, unit: str, delay: str = "0 seconds") -> None:
        self.path, self.unit, self.delay = path, unit, delay

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("bar", bar_end(F.col("ts"), self.unit))
        control = Versions(batch.sparkSession, f"{self.path}/control")
        delay = F.expr(f"INTERVAL {self.delay}")
        before = control.before(batch_id, "newest timestamp_ntz").select("newest", (F.col("newest") - delay).alias("watermark")).first()
        newest, passed = (before["newest"], before["watermark"]) if before else (None, None)
        late = F.lit(False) if passed is None else F.col("bar") <= F.lit(passed).cast("timestamp_ntz")
        marked = rows.withColumn("late", F.coalesce(late, F.lit(False))).persist()
        marked.where("late").drop("late").write.mode("overwrite").parquet(f"{self.path}/late/id={batch_id}")
        marked.where("not late").drop("late").write.mode("overwrite").parquet(f"{self.path}/rows/id={batch_id}")
        control.write(marked.agg(F.greatest(F.max("ts"), F.lit(newest).cast("timestamp_ntz")).alias("newest")), batch_id)
        control.forget(batch_id)
        marked.unpersist()

    def latest(self, spark: SparkSession) -> DataFrame:
        """The newest row of each symbol, late ones included: by time, receipt and arrival."""
        both = spark.read.parquet(f"{self.path}/rows").unionByName(spark.read.parquet(f"{self.path}/late"))
        return latest(both.drop("id", "bar"), "ts", *(["rcvtime"] if "rcvtime" in both.columns else []))


STALL = "symbol string, bar timestamp, count long, close double, why string"
_STATE = "bar timestamp, count long, close double, seqno long"


def _by_bar(frames: Iterator[pd.DataFrame]) -> dict[pd.Timestamp, tuple[int, int, float]]:
    """Rows, last arrival and its price in each bar. A symbol's rows are few and symbols are many, so frames are only read here, not worked on."""
    found: dict[pd.Timestamp, tuple[int, int, float]] = {}
    for frame in frames:
        for bar, seqno, price in zip(*(frame[c].tolist() for c in ("bar", "seqno", "price")), strict=True):
            if bar is not pd.NaT:
                n, last, close = found.get(bar, (0, -1, 0.0))
                found[bar] = (n + 1, seqno, price) if seqno > last else (n + 1, last, close)
    return found


def stalled_bars(ticks: DataFrame, unit: str, timeout_ms: int) -> DataFrame:
    """Bars of each symbol, emitted when its next bar begins, or when nothing has come for ``timeout_ms``.

    Rows behind the symbol's present bar come out as bars of their own, marked ``late``: bars that are out are not revised. A
    close is the last arrival's price, whatever batch brings it.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        bar, count, close, seqno = state.get if state.exists else (None, 0, 0.0, -1)
        if state.hasTimedOut:
            if count:
                out.append((key[0], bar, count, close, "stall"))
            state.remove()
        else:
            present = bar
            for own, (n, last, price) in sorted(_by_bar(frames).items()):
                if present is not None and own < present:
                    out.append((key[0], own, n, price, "late"))
                    continue
                if bar is not None and own > bar:
                    if count:
                        out.append((key[0], bar, count, close, "next"))
                    count, seqno = 0, -1
                bar = own
                count += n
                if last > seqno:
                    close, seqno = price, last
            state.update((bar, count, close, seqno))
            state.setTimeoutDuration(timeout_ms)
        if out:
            yield pd.DataFrame(dict(zip(("symbol", "bar", "count", "close", "why"), zip(*out, strict=True), strict=True)))

    price = scaled(F.col("lastprice"), F.col("decimal"))
    rows = ticks.select("symbol", bar_end(F.col("ts"), unit).cast("timestamp").alias("bar"), "seqno", price.alias("price"))
    return rows.groupBy("symbol").applyInPandasWithState(step, STALL, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def with_instruments(read: Callable[[SparkSession], DataFrame], write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A micro-batch function that names each batch's ticks from the master as it is then: ``read`` is asked anew each time."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write(named(batch, read(batch.sparkSession)), batch_id)

    return step


def gated_bars(ticks: DataFrame, quotes: DataFrame, width: str, delay: str = "0 seconds") -> DataFrame:
    """(bar, symbol, ticks, quotes) of both feeds: a bar comes out when both feeds have passed it.

    Spark's watermark over several inputs is the slower one's, so neither feed's silence lets a bar out half-filled.
    """

    def side(rows: DataFrame, tick: int) -> DataFrame:
        return rows.select("symbol", F.col("ts").cast("timestamp").alias("ts"), F.lit(tick).alias("tick")).withWatermark("ts", delay)

    window = F.window("ts", width, width, "1 microsecond")
    both = side(ticks, 1).unionAll(side(quotes, 0)).groupBy(window.alias("w"), "symbol")
    counted = both.agg(F.sum("tick").alias("ticks"), F.sum(1 - F.col("tick")).alias("quotes"))
    return counted.select((F.col("w.end") - F.expr("INTERVAL 1 MICROSECOND")).cast("timestamp_ntz").alias("bar"), "symbol", "ticks", "quotes")
