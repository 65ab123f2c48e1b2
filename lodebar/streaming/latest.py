"""The latest state of each symbol, kept as state: last tick, last quote, and what the day has traded.

Rows are taken in whatever order they come: a late one counts by its time, receipt and arrival, and replaces nothing that is
newer. All three are greatest or least values, so Spark's own streaming aggregation keeps them, from what each task has made
of its rows. The work of a batch follows the batch's rows; nothing that came before is read again. A stream that starts anew
can take its first state from a product on disk.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = ("ts", "rcvtime", "seqno")
TICK = (*ORDER, "lastprice", "totalvol", "totalamount")
QUOTE = (*ORDER, "bidprice", "bidsize", "askprice", "asksize")

_KINDS = {"ts": "timestamp_ntz"}


def _fields(columns: tuple[str, ...], prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c} {_KINDS.get(c, 'long')}" for c in columns)


#: What comes out: the symbol's state after a batch that changed it; day_volume is what the newest day's ticks have grown by.
STATE = f"symbol string, {_fields(TICK, 'tick_')}, {_fields(QUOTE, 'quote_')}, day date, day_volume long"

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, off the heap and on disk."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _newest(columns: tuple[str, ...]) -> Column:
    """What grows to the newest row by time, receipt and arrival."""
    return F.struct(*columns)


def _day() -> Column:
    """What shrinks to the first tick of the newest day."""
    back = -F.unix_date(F.to_date("ts"))
    return F.struct(back.alias("back"), *ORDER, "totalvol")


def feed_rows(rows: DataFrame, feed: str) -> DataFrame:
    """One feed's rows in the layout that both share; 0 for nulls and columns that a feed doesn't have. Rows without a time are left out."""
    columns = [c for c in dict.fromkeys((*TICK, *QUOTE)) if c != "ts"]
    value = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0)) if c in rows.columns else F.lit(0).cast("long")
    return rows.where("ts is not null").select("symbol", F.lit(feed).alias("feed"), F.col("ts").cast("timestamp_ntz").alias("ts"), *[value(c).alias(c) for c in columns])


def as_state(rows: DataFrame) -> DataFrame:
    """Rows of ``feed_rows``, one tick for each symbol, as the table that ``latest_state`` keeps up to date."""
    empty = [F.lit(None).cast(_KINDS.get(c, "long")).alias(f"quote_{c}") for c in QUOTE]
    return rows.select("symbol", *[F.col(c).alias(f"tick_{c}") for c in TICK], *empty, F.to_date("ts").alias("day"), F.lit(0).cast("long").alias("day_volume"))


def latest_state(ticks: DataFrame, quotes: DataFrame | None = None, first: DataFrame | None = None) -> DataFrame:
    """A stream of changed states (STATE), for update mode; ``first`` are rows of ``feed_rows`` that the state begins with.

    Between feed rows the newest by time, receipt and arrival counts, whatever batch brings it. ``first`` joins what comes out,
    so a stream that goes on from its checkpoint has to be given the same rows again.
    """
    rows = feed_rows(ticks, "tick")
    if quotes is not None:
        rows = rows.unionByName(feed_rows(quotes, "quote"))
    of = lambda rows: rows.groupBy("symbol").agg(
        F.max(F.when(F.col("feed") == "tick", _newest(TICK))).alias("tick"), F.max(F.when(F.col("feed") == "quote", _newest(QUOTE))).alias("quote"),
        F.min(F.when(F.col("feed") == "tick", _day())).alias("low"),
    )
    held = of(rows)
    if first is not None:
        held = held.join(of(first).select("symbol", *[F.col(c).alias(f"first_{c}") for c in ("tick", "quote", "low")]), "symbol", "left")
        held = held.select("symbol", *[pick(c, f"first_{c}").alias(c) for c, pick in (("tick", F.greatest), ("quote", F.greatest), ("low", F.least))])
    sides = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side, columns in (("tick", TICK), ("quote", QUOTE)) for c in columns]
    return held.select("symbol", *sides, F.date_from_unix_date(-F.col("low.back")).alias("day"), (F.col("tick.totalvol") - F.col("low.totalvol")).alias("day_volume"))
