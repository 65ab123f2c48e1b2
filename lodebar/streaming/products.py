"""Products made by a stream: each batch writes the bars that it closes, each bar once, from what is held of all before.

What is held between batches is small: rows of bars that are still open, the last row of each symbol and feed in the bars that
have closed, and one row of control values. From these the same functions that make a product of everything make the rows
of the bars that close now, so a stream's product is the batch product of its rows on time.

A bar closes once every feed's newest event time, less ``delay``, has reached its end (the slower feed decides), or when more
than ``most_open`` bars are open and it is the oldest. Rows of closed bars are late and go beside the product.

Everything that a batch writes is a partition or a version of its own, and control values come last: a batch that runs again,
wherever it was stopped, reads the versions before its own and writes the same once more.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodebar.functions.timebars import bar_date, bar_end
from lodebar.operators import bars, wide
from lodebar.operators.sinks import append_late, write_product
from lodebar.streaming.tables import Versions

CONTROL = (
    "batch long, newest_tick timestamp_ntz, newest_quote timestamp_ntz, closed timestamp_ntz, numbered date, numbers long, bars long, ticks long, quotes long, late long, evicted array<timestamp_ntz>"
)
FEEDS = ("tick", "quote")
PRODUCTS = ("snapshot", "kline", "wide")


def both_feeds(ticks: DataFrame, quotes: DataFrame) -> DataFrame:
    """One stream of two feeds, told apart by ``feed``; columns that one of them lacks are null there."""
    return ticks.withColumn("feed", F.lit("tick")).unionByName(quotes.withColumn("feed", F.lit("quote")), allowMissingColumns=True)


class ProductWriter:
    """A micro-batch sink for rows of ``both_feeds``, or of ticks alone.

    ticks, quotes: the feeds' schemas; without quotes the ticks alone decide when bars close. names: the instrument master, asked for
    anew in each batch. products: which of PRODUCTS to write (wide needs quotes). open_bars: also write bars that are still open, as
    they are by then; they are replaced as they grow.
    """

    def __init__(
        self, path: str, ticks: StructType, quotes: StructType | None, names: Callable[[SparkSession], DataFrame], unit: str = "minute", delay: str = "0 seconds",
        products: tuple[str, ...] = ("snapshot", "kline"), open_bars: bool = False, most_open: int | None = None,
    ) -> None:
        if set(products) - set(PRODUCTS) or ("wide" in products and quotes is None):
            raise ValueError(f"cannot write {products}")
        self.path, self.names, self.unit, self.delay, self.products = path, names, unit, delay, products
        self.open_bars, self.most_open = open_bars, most_open
        self.schemas = {"tick": ticks} | ({"quote": quotes} if quotes is not None else {})

    def columns(self, feed: str) -> list[str]:
        return self.schemas[feed].names

    def _ddl(self, feed: str) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schemas[feed])

    def _versions(self, spark: SparkSession, what: str) -> Versions:
        return Versions(spark, f"{self.path}/{what}")

    def control(self, spark: SparkSession, batch: int | None = None) -> dict[str, Any]:
        """What was known before ``batch``, or is now."""
        found = self._versions(spark, "control").before(batch, CONTROL).first()
        return found.asDict() if found else dict.fromkeys(("bars", "ticks", "quotes", "late", "numbers"), 0) | dict.fromkeys(("newest_tick", "newest_quote", "closed", "numbered"))

    def _seeds(self, spark: SparkSession, feed: str, batch: int) -> DataFrame:
        """(symbol, bar, by_arrival, by_time): last rows of closed bars."""
        r = f"struct<{self._ddl(feed).replace('` ', '`: ')}>"
        return self._versions(spark, f"last-{feed}").before(batch, f"symbol string, bar timestamp_ntz, by_arrival {r}, by_time {r}")

    def _last(self, rows: DataFrame, feed: str, before: DataFrame) -> DataFrame:
        """The last rows after ``rows`` have closed."""
        row = F.struct(*self.columns(feed))
        time = [c for c in ("ts", "rcvtime", "seqno") if c in self.columns(feed)]
        own = rows.groupBy("symbol").agg(
            F.max("bar").alias("bar"), F.max_by(row, F.struct("bar", "seqno")).alias("by_arrival"), F.max_by(row, F.struct("bar", *time)).alias("by_time"),
        )
        return before.join(own.select("symbol"), "symbol", "left_anti").unionByName(own)

    def _closed(self, opened: DataFrame, newest: dict[str, datetime | None], before: datetime | None) -> tuple[datetime | None, list[datetime]]:
        """The end of the newest bar that is closed now, and the bars that had to close before their time."""
        own = [newest.get(f) for f in self.schemas]
        closed = before
        if all(own):
            delay = F.expr(f"INTERVAL {self.delay}")
            reached = opened.sparkSession.range(1).select((F.lit(min(own)).cast("timestamp_ntz") - delay).alias("t")).first()["t"]
            closed = reached if before is None else max(before, reached)
        if self.most_open is None:
            return closed, []
        pending = opened.select("bar").distinct()
        if closed is not None:
            pending = pending.where(F.col("bar") > F.lit(closed).cast("timestamp_ntz"))
        over = pending.orderBy(F.desc("bar")).offset(self.most_open)
        evicted = sorted(r["bar"] for r in over.collect())  # ends of bars, as many as one batch opens beyond the bound
        return (evicted[-1] if evicted else closed), evicted

    def _write(self, name: str, rows: DataFrame) -> None:
        write_product(rows, f"{self.path}/{name}")

    def _made(self, spark: SparkSession, rows: DataFrame, batch: int, control: dict[str, Any]) -> None:
        """Writes the products' rows of the bars in ``rows``, which come after all that have closed."""
        side = {f: rows.where(F.col("feed") == f).select(*self.columns(f)) for f in self.schemas}
        last = {f: self._seeds(spark, f, batch) for f in self.schemas}
        seeds = {f: (d if not d.isEmpty() else None) for f, d in last.items()}
        r = lambda feed, which: None if seeds[feed] is None else seeds[feed].select("symbol", "bar", F.col(which).alias("r"))
        names = self.names(spark)
        if "snapshot" in self.products:
            self._write("snapshot", bars.snapshot(side["tick"], names, self.unit, seeds=r("tick", "by_arrival"), by_bar=True))
        if "kline" in self.products:
            self._write("kline", bars.kline(side["tick"], names, self.unit, seeds=r("tick", "by_arrival"), by_bar=True))
        if "wide" in self.products:
            numbered = (control["numbered"], control["numbers"]) if control["numbered"] else None
            self._write("wide", wide.rows(side["tick"], side["quote"], names, self.unit, False, r("tick", "by_time"), r("quote", "by_time"), numbered, by_bar=True))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        control, versions = self.control(spark, batch_id), {w: self._versions(spark, w) for w in ("open", "control", *(f"last-{f}" for f in self.schemas))}
        rows = batch.where("ts is not null")
        if "feed" not in rows.columns:
            rows = rows.withColumn("feed", F.lit("tick"))
        rows = rows.withColumn("bar", bar_end(F.col("ts"), self.unit)).persist()
        end = lambda t: F.lit(t).cast("timestamp_ntz")
        is_late = F.col("bar") <= end(control["closed"]) if control["closed"] else F.lit(False)
        counts = {r["feed"]: r for r in rows.groupBy("feed").agg(F.max("ts").alias("newest"), F.count("*").alias("n"), F.count(F.when(is_late, 1)).alias("late")).collect()}
        late, came = sum(r["late"] for r in counts.values()), {f: counts[f]["n"] if f in counts else 0 for f in FEEDS}
        if late:
            append_late(rows.where(is_late), f"{self.path}/rows", batch_id)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        opened = versions["open"].before(batch_id, schema).unionByName(rows.where(~is_late)).persist()
        newest = {f: max((t for t in (control[f"newest_{f}"], counts[f]["newest"] if f in counts else None) if t), default=None) for f in FEEDS}
        closed, evicted = self._closed(opened, newest, control["closed"])
        closing = opened.where(F.col("bar") <= end(closed)) if closed else opened.limit(0)
        done = self._count(closing)
        shown = opened if self.open_bars else closing
        if (done["bars"] or self.open_bars) and not shown.isEmpty():
            self._made(spark, shown, batch_id, control)
        for feed in self.schemas:
            own = closing.where(F.col("feed") == feed).select(*self.columns(feed), "bar")
            versions[f"last-{feed}"].write(self._last(own, feed, self._seeds(spark, feed, batch_id)), batch_id)
        versions["open"].write(opened.where(F.col("bar") > end(closed)) if closed else opened, batch_id)
        day, numbers = done["day"] or control["numbered"], done["numbers"]
        if day == control["numbered"]:
            numbers += control["numbers"]
        values = (
            batch_id, newest["tick"], newest["quote"], closed, day, numbers, control["bars"] + done["bars"],
            control["ticks"] + came["tick"], control["quotes"] + came["quote"], control["late"] + late, evicted,
        )
        versions["control"].write(spark.createDataFrame([values], CONTROL).coalesce(1), batch_id)
        for v in versions.values():
            v.forget(batch_id)
        opened.unpersist()
        rows.unpersist()

    def _count(self, closing: DataFrame) -> dict[str, Any]:
        """How many bars with ticks close, the newest one's date, and how many of them are of that date."""
        ticked = closing.where("feed = 'tick'").select("bar").distinct().withColumn("day", bar_date(F.col("bar")))
        by_day = ticked.groupBy("day").agg(F.count("*").alias("n"))
        found = by_day.agg(F.sum("n").alias("bars"), F.max("day").alias("day"), F.max_by("n", "day").alias("numbers")).first()
        return {"bars": found["bars"] or 0, "day": found["day"], "numbers": found["numbers"] or 0}

    def read(self, spark: SparkSession, product: str) -> DataFrame:
        """A product's rows with their bars."""
        from lodebar.operators.resume import with_bars

        return with_bars(spark.read.parquet(f"{self.path}/{product}"))

    def late(self, spark: SparkSession) -> DataFrame | None:
        """Rows that came after their bars had closed, null if there were none."""
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows-late")
        if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
            return None
        from lodebar.operators.resume import with_bars

        return with_bars(spark.read.parquet(f"{self.path}/rows-late").drop("batch"))
