"""Control and audit: late rows, committed bars, sequence checks, set comparisons and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodebar.operators.sinks import staged

#: Tasks over which a busy bar's late rows are dealt, and arrivals of a key that one task looks through.
SALTS, STRETCH = 32, 1 << 20


def late_split(rows: DataFrame, flushed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(on time, late): rows of bars that have been emitted already are late."""
    done = flushed.select("bar").distinct()
    return rows.join(done, "bar", "left_anti"), rows.join(done, "bar", "left_semi")


def capped(late: DataFrame, cap: int) -> DataFrame:
    """The first ``cap`` late rows of each bar by arrival, and how many there were: that limit is a feature of the feed.

    A busy bar's rows are dealt over SALTS tasks first, each of which keeps its own first ones.
    """
    place = lambda *keys: F.row_number().over(Window.partitionBy("bar", *keys).orderBy("seqno"))
    salt = F.pmod(F.xxhash64("seqno"), F.lit(SALTS))
    own = late.withColumn("place", place(salt)).where(F.col("place") <= cap).withColumn("place", place())
    return own.where(F.col("place") <= cap).join(late.groupBy("bar").agg(F.count("*").alias("of")), "bar")


def late_statistics(late: DataFrame) -> DataFrame:
    return late.agg(F.count("*").alias("late_rows"), F.countDistinct("bar").alias("late_bars"))


def three_way(ticks: DataFrame, quotes: DataFrame, committed: DataFrame) -> DataFrame:
    """(bar, status): bars of the product against bars of ticks and quotes together."""
    mark = lambda df, c: df.select("bar", F.lit(True).alias(c)).distinct()
    every = mark(ticks, "t").join(mark(quotes, "q"), "bar", "full_outer").join(mark(committed, "c"), "bar", "full_outer")
    inside = F.coalesce("t", "q").isNotNull()
    return every.select("bar", F.when(inside & F.col("c"), "complete").when(inside, "missing").otherwise("extra").alias("status"))


def most_before(rows: DataFrame, column: str, key: str, order: str, stretch: Column, name: str) -> DataFrame:
    """``rows`` with the largest ``column`` of all rows of the same key that come before by ``order``, null for the first.

    ``stretch`` grows with ``order``: a busy key is worked on stretch by stretch, in tasks of their own, and what the
    stretches before have reached is found from one row for each.
    """
    cut = rows.withColumn("__stretch", stretch)
    so_far = Window.partitionBy(key).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    reached = cut.groupBy(key, "__stretch").agg(F.max(column).alias("__most")).withColumn("__most", F.max("__most").over(so_far))
    inside = F.max(column).over(Window.partitionBy(key, "__stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return cut.withColumn(name, inside).join(reached, [key, "__stretch"]).withColumn(name, F.greatest(name, "__most")).drop("__stretch", "__most")


def by_arrival(order: str = "seqno") -> Column:
    """Stretches of STRETCH arrivals."""
    return F.floor(F.col(order) / F.lit(STRETCH))


def running_watermark(rows: DataFrame) -> DataFrame:
    """Per symbol and arrival, the newest bar seen so far (``watermark``) and whether the row came behind it."""
    seen = most_before(rows, "bar", "symbol", "seqno", by_arrival(), "watermark")
    return seen.withColumn("watermark", F.greatest("watermark", "bar")).withColumn("behind", F.col("bar") < F.col("watermark"))


def bar_numbers(bars: DataFrame) -> DataFrame:
    """(date, bar, number): bars counted from 1 on each date."""
    day = bars.select("bar").distinct().withColumn("date", F.to_date("bar"))
    return day.select("date", "bar", F.row_number().over(Window.partitionBy("date").orderBy("bar")).alias("number"))


def arrival_numbers(rows: DataFrame, *order: str) -> DataFrame:
    """Dense arrival numbers from 1, without bringing all rows to one task.

    Rows are range-partitioned by arrival; each partition counts its own, and starts after all before it. The first pass
    is written so that both passes see the same ranges.
    """
    ranged = staged(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "arrival")
    sizes = ranged.groupBy("__part").count()
    starts = sizes.select("__part", (F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("count")).alias("__start"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.join(F.broadcast(starts), "__part").withColumn("number", own + F.col("__start")).drop("__part", "__start")


def increasing(rows: DataFrame, column: str, key: str, order: str, stretch: Column) -> DataFrame:
    """Rows whose ``column`` is larger than all before it of the same key; ``stretch`` as in ``most_before``."""
    return most_before(rows, column, key, order, stretch, "__before").where(F.col("__before").isNull() | (F.col(column) > F.col("__before"))).drop("__before")


def not_increasing(rows: DataFrame, column: str, key: str, order: str, stretch: Column) -> DataFrame:
    """Rows whose ``column`` isn't larger than that of the row before of the same key; ``stretch`` as in ``most_before``.

    A stretch's first row is compared with the last one of the key's stretch before.
    """
    cut = rows.withColumn("__stretch", stretch)
    ends = cut.groupBy(key, "__stretch").agg(F.max_by(column, order).alias("__end"))
    ends = ends.withColumn("__end", F.lag("__end").over(Window.partitionBy(key).orderBy("__stretch")))
    last = F.lag(column).over(Window.partitionBy(key, "__stretch").orderBy(order))
    seen = cut.withColumn("before", last).join(ends, [key, "__stretch"]).withColumn("before", F.coalesce("before", "__end")).drop("__stretch", "__end")
    return seen.where(F.col(column) <= F.col("before"))


def counts_compared(source: DataFrame, output: DataFrame) -> DataFrame:
    """(bar, source_rows, output_rows, difference) of each bar."""
    a = source.groupBy("bar").agg(F.count("*").alias("source_rows"))
    b = output.groupBy("bar").agg(F.count("*").alias("output_rows"))
    both = a.join(b, "bar", "full_outer").na.fill(0, ["source_rows", "output_rows"])
    return both.withColumn("difference", F.col("source_rows") - F.col("output_rows"))


def summary(ticks: DataFrame, quotes: DataFrame, late: DataFrame) -> DataFrame:
    """One row: bars, first and last bar, rows and symbols of both feeds, late rows."""
    of = lambda df, p: df.agg(F.countDistinct("bar").alias(f"{p}_bars"), F.min("bar").alias(f"{p}_first"), F.max("bar").alias(f"{p}_last"), F.count("*").alias(f"{p}_rows"), F.countDistinct("symbol").alias(f"{p}_symbols"))
    one = lambda df: df.withColumn("__one", F.lit(1))
    return one(of(ticks, "tick")).join(one(of(quotes, "quote")), "__one").join(one(late_statistics(late)), "__one").drop("__one")


def newest(rows: DataFrame, key: str, order: str, keep: int) -> DataFrame:
    """The newest ``keep`` rows of each key."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where(F.col("place") <= keep)


def oldest_bars(rows: DataFrame, limit: int) -> DataFrame:
    """The oldest ``limit`` distinct bars, to be emitted first when too many are pending."""
    return rows.select("bar").distinct().orderBy("bar").limit(limit)
