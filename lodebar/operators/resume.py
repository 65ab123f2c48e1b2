"""Going on from a written product: only bars that it lacks are made, each from the bar before it that it has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodebar.functions.timebars import bar_date
from lodebar.operators import bars, sinks


def with_bars(product: DataFrame) -> DataFrame:
    """Rows of a written product with the bar that their partition names."""
    return product.withColumn("bar", sinks.bar_of_parts()).drop(*sinks.PARTS)


def last_date(spark: SparkSession, path: str):  # noqa: ANN201
    """The date of the newest bar that a product has, from its partitions alone; files of earlier dates need not be read again."""
    return sinks.produced_bars(spark, path).agg(F.max(bar_date(F.col("bar")))).first()[0]


def seeds_before(spark: SparkSession, path: str, missing: DataFrame, columns: list[str]) -> DataFrame:
    """(symbol, bar, r): for each stretch of missing bars, every symbol's last row in the produced bar before it.

    A full product has a row for each symbol in each bar, so one partition holds all that a stretch needs to begin with.
    """
    every = sinks.produced_bars(spark, path).select("bar", F.lit(True).alias("made")).unionByName(missing.select("bar", F.lit(False).alias("made")))
    order = Window.orderBy("bar").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as bars
    before = every.withColumn("from", F.last(F.when(F.col("made"), F.col("bar")), ignorenulls=True).over(order))
    needed = before.where("not made and from is not null").select(F.col("from").alias("bar")).distinct()
    part = F.date_format("bar", "yyyyMMdd").cast("int"), F.date_format("bar", "HHmm").cast("int")
    keys = needed.select("bar", part[0].alias("date"), part[1].alias("hhmm"))
    rows = spark.read.parquet(path).join(F.broadcast(keys) if keys.count() <= bars.BROADCAST_BARS else keys, ["date", "hhmm"])
    return rows.groupBy("symbol", "bar").agg(bars.last_by(("seqno",), *[c for c in columns if c != "symbol"]).alias("r"))


def missing_snapshot(ticks: DataFrame, names: DataFrame, path: str, unit: str = "minute", by_bar: bool = False) -> DataFrame:
    """Snapshot rows of those bars of ``ticks`` that the product at ``path`` lacks, as a build of everything would give them.

    ``ticks`` need only hold the dates of missing bars; what was before comes from the product.
    """
    spark = ticks.sparkSession
    rows = bars.with_bar(ticks, unit)
    own = rows.join(sinks.produced_bars(spark, path), "bar", "left_anti").select(*ticks.columns, "bar")
    seeds = seeds_before(spark, path, own.select("bar").distinct(), ticks.columns)
    return bars.snapshot_of(own, names, True, seeds, by_bar)


def resume(ticks: DataFrame, names: DataFrame, path: str, unit: str = "minute") -> None:
    """Adds the missing bars to the product; those that it has are left alone, and running it again adds nothing."""
    sinks.write_product(missing_snapshot(ticks, names, path, unit, by_bar=True), path)
