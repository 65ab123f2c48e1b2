"""Text feeds into products: lines are parsed once, numbered by arrival, bad ones put aside, and counts taken on the way.

Each batch leaves, in folders of its own below a path: ``rejected`` lines with what is wrong with them, and one row of
``metrics`` that Spark observes while the good rows are written. Arrival numbers of each feed go on from one batch to the
next, over restarts too, as what has been counted is kept with the products' control values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodebar.operators.control import arrival_numbers
from lodebar.operators.sinks import staged
from lodebar.sources import feeds
from lodebar.streaming.products import ProductWriter, both_feeds

LAYOUTS = {"tick": feeds.TICKS, "quote": feeds.QUOTES}
METRICS = "batch long, lines long, rejected long, ticks long, quotes long, negative_price long, negative_volume long, unknown_status long"


class TextIntake:
    """A micro-batch sink for lines (line, file, position, feed) of both feeds; good rows go to ``writer`` with their numbers.

    A batch that runs again gives its rows the same numbers: they come from the order of files and positions, after all that
    the control values before the batch have counted.
    """

    def __init__(self, path: str, writer: ProductWriter) -> None:
        self.path, self.writer = path, writer

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = ["file", "position"]
        side = {f: feeds.parsed(batch.where(F.col("feed") == f).select("line", *place), layout).persist() for f, layout in LAYOUTS.items()}
        bad = [rows.where("problem not in ('header', 'empty')").select("line", "problem", *place) for rows in side.values()]
        good = {f: feeds.accepted(rows).drop("line", "time") for f, rows in side.items()}
        count = lambda c: F.count(F.when(c, 1))
        tick = F.col("feed") == "tick"
        seen = Observation(f"intake-{batch_id}")
        watched = both_feeds(good["tick"], good["quote"]).observe(
            seen, count(tick).alias("ticks"), count(~tick).alias("quotes"), count(tick & (F.col("lastprice") < 0)).alias("negative_price"),
            count(tick & (F.col("totalvol") < 0)).alias("negative_volume"), count(tick & ~F.col("status").isin("T", "P")).alias("unknown_status"),
        )
        rows = staged(watched, "intake")
        before = self.writer.control(spark, batch_id)
        number = lambda f: arrival_numbers(rows.where(F.col("feed") == f), *place).withColumn("seqno", F.col("number") + F.lit(before[f"{f}s"])).drop("number", *place)
        self.writer(number("tick").unionByName(number("quote")), batch_id)
        rejected = bad[0].unionByName(bad[1])
        rejected.write.mode("overwrite").parquet(f"{self.path}/rejected/id={batch_id}")
        found = seen.get
        wrong = spark.read.parquet(f"{self.path}/rejected/id={batch_id}").count()
        lines = sum(part.count() for part in side.values())
        row = (batch_id, lines, wrong, *(found[c.split()[0]] for c in METRICS.split(", ")[3:]))
        spark.createDataFrame([row], METRICS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/metrics/id={batch_id}")
        for part in side.values():
            part.unpersist()

    def metrics(self, spark: SparkSession) -> DataFrame:
        """One row for each batch."""
        return spark.read.schema(METRICS).parquet(f"{self.path}/metrics").drop("id")

    def rejected(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rejected").drop("id")


def text_schemas(spark: SparkSession) -> dict:
    """Schemas of both feeds' rows as ``TextIntake`` hands them on."""
    empty = spark.createDataFrame([], "line string")
    return {
        f: feeds.accepted(feeds.parsed(empty, layout)).drop("line", "time").withColumn("seqno", F.lit(0).cast("long")).schema for f, layout in LAYOUTS.items()
    }
