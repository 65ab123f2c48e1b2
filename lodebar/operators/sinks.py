"""Writing products by date and bar so that a rerun replaces what it wrote before."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodebar.functions.timebars import bar_key

_own: dict[str, str] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names; where that is unset and Spark runs in this process alone, in one of this machine's."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not (master := spark.sparkContext.master or "").startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = _own.setdefault(spark.sparkContext.applicationId, "")
        if not base:
            base = _own[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-work-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Columns that name a product's folders.
PARTS = ("year", "date", "hhmm")


def partitioned(rows: DataFrame) -> DataFrame:
    """``rows`` with year, date and hhmm of their bar, as folders are named; never null, as Spark sorts rows again by columns that may be."""
    key = F.coalesce(bar_key(F.col("bar")), F.lit(""))
    return rows.withColumn("year", key.substr(1, 4)).withColumn("date", key.substr(1, 8)).withColumn("hhmm", key.substr(9, 4))


def in_order(rows: DataFrame) -> DataFrame:
    """Each task's rows of ``partitioned`` in the order in which a product is written."""
    return rows.sortWithinPartitions(*PARTS, "symbol")


def bar_of_parts() -> Column:
    """The bar that a product's folders name, from the numbers in their names; null for anything that is no time."""
    date, at = F.col("date").try_cast("int"), F.col("hhmm").try_cast("int")
    tens = lambda c, below, n: (F.floor(c / below) % n).cast("int")
    return F.try_make_timestamp_ntz(tens(date, 10000, 10000), tens(date, 100, 100), date % 100, tens(at, 100, 100), at % 100, F.lit(0))


#: Shuffled stretches that one task spreads and sorts: they are tens of times larger in memory, and large sorts take longer by row.
TASK_BYTES = 8 << 20


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution deals out what is shuffled for a write by TASK_BYTES."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, f"{TASK_BYTES}b")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_product(rows: DataFrame, path: str, kind: str = "parquet") -> None:
    """Writes each bar's rows, sorted by symbol in each file, into its own partition; partitions that are written again are replaced.

    A bar has one file, unless it is so large that adaptive execution deals it to several tasks. Rows that have the columns of
    PARTS are clustered (``bars.spread``) and in order already.
    """
    clustered = set(PARTS) <= set(rows.columns)
    ready = rows if clustered else in_order(partitioned(rows).hint("rebalance", *PARTS))
    out = ready.drop("bar").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS)
    with small_tasks(rows.sparkSession) if clustered else nullcontext():
        if kind == "csv":
            out.option("header", True).option("nullValue", "NA").csv(path)
        else:
            out.parquet(path)


def append_late(rows: DataFrame, path: str, batch: int) -> None:
    """Adds a batch's late rows beside their bars; bars themselves are not revised, and a batch that runs again adds nothing."""
    ready = partitioned(rows).drop("bar").withColumn("batch", F.lit(batch))
    ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "date", "hhmm", "batch").parquet(f"{path}-late")


def read_product(spark: SparkSession, path: str) -> DataFrame:
    """A product's rows and the late ones added to it."""
    own = spark.read.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}-late")
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return own
    return own.unionByName(spark.read.parquet(f"{path}-late").drop("batch"))


def produced_bars(spark: SparkSession, path: str) -> DataFrame:
    """(bar) of the bars that a product on disk has: what a restart need not make again."""
    return spark.read.parquet(path).select("date", "hhmm").distinct().select(bar_of_parts().alias("bar"))


def latest_from(spark: SparkSession, path: str, until: str | None = None) -> DataFrame:
    """The last row of each symbol by time and arrival in a written snapshot product, up to the bar key ``until``."""
    rows = read_product(spark, path)
    if until is not None:
        rows = rows.where(F.concat(F.col("date").cast("string"), F.lpad(F.col("hhmm").cast("string"), 4, "0")) <= until)
    columns = [c for c in rows.columns if c not in ("symbol", "year", "date", "hhmm")]
    order = [c for c in ("ts", "rcvtime", "seqno") if c in columns]
    return rows.groupBy("symbol").agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r")).select("symbol", "r.*")


# The text products' columns in order.
SNAPSHOT_TEXT = (
    "seqno symbol name time preclose lastprice open high low close lasttradeprice lasttradeqty totalvol totalamount sessionid tradetype status direction pflag"
    " decimal vwap shortsellflag rcvtime update_flag"
).split()
ORDER_TEXT = "seqno symbol time bidprice bidsize askprice asksize decimal rcvtime".split()


def text_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with ``line``: the columns as one line of the text product, whole numbers as they came."""
    return rows.withColumn("line", F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
