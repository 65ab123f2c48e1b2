"""Ticks, quotes and instruments from the event and customer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _events(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("event_type").isin(*kinds))
    price = F.round(F.col("value") * 100).cast("long")
    return rows.select(F.col("event_id").alias("seqno"), F.col("user_id").cast("string").alias("symbol"), "ts", "event_type", price.alias("lastprice"))


def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases, sign-ups and errors as ticks, without what runs over a symbol's day."""
    rows = _events(spark, sf_dir, "purchase", "signup", "error")
    quantity = F.when(F.col("event_type") == "purchase", 1 + F.col("seqno") % 10).otherwise(0)
    return rows.select(
        "seqno", "symbol", "ts", "lastprice", F.lit(2).alias("decimal"), quantity.cast("long").alias("lasttradeqty"),
        (F.col("seqno") % 3).cast("int").alias("shortsellflag"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with cumulative volume and amount, running extremes and the price before, by arrival in each symbol."""
    so_far = Window.partitionBy("symbol").orderBy("seqno").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("symbol").orderBy("seqno")
    return raw_ticks(spark, sf_dir).select(
        "*",
        F.sum("lasttradeqty").over(so_far).alias("totalvol"),
        F.sum(F.col("lasttradeqty") * F.col("lastprice")).over(so_far).alias("totalamount"),
        F.first("lastprice").over(so_far).alias("open"),
        F.max("lastprice").over(so_far).alias("high"),
        F.min("lastprice").over(so_far).alias("low"),
        F.coalesce(F.lag("lastprice").over(before), F.lit(0)).alias("preclose"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and views as best bid and ask."""
    price, n = F.col("lastprice"), F.col("seqno")
    return _events(spark, sf_dir, "click", "view").select(
        "seqno", "symbol", "ts", (price - 5).alias("bidprice"), (n % 100).alias("bidsize"), (price + 5).alias("askprice"), ((n + 50) % 100).alias("asksize"), F.lit(2).alias("decimal")
    )


def instrument_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows for each customer: full ones, then ones whose limits and scale are 0 for every other customer."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    limit = F.greatest(F.round(F.col("c_acctbal") * 100).cast("long"), F.lit(0))
    row = c.select(F.col("c_custkey").cast("string").alias("symbol"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("market"), limit.alias("limitup"), F.col("c_custkey").alias("key"))
    first = row.select("symbol", "name", "market", "limitup", F.floor(F.col("limitup") / 2).alias("limitdown"), F.lit(2).alias("decimal"), (F.col("key") * 2).alias("seqno"))
    odd = F.col("key") % 2
    second = row.select("symbol", F.concat("name", F.lit("*")).alias("name"), "market", (F.col("limitup") * odd).alias("limitup"), F.lit(0).cast("long").alias("limitdown"), (2 * odd).cast("int").alias("decimal"), (F.col("key") * 2 + 1).alias("seqno"))
    return first.unionAll(second)
