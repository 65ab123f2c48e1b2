"""The instrument master: merging its rows, and looking names and limits up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodebar.functions.prices import scaled

#: Columns in which 0 is no news and keeps what was there before.
STICKY = ("limitup", "limitdown", "decimal")


def merged(rows: DataFrame) -> DataFrame:
    """One row a symbol: the last one's values, but in STICKY columns the last that isn't 0 (0 if none is)."""
    plain = [c for c in rows.columns if c not in ("symbol", *STICKY)]
    sticky = [F.coalesce(F.max_by(c, F.when(F.col(c) != 0, F.col("seqno"))), F.lit(0)).alias(c) for c in STICKY]
    return rows.groupBy("symbol").agg(F.max_by(F.struct(*plain), "seqno").alias("r"), *sticky).select("symbol", "r.*", *STICKY)


def as_state(rows: DataFrame) -> DataFrame:
    """``rows`` in a form that can be folded: values with the arrival that they stand for; 0 in STICKY columns stands for none."""
    plain = [c for c in rows.columns if c not in ("symbol", *STICKY)]
    sticky = [F.struct(F.col(c).cast("long").alias("value"), F.when(F.col(c) != 0, F.col("seqno")).alias("at")).alias(c) for c in STICKY]
    return rows.select("symbol", "seqno", F.struct(*plain).alias("r"), *sticky)


def folded(*states: DataFrame) -> DataFrame:
    """One state a symbol from states that were folded or not, whatever their order: what ``merged`` needs of all their rows."""
    every = states[0]
    for more in states[1:]:
        every = every.unionByName(more)
    sticky = [F.max_by(c, f"{c}.at").alias(c) for c in STICKY]
    return every.groupBy("symbol").agg(F.max("seqno").alias("seqno"), F.max_by("r", "seqno").alias("r"), *sticky)


def of_state(state: DataFrame) -> DataFrame:
    """The merged rows that a folded state stands for."""
    return state.select("symbol", "r.*", *[F.coalesce(f"{c}.value", F.lit(0)).alias(c) for c in STICKY])


def with_limits(rows: DataFrame, instruments: DataFrame) -> DataFrame:
    """``rows`` with upper_limit and lower_limit, by the instrument's own scale; null where there is none."""
    limit = lambda c: F.when(F.col(c) != 0, scaled(F.col(c), F.col("__decimal")))
    own = instruments.select("symbol", F.col("limitup").alias("__up"), F.col("limitdown").alias("__down"), F.col("decimal").alias("__decimal"))
    return rows.join(own, "symbol", "left").withColumn("upper_limit", limit("__up")).withColumn("lower_limit", limit("__down")).drop("__up", "__down", "__decimal")
