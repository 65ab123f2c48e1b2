"""Bars per symbol, gap filling by carrying the last state forward, and the snapshot and kline products.

All of it is clustered by symbol: aggregation, the look back to the previous bar and the stretch of bars that a state
holds for share one exchange. Gaps are filled by giving every bar of a symbol the run of grid bars until its next one, so
there is no product of bars and symbols to begin with, and no state is ever taken from a later bar. What one day leaves
to the next is a parameter: prices are carried over midnight, volumes and quotes start anew unless asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodebar.functions.prices import scaled, trade_flag
from lodebar.functions.timebars import bar_date, bar_end
from lodebar.operators.sinks import PARTS, in_order, partitioned, staged

#: Grids up to so many bars are broadcast (a year of minutes has 525,600); longer ones are joined by a shuffle.
BROADCAST_BARS = 2_000_000

#: Neighbouring bars that are dealt to tasks together where rows are clustered by bar: a row that holds for all of them travels once.
BLOCK_BARS = 4


def with_bar(rows: DataFrame, unit: str) -> DataFrame:
    return rows.withColumn("bar", bar_end(F.col("ts"), unit))


def first_by(order: tuple[str, ...], *columns: str) -> Column:
    """The columns of the earliest row by ``order``; ties go to the first arrival, so ``order`` ends in seqno."""
    return F.min_by(F.struct(*columns), F.struct(*order))


def last_by(order: tuple[str, ...], *columns: str) -> Column:
    return F.max_by(F.struct(*columns), F.struct(*order))


def ohlcv(ticks: DataFrame, unit: str = "minute", first_seen: str = "self", carry_across_days: bool = False, seeds: DataFrame | None = None) -> DataFrame:
    """One row for each bar and symbol that has ticks: open, high, low, close by arrival, and differenced volumes.

    Volume and amount are what the cumulative ones have grown by since the symbol's previous bar of the same day (or of
    any day, with ``carry_across_days``), not below 0. A first bar has none to compare with: ``self`` gives it 0,
    ``start`` counts from its first tick, ``zero`` from 0. ``seeds`` (symbol, bar, r) are the last ticks of symbols in bars
    before all of these; they are compared with, but not shown.
    """
    if first_seen not in ("self", "start", "zero"):
        raise ValueError(f"unknown first_seen {first_seen!r}")
    price = scaled(F.col("lastprice"), F.col("decimal"))
    grouped = with_bar(ticks, unit).withColumn("price", price).groupBy("symbol", "bar").agg(
        F.min_by(F.struct("price", "totalvol", "totalamount"), "seqno").alias("head"),
        F.max_by(F.struct("price", "totalvol", "totalamount", "lastprice", "decimal"), "seqno").alias("tail"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.count("*").alias("count"),
        F.max("seqno").alias("seqno"),
        F.bool_or(F.col("lasttradeqty") > 0).alias("any_quantity"),
    )
    if seeds is not None:
        own_price = scaled(F.col("r.lastprice"), F.col("r.decimal")).alias("price")
        tail = F.struct(own_price, *[F.col(f"r.{c}") for c in ("totalvol", "totalamount", "lastprice", "decimal")])
        grouped = grouped.unionByName(seeds.select("symbol", "bar", tail.alias("tail")), allowMissingColumns=True)
    before = Window.partitionBy("symbol", *([] if carry_across_days else [bar_date(F.col("bar"))])).orderBy("bar")
    since = {"self": "tail", "start": "head"}.get(first_seen)

    def grown(column: str) -> Column:
        base = F.coalesce(F.lag(f"tail.{column}").over(before), F.col(f"{since}.{column}") if since else F.lit(0))
        return F.greatest(F.col(f"tail.{column}") - base, F.lit(0))

    amount = scaled(grown("totalamount"), F.col("tail.decimal"))
    out = grouped.select(
        "symbol", "bar", F.col("head.price").alias("open"), "high", "low", F.col("tail.price").alias("close"), grown("totalvol").alias("volume"),
        amount.alias("amount"), "count", "seqno", "any_quantity", F.col("tail.lastprice").alias("lastprice"), F.col("tail.decimal").alias("decimal"),
    )
    return out if seeds is None else out.where("count is not null")


def level(seeds: DataFrame, across_days: bool = True) -> DataFrame:
    """``seeds`` (symbol, bar, ...) as they stand at the newest of their bars: a bar is as old as the newest for all that hold until it.

    Without ``across_days`` only those of the newest bar's day still hold.
    """
    newest = F.lit(seeds.agg(F.max("bar")).first()[0]).cast("timestamp_ntz")
    held = seeds if across_days else seeds.where(bar_date(F.col("bar")) == bar_date(newest))
    return held.withColumn("bar", newest)


@dataclass(frozen=True)
class Grid:
    """(bar, at, day_end) of all distinct bars, counted in order from 0, and how many there are.

    day_end is the place of the next day's first bar.
    """

    rows: DataFrame
    count: int

    def small(self, bars: DataFrame) -> DataFrame:
        """A table of no more bars than the grid has, to be broadcast if these are BROADCAST_BARS at most."""
        return F.broadcast(bars) if self.count <= BROADCAST_BARS else bars


def grid(*bars: DataFrame) -> Grid:
    """The grid of all bars in ``bars``: as many rows as there are bars, whatever the symbols; written once, as it is read several times."""
    every = bars[0].select("bar")
    for b in bars[1:]:
        every = every.unionAll(b.select("bar"))
    placed = every.distinct().select("bar", (F.row_number().over(Window.orderBy("bar")) - 1).alias("at"))
    rows = staged(placed.withColumn("day_end", F.max("at").over(Window.partitionBy(bar_date(F.col("bar")))) + 1), "grid")
    return Grid(rows, rows.count())


def placed(states: DataFrame, bars: Grid, across_days: bool = True) -> DataFrame:
    """``states`` (symbol, bar, ...) with the places that each holds for instead of its bar: from ``since`` to before ``until``, where the symbol's next one is."""
    after = F.coalesce(F.lead("at").over(Window.partitionBy("symbol").orderBy("at")), F.lit(bars.count))
    end = after if across_days else F.least(after, "day_end")
    return states.join(bars.small(bars.rows), "bar").withColumn("until", end).withColumnRenamed("at", "since").drop("bar", "day_end")


def spread(stretches: DataFrame, bars: Grid, shown: DataFrame | None = None, by_bar: bool = False) -> DataFrame:
    """``stretches`` (since, until, ...) once for each place from since to before until, with ``at`` and its ``bar``.

    ``shown`` (bar, ...), each bar once, are the grid's bars that come out, all by default; its columns come along. With ``by_bar`` rows are dealt to tasks by blocks of bars and
    have the columns that name their partitions, made once for each bar; stretches travel, cut at the ends of blocks, and not the
    rows that they stand for. Their order is left to ``in_order``, after whatever makes rows narrower.
    """
    if by_bar:
        block = lambda at: F.floor(at / BLOCK_BARS).cast("int")
        cut = stretches.where("since < until").withColumn("block", F.explode(F.sequence(block(F.col("since")), block(F.col("until") - 1))))
        cut = cut.withColumn("since", F.greatest("since", F.col("block") * BLOCK_BARS)).withColumn("until", F.least("until", (F.col("block") + 1) * BLOCK_BARS))
        stretches = cut.hint("rebalance", "block").drop("block")
    rows = stretches.withColumn("at", F.explode(F.sequence(F.col("since"), F.col("until") - 1))).drop("since", "until")
    out = bars.rows.select("at", "bar")
    if by_bar:
        out = partitioned(out)
    if shown is not None:
        out = out.join(shown.withColumnRenamed("bar", "own"), F.col("bar").eqNullSafe(F.col("own"))).drop("own")
    return rows.join(bars.small(out), "at")


def carried(states: DataFrame, bars: Grid, across_days: bool = True, shown: DataFrame | None = None, by_bar: bool = False) -> DataFrame:
    """``states`` (symbol, bar, ...) for every grid bar from a symbol's first on: its own row, then that one until the next.

    ``held`` says whether a row is carried; ``bar`` is the grid's bar. Without ``across_days`` a row is carried to the end
    of its day. ``shown`` and ``by_bar`` are those of ``spread``.
    """
    stretches = placed(states, bars, across_days).withColumn("from", F.col("since"))
    return spread(stretches, bars, shown, by_bar).withColumn("held", F.col("at") > F.col("from")).drop("at", "from")


def kline(
    ticks: DataFrame, names: DataFrame, unit: str = "minute", first_seen: str = "self", full: bool = True, carry_across_days: bool = False, seeds: DataFrame | None = None, by_bar: bool = False
) -> DataFrame:
    """Bars with gaps filled by flat bars at the last price; without ``full`` only symbols with ticks in the bar.

    ``seeds`` (symbol, bar, r): last ticks in bars before all of these, to compare with and to carry. ``by_bar``: full ones come out
    as ``spread`` clusters them and in order, for ``write_product``.
    """
    own, shown = ohlcv(ticks, unit, first_seen, carry_across_days, seeds), with_bar(ticks, unit)
    every = [shown]
    if seeds is not None and full:
        held = level(seeds).select("symbol", "bar", F.col("r.seqno").alias("seqno"), F.col("r.lastprice").alias("lastprice"), F.col("r.decimal").alias("decimal"))
        own, every = own.unionByName(held, allowMissingColumns=True), [shown, held]
    own = named(own, names)
    filled = carried(own, grid(*every), True, None if seeds is None else shown.select("bar").distinct(), by_bar) if full else own.withColumn("held", F.lit(False))
    held, last = F.col("held"), scaled(F.col("lastprice"), F.col("decimal"))
    flat = lambda c: F.when(held, last).otherwise(F.col(c)).alias(c)
    none = lambda c: F.when(held, 0).otherwise(F.col(c)).alias(c)
    made = filled.select(
        "bar", "symbol", "name", "seqno", *[flat(c) for c in ("open", "high", "low", "close")], none("volume").cast("long").alias("volume"), none("amount").cast("double").alias("amount"),
        none("count").cast("long").alias("count"), F.when(held, "N").otherwise(trade_flag(F.col("volume"), F.col("any_quantity"))).alias("trade_flag"),
        F.when(held, "N").otherwise("Y").alias("update_flag"), *(PARTS if by_bar else ()),
    )
    return in_order(made) if by_bar else made


def named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` with the instrument's name, empty where there is none; the optimizer picks the join by the table's size."""
    return rows.join(names.select("symbol", "name"), "symbol", "left").withColumn("name", F.coalesce("name", F.lit("")))


def snapshot(ticks: DataFrame, names: DataFrame, unit: str = "minute", full: bool = True, seeds: DataFrame | None = None, by_bar: bool = False) -> DataFrame:
    """Every tick of a bar (flag Y) and, with ``full``, the last one before it of each symbol that has none (flag N).

    ``seeds`` (symbol, bar, r): last ticks in bars before all of these, to be carried.
    """
    return snapshot_of(with_bar(ticks, unit), names, full, None if seeds is None else level(seeds), by_bar)


def snapshot_of(rows: DataFrame, names: DataFrame, full: bool = True, seeds: DataFrame | None = None, by_bar: bool = False) -> DataFrame:
    """The same of rows that have their bar; ``seeds`` (symbol, bar, r) stand in whatever bar they are for, before or between.

    ``by_bar``: full ones come out as ``spread`` clusters them and in order, for ``write_product``.
    """
    flagged = rows.withColumn("update_flag", F.lit("Y"))
    if not full:
        return named(flagged, names)
    columns = [c for c in rows.columns if c not in ("symbol", "bar")]
    last = rows.groupBy("symbol", "bar").agg(last_by(("seqno",), *columns).alias("r"))
    if seeds is not None:
        last = last.unionByName(seeds.select("symbol", "bar", F.struct(*[F.col(f"r.{c}") for c in columns]).alias("r")))
    every, shown = grid(rows, *([] if seeds is None else [seeds])), None if seeds is None else rows.select("bar").distinct()
    after = placed(last, every).select("symbol", *[F.col(f"r.{c}") for c in columns], F.lit("N").alias("update_flag"), (F.col("since") + 1).alias("since"), "until").where("since < until")
    if not by_bar:
        return named(flagged, names).unionByName(spread(named(after, names), every, shown).drop("at"))
    at = every.small(every.rows.select("at", F.col("bar").alias("own")))
    own = flagged.join(at, F.col("bar").eqNullSafe(F.col("own"))).withColumn("since", F.col("at")).withColumn("until", F.col("at") + 1).drop("at", "bar", "own")
    return in_order(spread(named(own.unionByName(after), names), every, shown, True).drop("at"))


def latest(rows: DataFrame, *order: str) -> DataFrame:
    """The newest row of each symbol by ``order``, then arrival."""
    columns = [c for c in rows.columns if c != "symbol"]
    return rows.groupBy("symbol").agg(last_by((*order, "seqno"), *columns).alias("r")).select("symbol", "r.*")


def earliest_in_bar(rows: DataFrame, unit: str, *order: str) -> DataFrame:
    """The first row of each symbol and bar by ``order``, then arrival."""
    columns = [c for c in rows.columns if c != "symbol"]
    return with_bar(rows, unit).groupBy("symbol", "bar").agg(first_by((*order, "seqno"), *columns).alias("r")).select("symbol", "bar", "r.*")


def last_in_bar(rows: DataFrame, unit: str, *order: str) -> DataFrame:
    columns = [c for c in rows.columns if c != "symbol"]
    return with_bar(rows, unit).groupBy("symbol", "bar").agg(last_by((*order, "seqno"), *columns).alias("r")).select("symbol", "bar", "r.*")


def as_of(rows: DataFrame, unit: str, bars: Grid) -> DataFrame:
    """For every bar of the grid and symbol seen by then, the last row at or before the bar's end."""
    return carried(last_in_bar(rows, unit, "ts"), bars)
