"""The wide product: one row for each symbol and bar with its first tick, its first quote and the instrument's limits.

A symbol without a tick (or quote) in a bar has the last one before; the two sides meet by symbol before either is carried, and
a symbol with only one of them has its row too. Bars are those with ticks; quotes of other bars are carried to the next, but
not over midnight unless asked for. Bars are numbered from 1 on each day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodebar.functions.prices import intraday_return, number_text, price_or_null, scaled, short_flag
from lodebar.functions.timebars import bar_date, local_time, update_time
from lodebar.operators.bars import Grid, first_by, grid, last_by, level, spread, with_bar
from lodebar.operators.instruments import with_limits
from lodebar.operators.sinks import PARTS, in_order, staged

# The product's columns in order. Those of the book's levels 2 to 10 and a few others are always empty.
COLUMNS = (
    "InstrumentID TradingDay LastPrice PreSettlementPrice PreClosePrice PreOpenInterest OpenPrice HighestPrice LowestPrice Volume Turnover OpenInterest"
    " ClosePrice SettlementPrice UpperLimitPrice LowerLimitPrice UpdateTime BidPrice1 BidVolume1 AskPrice1 AskVolume1"
).split() + [f"{side}{what}{level}" for level in range(2, 11) for side in ("Bid", "Ask") for what in ("Price", "Volume")] + (
    "ActionDay Type Seqno LocalTime IntraDailyReturn IsShortRestricted OpenAuctionVolume CloseAuctionVolume"
).split()
TYPE = "69"


def side(rows: DataFrame, unit: str, name: str, seeds: DataFrame | None = None) -> DataFrame:
    """(symbol, bar, first_name, last_name): first and last row in each bar by time, receipt and arrival.

    ``seeds`` (symbol, bar, r) are last rows in bars before all of these.
    """
    columns = [c for c in rows.columns if c != "symbol"]
    order = tuple(c for c in ("ts", "rcvtime", "seqno") if c in columns)
    own = with_bar(rows, unit).groupBy("symbol", "bar").agg(first_by(order, *columns).alias(f"first_{name}"), last_by(order, *columns).alias(f"last_{name}"))
    if seeds is None:
        return own
    return own.unionByName(seeds.select("symbol", "bar", F.struct(*[F.col(f"r.{c}") for c in columns]).alias(f"last_{name}")), allowMissingColumns=True)


def stretches(ticks: DataFrame, quotes: DataFrame, bars: Grid, across_days: bool) -> DataFrame:
    """(symbol, since, until, t, q): what each symbol has at the grid's places from since to before until, of both sides at once.

    A bar's own first rows hold for that bar, its last ones for those after it until the symbol's next; quotes until midnight
    only, without ``across_days``. All of it needs one exchange of the sides' rows, by symbol.
    """
    both = ticks.unionByName(quotes, allowMissingColumns=True).join(bars.small(bars.rows), "bar").drop("bar").repartition("symbol")
    kept = ("first_t", "last_t", "first_q", "last_q")
    met = both.groupBy("symbol", "at", "day_end").agg(*[F.first(c, ignorenulls=True).alias(c) for c in kept])
    order = Window.partitionBy("symbol").orderBy("at")
    days = order if across_days else Window.partitionBy("symbol", "day_end").orderBy("at")
    upto = lambda c, w, end: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, end))
    seen = met.withColumn("until", F.coalesce(F.lead("at").over(order), F.lit(bars.count)))
    for c, w in (("t", order), ("q", days)):
        seen = seen.withColumn(c, upto(f"last_{c}", w, 0)).withColumn(f"own_{c}", F.coalesce(f"first_{c}", upto(f"last_{c}", w, -1)))
    next_, midnight = F.col("at") + 1, F.col("until") if across_days else F.least("until", "day_end")
    piece = lambda since, until, t, q: F.struct(since.alias("since"), until.alias("until"), t.alias("t"), q.alias("q"))
    none = F.when(F.lit(False), F.col("q"))
    pieces = [piece(F.col("at"), next_, F.col("own_t"), F.col("own_q")), piece(next_, midnight, F.col("t"), F.col("q")), piece(midnight, F.col("until"), F.col("t"), none)]
    return seen.select("symbol", F.explode(F.array(*pieces)).alias("p")).select("symbol", "p.*").where("since < until and (t is not null or q is not null)")


def rows(
    ticks: DataFrame, quotes: DataFrame, instruments: DataFrame, unit: str = "minute", carry_quotes_across_days: bool = False,
    tick_seeds: DataFrame | None = None, quote_seeds: DataFrame | None = None, numbered: tuple[date, int] | None = None, by_bar: bool = False,
) -> DataFrame:
    """Typed columns under the product's names, and bar; nulls where the text product says NA.

    The seeds (symbol, bar, r) are last rows in bars before all of these, to be carried; ``numbered`` are a date and how many of
    its bars have numbers already. ``by_bar``: rows come out as ``bars.spread`` clusters them and in order, for ``write_product``.
    """
    tick_bars = with_bar(ticks, unit).select("bar").distinct()
    t_seeds = None if tick_seeds is None else level(tick_seeds)
    q_seeds = None if quote_seeds is None else level(quote_seeds, carry_quotes_across_days)
    every = grid(tick_bars, with_bar(quotes, unit), *[x for x in (t_seeds, q_seeds) if x is not None])
    number = F.row_number().over(Window.partitionBy(bar_date(F.col("bar"))).orderBy("bar"))
    if numbered is not None:
        number = number + F.when(bar_date(F.col("bar")) == F.lit(numbered[0]), numbered[1]).otherwise(0)
    seq = staged(tick_bars.select("bar", number.alias("seq")), "bars")
    held = stretches(side(ticks, unit, "t", t_seeds), side(quotes, unit, "q", q_seeds), every, carry_quotes_across_days)
    both = spread(with_limits(held, instruments), every, seq, by_bar)
    both = in_order(both) if by_bar else both  # here, as the product's rows are the wider ones
    d = F.col("t.decimal")
    price = lambda c: price_or_null(F.col(f"t.{c}"), d)
    at, ticked = F.coalesce("t.ts", "q.ts"), F.col("t").isNotNull()
    values: dict[str, Column] = {
        "InstrumentID": F.col("symbol"),
        "TradingDay": F.date_format(at, "yyyyMMdd"),
        "LastPrice": price("lastprice"),
        "PreClosePrice": price("preclose"),
        "OpenPrice": price("open"),
        "HighestPrice": price("high"),
        "LowestPrice": price("low"),
        "ClosePrice": price("close") if "close" in ticks.columns else F.lit(None).cast("double"),
        "Volume": F.col("t.totalvol"),
        "Turnover": scaled(F.col("t.totalamount"), d),
        "UpperLimitPrice": F.when(ticked, F.col("upper_limit")),
        "LowerLimitPrice": F.when(ticked, F.col("lower_limit")),
        "UpdateTime": update_time(F.col("bar")),
        "BidPrice1": price_or_null(F.col("q.bidprice"), F.col("q.decimal")),
        "BidVolume1": F.col("q.bidsize"),
        "AskPrice1": price_or_null(F.col("q.askprice"), F.col("q.decimal")),
        "AskVolume1": F.col("q.asksize"),
        "ActionDay": F.date_format(at, "yyyyMMdd"),
        "Type": F.lit(TYPE),
        "Seqno": F.col("seq").cast("long"),
        "LocalTime": local_time(at),
        "IntraDailyReturn": intraday_return(F.col("t.lastprice"), F.col("t.preclose"), d),
        "IsShortRestricted": short_flag(F.col("t.shortsellflag")),
    }
    return both.select("bar", *[values.get(c, F.lit(None).cast("string")).alias(c) for c in COLUMNS], *([*PARTS, "symbol"] if by_bar else []))


def as_text(wide: DataFrame) -> DataFrame:
    """The product as text: NA for nulls, numbers without exponents."""
    kinds = dict(wide.dtypes)

    def text(c: str) -> Column:
        if kinds[c] == "double":
            whole = F.round(F.col(c) * 1_000_000).cast("long")
            return F.coalesce(number_text(whole, F.lit(6)) if c != "IntraDailyReturn" else F.col(c).cast("string"), F.lit("NA"))
        return F.coalesce(F.col(c).cast("string"), F.lit("NA"))

    return wide.select("bar", *[text(c).alias(c) for c in COLUMNS])
