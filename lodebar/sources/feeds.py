"""The three text feeds as DataFrames: ticks (snapshot), quotes (order) and instruments (code).

Lines are comma-separated without quoting, with a fixed order of columns and optional ones at the end. Headers and rows
that don't fit are put aside, not lost: ``rejected`` tells why. Arrival order is the file and the byte position in it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodebar.functions.prices import repaired_decimal
from lodebar.functions.timebars import parse_digits


@dataclass(frozen=True)
class Layout:
    """Columns (name, type, default; None if required) of a feed and how many of them a row must have."""

    name: str
    columns: tuple[tuple[str, str, str | int | None], ...]
    least: int
    blank_takes_default: bool = False


# The feeds' column orders, types and defaults.
TICKS = Layout(
    "snapshot",
    (
        ("symbol", "string", None), ("time", "long", None), ("preclose", "long", None), ("lastprice", "long", None), ("open", "long", None),
        ("high", "long", None), ("low", "long", None), ("close", "long", None), ("lasttradeprice", "long", None), ("lasttradeqty", "long", None),
        ("totalvol", "long", None), ("totalamount", "long", None), ("sessionid", "long", None), ("tradetype", "string", ""), ("status", "string", "T"),
        ("direction", "long", 0), ("pflag", "string", "N"), ("decimal", "long", 2), ("vwap", "long", 0), ("shortsellflag", "long", 0), ("rcvtime", "long", 0),
    ),
    17,
)
QUOTES = Layout(
    "order",
    (
        ("symbol", "string", None), ("time", "long", None), ("bidprice", "long", None), ("bidsize", "long", None), ("askprice", "long", None),
        ("asksize", "long", None), ("decimal", "long", 2), ("rcvtime", "long", 0),
    ),
    6,
)
INSTRUMENTS = Layout(
    "code",
    (
        ("symbol", "string", None), ("market", "long", 0), ("marketdesc", "string", ""), ("name", "string", ""), ("money", "string", ""), ("type", "string", ""),
        ("subtype", "string", ""), ("issueclass", "string", ""), ("industrycode", "string", ""), ("isincode", "string", ""), ("lotsize", "long", 0),
        ("limitup", "long", 0), ("limitdown", "long", 0), ("decimal", "long", 2), ("rcvtime", "long", 0), ("businessday", "string", ""), ("baseprice", "long", 0),
    ),
    7,
    blank_takes_default=True,
)


def _typed(layout: Layout, parts: Column) -> list[Column]:
    out = []
    for i, (name, kind, default) in enumerate(layout.columns):
        value = F.get(parts, F.lit(i))
        if layout.blank_takes_default and kind == "long":
            value = F.nullif(F.trim(value), F.lit(""))
        if default is not None:
            value = F.coalesce(value, F.lit(str(default)))
        value = F.trim(value) if kind == "string" else F.trim(value).try_cast("long")
        out.append(value.alias(name))
    return out


def parsed(rows: DataFrame, layout: Layout) -> DataFrame:
    """``rows`` (line, ...) with the layout's columns and ``problem``: null for rows that are good."""
    line = F.col("line")
    field = lambda i: F.trim(F.substring_index(F.substring_index(line, ",", i + 1), ",", -1))
    # all of it looks at the line only: conditions over every typed column would multiply in the optimizer's inferences
    problem = (
        F.when(F.trim(line) == "", "empty")
        .when(line.startswith("symbol,"), "header")
        .when(~F.size(F.split(line, ",")).between(layout.least, len(layout.columns)), "number of columns")
        .when(field(0) == "", "no symbol")
        .when(~line.rlike(pattern(layout)), "not a number")
    )
    if layout.columns[1][0] == "time":
        problem = problem.when(~field(1).rlike(r"^\d{17}$"), "time")
    split = rows.select("*", problem.alias("problem"), F.split(line, ",").alias("__parts"))
    return split.select(*rows.columns, *_typed(layout, F.col("__parts")), "problem")


def pattern(layout: Layout) -> str:
    """A regular expression for lines whose numbers are numbers of up to 18 digits."""
    out = ""
    for i, (_, kind, _) in reversed(list(enumerate(layout.columns))):
        own = "[^,]*" if kind == "string" else r"\s*[+-]?\d{1,18}\s*"
        if kind == "long" and layout.blank_takes_default:
            own = rf"(?:{own}|\s*)"
        own = ("," if i else "") + own + out
        out = own if i < layout.least else f"(?:{own})?"
    return f"^{out}$"


def accepted(rows: DataFrame) -> DataFrame:
    """Good rows, with scales repaired and the instant of ``time`` as ``ts``."""
    good = rows.where("problem is null").drop("problem")
    if "decimal" in good.columns:
        good = good.withColumn("decimal", repaired_decimal(F.col("decimal")).cast("int"))
    return good.withColumn("ts", parse_digits(F.col("time"))) if "time" in good.columns else good


def rejected(rows: DataFrame) -> DataFrame:
    """Rows put aside and why; headers and empty lines are no loss and left out."""
    return rows.where("problem not in ('header', 'empty')").select("line", "problem")


def warnings(ticks: DataFrame) -> DataFrame:
    """Counts of values that are kept but look wrong."""
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return ticks.agg(
        F.count("*").alias("rows"),
        count(F.col("lastprice") < 0).alias("negative_price"),
        count(F.col("totalvol") < 0).alias("negative_volume"),
        count(~F.col("status").isin("T", "P")).alias("unknown_status"),
    )
