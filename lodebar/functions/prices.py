"""Fixed-point prices: whole numbers with a decimal scale beside them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled(value: Column, decimal: Column) -> Column:
    """value / 10 ** decimal; scales of zero and below leave it as it is."""
    return value / F.pow(F.lit(10.0), F.greatest(decimal, F.lit(0)))


def price_or_null(value: Column, decimal: Column) -> Column:
    """A price of 0 means that there is none."""
    return F.when(value != 0, scaled(value, decimal))


def repaired_decimal(decimal: Column) -> Column:
    """Scales outside 0..6 count as 0."""
    return F.when(decimal.between(0, 6), decimal).otherwise(0)


def intraday_return(last: Column, previous: Column, decimal: Column) -> Column:
    """(last - previous close) / previous close; null without a previous close; -1 without a last price; never -0."""
    before = scaled(previous, decimal)
    return F.when(previous != 0, (scaled(last, decimal) - before) / before + F.lit(0.0))


def short_flag(flag: Column) -> Column:
    return F.when(flag == 1, "Y").when(flag == 0, "N")


def trade_flag(volume: Column, any_quantity: Column) -> Column:
    return F.when((volume > 0) | any_quantity, "Y").otherwise("N")


def number_text(raw: Column, decimal: Column) -> Column:
    """Shortest text of raw / 10 ** decimal with one digit after the point at least, from the exact decimal; never in E notation."""
    by_scale = F.when(F.greatest(decimal, F.lit(0)) == 0, raw.cast("string"))
    for d in range(1, 7):
        by_scale = by_scale.when(decimal == d, (raw.cast("decimal(30,0)") / F.lit(10**d).cast("decimal(8,0)")).cast(f"decimal(36,{d})").cast("string"))
    trimmed = F.regexp_replace(by_scale, r"(\.\d*?)0+$", "$1")
    return F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).when(~trimmed.contains("."), F.concat(trimmed, F.lit(".0"))).otherwise(trimmed)


def fixed_text(value: Column, decimal: Column) -> Column:
    """A value with exactly ``decimal`` digits after the point."""
    out = F.when(F.greatest(decimal, F.lit(0)) == 0, F.format_string("%.0f", value))
    for d in range(1, 7):
        out = out.when(decimal == d, F.format_string(f"%.{d}f", value))
    return out
