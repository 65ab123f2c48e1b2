"""Personal data in whole texts: patterns propose spans, checksums confirm them, nearby words adjust their score.

Everything is SQL functions on one row: no Python, no shuffle. A kind's matches come from ``regexp_extract_all``, what lies
between them from ``split`` by the same pattern; running sums of both lengths give the places, in code points. Patterns are
written so that no text makes them slow or deep: repeated groups are possessive, and a start inside a stretch that has
failed is not tried again.

Base kinds (email, ip, card, phone) stay whatever their score; added kinds (iban, with mod-97, and ssn) need THRESHOLD.

Defined results: a null or empty text has no spans. Repeated rows come out alike. A column named like the output is replaced,
all others pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodebar.llm.common import without

#: Code points before and after a span in which words count as near.
NEAR = 40
THRESHOLD = 0.5
SPAN = "array<struct<kind: string, start: int, end: int, score: double>>"

_LOCAL = "[A-Za-z0-9._%+-]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` takes it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda s, x: s + x)


def running(steps: Column) -> Column:
    """Sums of all items before each; by blocks of about the square root of their number, so that long arrays stay cheap."""

    def summed(a: Column) -> Column:
        steps, k = a["steps"], a["k"]
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / k).cast("int")), lambda b: _sum(F.slice(steps, b * k + 1, k)))
        before = lambda sums, i: _sum(F.slice(sums, F.lit(1), F.floor(i / k).cast("int"))) + _sum(F.slice(steps, F.floor(i / k).cast("int") * k + 1, i % k))
        return bound(blocks, lambda sums: F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda i: before(sums, i)))

    return bound(F.struct(steps.alias("steps"), F.ceil(F.sqrt(F.size(steps))).cast("int").alias("k")), summed)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<match, start, before, after>> of a pattern's matches, null without any; start in code points from 0."""

    def placed(found: Column) -> Column:
        def at(x: Column) -> Column:
            m, gap, sums = x["m"], x["gap"], x["sums"]
            item = lambda i: F.struct(
                F.get(m, i).alias("match"), (F.length(F.get(gap, F.lit(0))) + F.get(sums, i)).alias("start"),
                F.right(F.get(gap, i), F.lit(NEAR)).alias("before"), F.left(F.get(gap, i + 1), F.lit(NEAR)).alias("after"),
            )
            return F.transform(F.sequence(F.lit(0), F.size(m) - 1), item)

        def summed(gap: Column) -> Column:
            steps = F.zip_with(found, F.slice(gap, F.lit(2), F.size(found)), lambda m, g: F.length(m) + F.length(g))
            return bound(F.struct(found.alias("m"), gap.alias("gap"), running(steps).alias("sums")), at)

        return F.when(F.size(found) > 0, bound(F.split(text, pattern, -1), summed))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes Luhn's check: every second digit from the right counts twice, less 9 above 9."""

    def add(total: Column, i: Column) -> Column:
        twice = (F.ascii(F.substring(digits, -i, F.lit(1))) - 48) * (2 - i % 2)
        return total + twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(number: Column) -> Column:
    """Whether an account number passes: its first four characters last, letters as 10 to 35, the rest by 97 is 1."""

    def add(rest: Column, i: Column) -> Column:
        value = F.instr(F.lit(_LETTERS), F.substring(number, (i + 3) % F.length(number) + 1, F.lit(1))) - 1
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) == 1


@dataclass(frozen=True)
class Kind:
    """What proposes a span, what a text must hold for it, what confirms it, its score, and the words that adjust that."""

    name: str
    pattern: str
    needs: str | None
    confirms: Callable[[Column], Column]
    score: float
    near: str
    against: str = ""
    base: bool = True


def _free(x: Column, edge: str) -> Column:
    return ~x["before"].rlike(f"{edge}$") & ~x["after"].rlike(f"^{edge}")


def _digits_between(x: Column, least: int, most: int) -> Column:
    return F.length(digits_of(x["match"])).between(least, most)


# The base kinds' patterns, in order. Starts inside a stretch of the same characters are left out, as they
# fail or succeed with it; \G lets a match begin where the one before ended.
KINDS = (
    Kind(
        "email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
        lambda x: F.lit(True), 0.8, "mail|contact|write to|schreib|correo|courriel",
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", None,
        lambda x: x["match"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), 0.6, r"\bip\b|host|server|address|adresse|direcci", "version|section|chapter",
    ),
    Kind(
        "card", r"[0-9](?:[\x20-]?[0-9])++", None,
        lambda x: _digits_between(x, 13, 19) & luhn(digits_of(x["match"])), 0.7, "card|visa|karte|tarjeta|carte|credit|payment", "order|isbn|serial",
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+",
        lambda x: _digits_between(x, 9, 15), 0.6, "phone|call|tel|mobil|fax|anruf|llama", "score|points",
    ),
    Kind(
        "iban", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)", None,
        lambda x: _free(x, "[A-Za-z0-9]") & mod97(F.replace(x["match"], F.lit(" "), F.lit(""))), 0.6, "iban|account|bank|konto|compte|cuenta", base=False,
    ),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "-",
        lambda x: _free(x, "[0-9-]") & ~x["match"].rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, r"\bssn\b|social security", "order|part no", base=False,
    ),
)
BASE = tuple(k.name for k in KINDS if k.base)


def _spans(text: Column, kind: Kind) -> Column:
    near = lambda x, words: F.lower(F.concat_ws(" ", x["before"], x["after"])).rlike(words) if words else F.lit(False)
    adjusted = lambda x: F.lit(kind.score) + F.when(near(x, kind.near), 0.3).otherwise(0.0) - F.when(near(x, kind.against), 0.3).otherwise(0.0)
    found = F.filter(matches(text, kind.pattern), kind.confirms)
    span = F.transform(found, lambda x: F.struct(F.lit(kind.name).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["match"])).alias("end"), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), adjusted(x))), 2).alias("score")))
    if not kind.base:
        span = F.filter(span, lambda s: s["score"] >= THRESHOLD)
    return F.when(text.contains(kind.needs), span) if kind.needs else span


def personal_data(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with pii: spans (kind, start, end, score), by kind as listed, then start; code points, end exclusive."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    found = F.concat(*[F.coalesce(_spans(text, k), F.array().cast(SPAN)) for k in KINDS])
    return without(docs.withColumn("__pii", found), "pii").withColumnRenamed("__pii", "pii")
