"""Main text of pages by equivalence-class template deduction (after Arasu and Garcia-Molina, 2003).

Tokens are elements with all elements around them (name, class and id words), and constant texts: a block's whole text at
its place. A token's occurrence vector says how often it occurs in each page of its host. Tokens with the same vector
make up an equivalence class; it is valid if it has two tokens or more and occurs in MIN_SUPPORT of the host's pages. The
valid classes, nested as their elements are, are the host's template. What stands between its tokens are slots: a block
belongs to the slot of the innermost template element around it, and elements that only some pages have are data.

Vectors are never built: every page sends a hash of itself and the count for each of its tokens, and these are added up,
before and after the shuffle, so a host with a third of all pages is no hot group. A host's template has at
most (tokens of a page) / MIN_SUPPORT tokens; it is broadcast up to BROADCAST_HOSTS hosts and joined beyond.

Constant texts of the template are in no slot, wherever they stand. Of the slots that a page fills, names only choose the
rank: its text is that of slots in ``article``, ``main`` or what is named like them; without any, of articles inside of what
a class calls noise; then of slots without a name; then of template elements that a class calls noise or that are in a
form. The last rank needs a template and a page without any main element. A page of a host with fewer than MIN_PAGES pages
goes by names alone; one with a main element whose texts are all constant, and with no other slot filled, too. Menus, footers, asides,
scripts, styles, hidden parts and reader comments are in no slot, by the meaning of their elements.

Texts that stand in links only are no main text by their names: an ``article`` of links is a teaser.

A text is constant if it is in a valid class, in MIN_PAGES pages and in MIN_SUPPORT of the host's, or MAIN_SUPPORT where
names call it main, so that a few copies of one article do not make it a template.

Blocks: character references decoded, white space turned into one space (``br`` too), trimmed, joined by a line feed.

Defined results: null and empty html give an empty text. Pages without a host share the empty host. A page alone on its
host is its own template. Unclosed and misnested elements end with what encloses them; unfinished comments and scripts
take the rest of the page. Repeated rows get the same text. Other columns pass through; those named like the outputs are
replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodebar.llm.common import frugal, returned, staged, without
from lodebar.llm.html_text import MAIN, NEUTRAL, REGAINED, Block, Element, hashed, read
from lodebar.llm.url_filter import split_url

#: Share of a host's pages that a token must be in.
MIN_SUPPORT = 0.3
#: Pages that a constant text must be in.
MIN_PAGES = 3
#: Share of a host's pages that a text in a main element must be in to be constant.
MAIN_SUPPORT = 0.6
BROADCAST_HOSTS = 200_000

_PAGE, _TAG, _TEXT = 0, 1, 2


def tokens(pages: DataFrame) -> DataFrame:
    """(host, kind, token, label, n, page): every token of every page, with its count and a hash of the page and it."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for host, key, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blocks, counts = read(page)
                out.append((host, _PAGE, 0, NEUTRAL, 1, hash((key, 1))))
                out += [(host, _TAG, path, label, n, hash((key, n))) for path, (label, n) in counts.items()]
                constant = Counter((hashed(b.element.path, b.text), b.element.label) for b in blocks)
                out += [(host, _TEXT, t, label, n, hash((key, n))) for (t, label), n in constant.items()]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["host", "kind", "token", "label", "n", "page"])

    key = F.xxhash64("page_id", "url", F.octet_length("html"))
    return pages.select(split_url("url")[0].alias("host"), key.alias("key"), "html").mapInArrow(lambda b: frugal(work(b)), "host string, kind int, token long, label int, n long, page long")


def vector(page: str) -> Column:
    """A token's occurrence vector: the sum over pages, so that pages that occur twice do not cancel out."""
    return F.sum(F.col(page).cast("decimal(20,0)"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, tags, constants) of every host: the tokens of its valid classes."""
    vectors = tokens(pages).groupBy("host", "kind", "token").agg(
        F.max("label").alias("label"), F.count("*").alias("pages"), F.sum("n").alias("total"), vector("page").alias("vector")
    )
    vectors = staged(vectors.where((F.col("kind") != _TEXT) | (F.col("pages") >= MIN_PAGES)), "html-vectors")
    hosts = vectors.where(F.col("kind") == _PAGE).select("host", F.col("pages").alias("host_pages"))
    named = (F.col("kind") == _TEXT) & F.col("label").isin(MAIN, REGAINED)
    support = F.when(named, MAIN_SUPPORT).otherwise(MIN_SUPPORT)
    common = vectors.where(F.col("kind") != _PAGE).join(hosts, "host").where(F.col("pages") >= F.col("host_pages") * support)
    same = ["host", "vector", "pages", "total"]
    valid = common.groupBy(*same).agg(F.count("*").alias("size")).where("size >= 2").select(*same)
    members = common.join(valid, same, "left_semi")
    tag = F.when(F.col("kind") == _TAG, F.col("token"))
    text = F.when(F.col("kind") == _TEXT, F.col("token"))
    lists = members.groupBy("host", "host_pages").agg(F.collect_list(tag).alias("tags"), F.collect_list(text).alias("constants"))
    return staged(lists, "html-templates")


def slots_of(blocks: list[Block], tags: set[int]) -> list[int]:
    """Each block's slot: the path of the innermost template element around it, 0 if there is none."""
    known: dict[Element, int] = {}
    out = []
    for b in blocks:
        chain, e = [], b.element
        while e is not None and e not in known and e.path not in tags:
            chain.append(e)
            e = e.parent
        slot = 0 if e is None else known.get(e, e.path)
        known.update(dict.fromkeys(chain, slot))
        out.append(slot)
    return out


def main_text(page: str | None, tags: set[int], constants: set[int], pages: int = 1) -> tuple[str, int]:
    """The text of a page's main slots, and how many slots it comes from; ``pages``: of its host."""
    blocks, counts = read(page)
    filled = [b for b in blocks if hashed(b.element.path, b.text) not in constants] if constants else blocks
    ranked = {rank: [b for b in filled if b.element.label == rank] for rank in (MAIN, REGAINED, NEUTRAL)}
    chosen = next((c for c in ranked.values() if not all(b.linked for b in c)), []) or next((c for c in ranked.values() if c), [])
    if not chosen and pages >= MIN_PAGES:
        chosen = [b for b in blocks if b.element.label == MAIN]
        if not any(label in (MAIN, REGAINED) for label, _ in counts.values()):
            chosen = [b for b, slot in zip(filled, slots_of(filled, tags), strict=True) if slot and slot == b.element.path]
    return "\n".join(b.text for b in chosen), len(set(slots_of(chosen, tags)))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html, ...) with text, n_chars (code points) and n_slots."""
    template = templates(pages)
    if template.count() <= BROADCAST_HOSTS:
        template = F.broadcast(template)
    template = template.select(F.col("host").alias("__host"), F.col("tags").alias("__tags"), F.col("constants").alias("__constants"), F.col("host_pages").alias("__pages"))
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_slots", T.IntegerType())])

    @F.pandas_udf(kind)
    def of(page: pd.Series, tags: pd.Series, constants: pd.Series, pages: pd.Series) -> pd.DataFrame:
        rows = []
        for h, t, c, n in zip(page, tags, constants, pages, strict=True):
            text, slots = main_text(h, set() if t is None else set(t), set() if c is None else set(c), n)
            rows.append((text, len(text), slots))
        returned()
        return pd.DataFrame(rows, columns=kind.names)

    joined = pages.withColumn("__host", split_url("url")[0]).join(template, "__host", "left")
    done = joined.withColumn("__out", of("html", "__tags", "__constants", F.coalesce("__pages", F.lit(1))))
    return without(done, *kind.names, "__host", "__tags", "__constants", "__pages").select("*", "__out.*").drop("__out")
