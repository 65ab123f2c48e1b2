"""Connected components of a table of links, by alternating star contractions (Kiveris et al., 2014).

Every round joins each node's neighbours to the smallest of them, first the larger ones, then the smaller ones; the
number of rounds grows with the logarithm of the longest chain. Before the first, each task unites its own links. Links
and labels stay distributed; only sums of a round come to the driver. Hot nodes are split: a node's smallest neighbour is
found by an aggregation that combines before it shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodebar.llm.common import dropped, frugal, staged

#: Links that a task unites before the rounds, at a time.
HELD = 1 << 19



def united(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``root`` (the lowest node known to be linked with each node) after linking nodes ``p`` with nodes ``q``."""
    while True:
        u, v = root[p], root[q]
        apart = u != v
        if not apart.any():
            return root
        p, q, u, v = p[apart], q[apart], u[apart], v[apart]
        root = root.copy()
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root[root] != root).any():
            root = root[root]


def _forests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each run of HELD or so: every node with the lowest that they tie it to, so fewer links than nodes."""
    held: list[pa.RecordBatch] = []

    def made() -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in (0, 1))
        nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
        root = united(np.arange(len(nodes)), ends[: len(a)], ends[len(a) :])
        below = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[below], pa.int64()), pa.array(nodes[root[below]], pa.int64())], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= HELD:
            yield made()
            held = []
    if held:
        yield made()


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours and it itself linked to the smallest among all of them."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = both.unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if larger:
        return joined.where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def _summed(links: DataFrame) -> tuple:
    """Numbers by which two sets of links are told apart; unlike sets agree with a probability of about 2**-64."""
    h = F.xxhash64("a", "b")
    return tuple(links.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftrightunsigned(h, 32))).first())


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) of every node in ``links`` (a, b: numbers): root is the smallest node that links reach.

    Links in either direction, repeated links, and links of a node with itself are fine; such a node alone has no row. Null
    ends are dropped; no links give no rows.
    """
    ends = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).dropna().where("a <> b")
    current = staged(ends.mapInArrow(lambda b: frugal(_forests(b)), "a long, b long").distinct(), label)
    seen = _summed(current)
    while seen[0]:
        after = staged(_star(_star(current, True), False), label)
        dropped(current)
        current, before, seen = after, seen, _summed(after)
        if seen == before:
            break
    named = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return named.unionAll(roots)
