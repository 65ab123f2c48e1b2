"""Runs of words that repeat with a period, found exactly in whole texts, and texts with the repetitions taken out.

A run is a stretch of words with smallest period q, at least ``least`` words and ``times`` * q long, that no neighbour
extends. A run's words come back after q words for at least ``max(least, times * q) - q`` of them; the smallest such overlap
over all q is k. So every word of a run lies in a k-gram that its document holds twice or more; words outside such k-grams are
masked, and what is left falls into segments that no run leaves. Main and Lorentz's divide and conquer then works on the
segments alone, all halves of one depth at a time: a run that crosses the middle of a stretch holds a square that begins or
ends there, and from that square it is extended word by word to both sides. Fingerprints only propose squares and k-grams;
every run comes from comparing words.

Defined results: a null text has no words; a text without runs is its words joined by one space. Repeated rows come out
alike. Columns named like the operator's outputs are replaced, all others pass through.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodebar.llm.common import returned, without
from lodebar.llm.words import mix

OUTPUTS = ("n_words", "runs", "collapsed")
RUN = "struct<start: long, length: long, period: long>"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def least_overlap(least: int, times: int) -> int:
    """The fewest words of a run that come back a period later."""
    if least < 1 or times < 4:
        raise ValueError("a run has four periods at least, so that two of them lie on one side of any place in it")
    return min(max(least, times * q) - q for q in range(1, least + 1))


def _segments(values: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the stretches of at least ``least`` words that k-grams cover which occur twice or more."""
    count = len(values) - k + 1
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if count < 2:
        return none
    grams = np.zeros(count, np.uint64)
    for j in range(k):
        grams = (grams + values[j : j + count]) * _BASE
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return none
    again = np.zeros(count, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(values) + 1, np.int64)
    edge[:count] += again
    edge[k : k + count] -= again
    covered = np.cumsum(edge[:-1]) > 0
    change = np.diff(covered.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    low, high = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    long = high - low >= least
    return low[long], high[long]


def _same_until(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading items two equally long arrays share, looked at in growing pieces."""
    at, step = 0, 32
    while at < len(a):
        differs = a[at : at + step] != b[at : at + step]
        if differs.any():
            return at + int(differs.argmax())
        at, step = at + step, step * 4
    return len(a)


def _extended(ids: np.ndarray, at: int, p: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in [low, high) in which words ``p`` apart are identical: [start, end)."""
    end = at + p + _same_until(ids[at + p : high], ids[at : high - p])
    return at - _same_until(ids[low:at][::-1], ids[low + p : at + p][::-1]), end


def find_runs(ids: np.ndarray, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, by start, then period."""
    values = mix(ids.astype(np.uint64) + np.uint64(1))
    least = max(least, times)
    low, high = _segments(values, least_overlap(least, times), least)
    if not len(low):
        return []
    power = np.full(len(ids) + 1, _BASE, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    total = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(values * power[:-1], out=total[1:])
    found: dict[tuple[int, int], int] = {}

    def squares(at: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Whether the ``p`` words from ``at`` on come twice."""
        return (total[at + p] - total[at]) * power[p] == total[at + 2 * p] - total[at + p]

    def extend(low: int, middle: int, high: int, periods: np.ndarray, left: bool) -> None:
        while len(periods):
            p = int(periods[0])
            # a word further on either side tells a run that leaves this part: it crosses an earlier middle and is known
            start, end = _extended(ids, middle - p if left else middle, p, max(low - 1, 0), min(high + 1, len(ids)))
            if low <= start and end <= high and end - start >= max(least, times * p):
                found[start, end] = min(found.get((start, end), p), p)
            # a square of several such periods inside this stretch extends no further than it
            inside = (periods % p == 0) & (middle - 2 * periods >= start if left else middle + 2 * periods <= end)
            inside[0] = True
            periods = periods[~inside]

    while len(low):
        middle, most = (low + high) // 2, (high - low) // times
        node = np.repeat(np.arange(len(low)), most)
        p = np.arange(len(node)) - np.repeat(np.cumsum(most) - most, most) + 1
        m = middle[node]
        for left, room in ((False, m + 2 * p <= high[node]), (True, m - 2 * p >= low[node])):
            at, own, of = (m - 2 * p if left else m)[room], p[room], node[room]
            hit = squares(at, own)
            own, of = own[hit], of[hit]
            cut = np.flatnonzero(np.diff(of)) + 1
            for periods, n in zip(np.split(own, cut), of[np.concatenate(([0], cut))] if len(of) else (), strict=False):
                extend(int(low[n]), int(middle[n]), int(high[n]), periods, left)
        low, high = np.concatenate((low, middle)), np.concatenate((middle, high))
        large = high - low >= least
        low, high = low[large], high[large]
    return sorted((s, e - s, p) for (s, e), p in found.items())


def _worked(texts: pa.Array, least: int, times: int) -> pa.Array:
    counts, offsets, runs, collapsed = [], [0], [], []
    for text in texts:
        words = (text.as_py() or "").encode().split()
        own: list[tuple[int, int, int]] = []
        if len(words) >= least:
            column = np.empty(len(words), object)
            column[:] = words
            own = find_runs(pd.factorize(column)[0], least, times)
        counts.append(len(words))
        runs += own
        offsets.append(len(runs))
        if own:
            keep = np.ones(len(words), bool)
            for start, length, period in own:
                keep[start + period : start + length] = False
            words = list(compress(words, keep.tolist()))
        collapsed.append(b" ".join(words).decode())
    fields = [pa.array(c, pa.int64()) for c in zip(*runs, strict=True)] if runs else [pa.array([], pa.int64())] * 3
    listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    returned()
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), listed, pa.array(collapsed, pa.string())], list(OUTPUTS))


def collapse_runs(docs: DataFrame, least: int = 6, times: int = 4, text_column: str = "text") -> DataFrame:
    """``docs`` with n_words, runs (by start, then period; word numbers from 0) and collapsed.

    collapsed: the words that no run holds after its first period, joined by one space.
    """

    @F.arrow_udf(f"n_words long, runs array<{RUN}>, collapsed string")
    def worked(texts: pa.Array) -> pa.Array:
        return _worked(texts, least, times)

    own = docs.withColumn("__out", worked(F.col(f"`{text_column}`")))
    return without(own, *OUTPUTS).select("*", "__out.*").drop("__out")
