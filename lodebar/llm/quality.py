"""Quality by importance resampling: how much likelier a text is under the target's words than under all text's.

Two generative models are fitted over words and word pairs hashed into BUCKETS: one of the target (documents labelled
good), one of every document. A document's log weight is the sum over its grams of the log ratio of the two. The sum of a
long text would drown any noise, so a text of n grams counts with LENGTH / (n + LENGTH) of it: short texts with nearly all,
long ones as LENGTH grams of their kind. A selection adds Gumbel noise, times a temperature, to these scaled weights and
takes the k largest: a sample without replacement in proportion to exp(scaled weight / temperature).

k is a stated share of the documents, or else follows from the labels: of all scaled weights that part the labelled documents
the one that errs least on good and bad ones (each class counting half) is taken, and k is the number of documents of
the whole table that reach it.

Defined results: null and empty texts have log weight 0 and take part in the selection. Labels other than 0 and 1 and
labels of unknown documents are not used; a document labelled both good and bad counts as bad. Without any good label
all weights are 0, and without labels of both kinds all documents stay. Documents with the very same key stand or fall
together. Rows with the same id get the same noise. Other columns pass through; those named like the outputs are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodebar.llm.common import frugal, returned, staged, without
from lodebar.llm.words import mix, sums_between, word_hashes

BUCKETS = 1 << 14
#: Grams of the standard text that long ones are scaled to.
LENGTH = 1000
_SHIFT = np.uint64(50)
_PAIR = np.uint64(0xD6E8FEB86659FD93)

#: Labelled documents that the target model and the bound are fitted on: all, or so many with the smallest hashes.
MAX_LABELLED = 100_000


def gram_buckets(hashes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, offsets) of the single words of texts, and of the pairs."""
    yield (hashes >> _SHIFT).astype(np.int64), offsets
    if len(hashes) < 2:
        return
    pair = (mix(hashes[:-1] * _PAIR + hashes[1:]) >> _SHIFT).astype(np.int64)
    inside = np.ones(len(pair), bool)
    inside[offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(hashes))] - 1] = False
    yield pair[inside], np.concatenate(([0], np.cumsum(inside)))[np.minimum(offsets, len(pair))]


def _sample(labels: DataFrame, limit: int) -> DataFrame:
    rows = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("good")).dropna()
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Gram counts (bucket, target, raw): ``raw`` over all documents, ``target`` over the labelled sample's good ones."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            good = np.array([x == 1 for x in batch.column(1).to_pylist()])
            for first, hashes, offsets in word_hashes(batch.column(0).to_pylist()):
                for bucket, at in gram_buckets(hashes, offsets):
                    total[1] += np.bincount(bucket, minlength=BUCKETS)
                    of_good = np.repeat(good[first : first + len(at) - 1], np.diff(at))
                    total[0] += np.bincount(bucket[of_good], minlength=BUCKETS)
        full = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(total[0][full]), pa.array(total[1][full])], names=["bucket", "target", "raw"])

    sample = F.broadcast(_sample(labels, max_labelled))
    rows = docs.select("doc_id", "text").join(sample, "doc_id", "left").select("text", "good")
    counts = rows.mapInArrow(lambda b: frugal(count(b)), "bucket int, target long, raw long")
    return counts.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Log of target over raw probability of each bucket; BUCKETS numbers."""
    found = counts.toPandas()
    table = np.zeros((2, BUCKETS))
    table[:, found["bucket"].to_numpy(int)] = found[["target", "raw"]].to_numpy(float).T
    if not table[0].sum():
        return np.zeros(BUCKETS)
    # the target's counts are smoothed by the raw model: grams that it has never seen lean on how common they are
    raw = (table[1] + 0.5) / (table[1] + 0.5).sum()
    target = (table[0] + 0.5 * BUCKETS * raw) / (table[0].sum() + 0.5 * BUCKETS)
    return np.log(target / raw)


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``docs`` with log_weight and n_grams."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    @F.pandas_udf("log_weight double, n_grams long")
    def score(texts: pd.Series) -> pd.DataFrame:
        weight, grams = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for first, hashes, offsets in word_hashes(texts.tolist()):
            for bucket, at in gram_buckets(hashes, offsets):
                weight[first : first + len(at) - 1] += sums_between(shared.value[bucket], at)
                grams[first : first + len(at) - 1] += np.diff(at)
        returned()
        return pd.DataFrame({"log_weight": weight, "n_grams": grams})

    scored = docs.withColumn("__w", score("text"))
    return without(scored, "log_weight", "n_grams").select("*", "__w.*").drop("__w")


def best_bound(good: np.ndarray, weight: np.ndarray) -> float:
    """The weight from which on documents stay: it errs least on good and bad ones, each class counting half."""
    if good.all() or not good.any():
        return -math.inf
    order = np.argsort(weight, kind="stable")
    w, g = weight[order], good[order]
    lost = np.concatenate(([0], np.cumsum(g))) / g.sum()  # with the bound before the i-th weight: good ones below
    passed = 1 - np.concatenate(([0], np.cumsum(~g))) / (~g).sum()  # bad ones not below
    error = lost + passed
    between = np.concatenate(([True], w[1:] > w[:-1], [True]))
    at = int(np.flatnonzero(between)[error[between].argmin()])
    if at == 0:
        return -math.inf
    return float(w[-1] + 1) if at == len(w) else float((w[at - 1] + w[at]) / 2)


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column without nulls; counts of 4096 ranges at a time come to the driver, never rows."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return math.inf
    while low < high:
        step = (high - low) / 4096
        if not low + step > low:
            break
        place = F.least(F.lit(4095), F.floor((F.col(column) - low) / step)).alias("place")
        inside = rows.where((F.col(column) >= low) & (F.col(column) <= high))
        ranges = inside.groupBy(place).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for r in sorted(ranges, key=lambda r: -r["place"]):
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
        else:
            return low
    return low if low == high else rows.where((F.col(column) >= low) & (F.col(column) <= high)).agg(F.min(column)).first()[0]


def noise(id_col: str, temperature: float, seed: int) -> Column:
    """Gumbel noise times the temperature, from a hash of the id; 0 where the temperature is."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.lit(-temperature) * F.log(-F.log(uniform))


def scaled_weight() -> Column:
    """The log weight as that of a text of standard length."""
    return F.col("log_weight") * F.lit(float(LENGTH)) / (F.col("n_grams") + F.lit(LENGTH))


def weighed_ids(docs: DataFrame, labels: DataFrame, temperature: float = 1.0, seed: int = 7, keep_share: float | None = None, max_labelled: int = MAX_LABELLED) -> tuple[DataFrame, np.ndarray, float]:
    """(doc_id, log_weight, n_grams, key) of every document, the log ratios, and the key from which on documents are kept."""
    ratios = log_ratios(fit(docs, labels, max_labelled))
    weighed = weigh(docs.select("doc_id", "text"), ratios).select("doc_id", "log_weight", "n_grams")
    small = staged(weighed.withColumn("key", scaled_weight() + noise("doc_id", temperature, seed)), "quality")
    if keep_share is not None:
        k = round(keep_share * small.count())
    else:
        labelled = small.join(F.broadcast(_sample(labels, max_labelled)), "doc_id").groupBy("doc_id").agg(F.first("good").alias("good"), F.max(scaled_weight()).alias("w")).toPandas()
        k = small.where(scaled_weight() >= F.lit(best_bound(labelled["good"].to_numpy() == 1, labelled["w"].to_numpy(float)))).count()
    return small, ratios, kth_largest(small, "key", k)


def resample(docs: DataFrame, labels: DataFrame, temperature: float = 1.0, seed: int = 7, keep_share: float | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``docs`` with log_weight, n_grams, key and keep; every column of ``docs`` stays, and nothing is shuffled for it."""
    _, ratios, least = weighed_ids(docs, labels, temperature, seed, keep_share, max_labelled)
    keyed = without(weigh(docs, ratios), "key", "keep").withColumn("key", scaled_weight() + noise("doc_id", temperature, seed))
    return keyed.withColumn("keep", F.col("key") >= F.lit(least))
