"""Language identification by mixtures of languages.

Each learned language is a smoothed distribution over hashed byte trigrams of lower-cased text. A document is taken as a
mixture: expectation-maximisation over its trigrams estimates every language's share. Sets of the largest shares are
then compared, each refitted, by likelihood less a penalty for each further language; the best set's shares stand.

Any number of languages can be learned. The model has BUCKETS numbers of 4 bytes for each, which is what is broadcast: the
number of languages bounds it, never that of documents. It is put together a language at a time, and workers take languages
in slices and texts in runs, so that no more than CELLS probabilities are unfolded at once.

Defined results: null text and text without a letter give ``und``, score 0 and no shares; so does everything when
nothing could be learned. Equal shares go to the language that sorts first. Repeated rows are predicted alike. Other
columns pass through; those named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodebar.llm.common import frugal, returned, staged, without

BUCKETS = 1 << 14
#: Probabilities of trigrams under languages that a worker has at hand at a time (8 bytes each, in a few copies).
CELLS = 1 << 20
#: Texts are counted together up to so many, and so many characters.
GROUP, GROUP_CHARS = 64, 1 << 20

SHARES = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())]))

#: ASCII other than letters is a space.
_LETTER = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def _buckets(raw: bytes) -> np.ndarray:
    """Buckets of the trigrams of a text, without those of spaces only."""
    b = _LETTER[np.frombuffer(b" " + raw + b" ", np.uint8)]
    if len(b) < 3:
        return np.zeros(0, np.int64)
    gram = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    gram = gram[gram != 0x202020]
    return ((gram * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int64)


def _counted(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, offsets, bucket, count) of runs of texts: sparse rows of trigram counts."""
    first, group, size = 0, [], 0
    for i in range(len(texts) + 1):
        if group and (i == len(texts) or len(group) == GROUP or size > GROUP_CHARS):
            cells = np.concatenate([g + k * BUCKETS for k, g in enumerate(group)])
            count = np.bincount(cells, minlength=len(group) * BUCKETS)
            full = np.flatnonzero(count)
            yield first, np.searchsorted(full, np.arange(len(group) + 1) * BUCKETS), full % BUCKETS, count[full].astype(float)
            first, group, size = i, [], 0
        if i < len(texts):
            group.append(_buckets(texts[i].lower().encode()))
            size += len(group[-1])


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Trigram counts (lang, bucket, n) over every document with text and language."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            frame = batch.to_pandas()
            for lang, own in frame.groupby("lang"):
                sums = total.setdefault(str(lang), np.zeros(BUCKETS, np.int64))
                for text in own["text"]:
                    sums += np.bincount(_buckets(text.lower().encode()), minlength=BUCKETS)
        for lang, sums in total.items():
            full = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(sums[full], pa.int64())], names=["lang", "bucket", "n"])

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()
    return rows.mapInArrow(lambda b: frugal(count(b)), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _em(share: np.ndarray, p: np.ndarray, doc: np.ndarray, at: np.ndarray, count: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the columns of ``p`` after ``rounds`` of expectation and maximisation, and the log-likelihood under them."""
    for _ in range(rounds):
        part = share[doc] * p
        part *= (count / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, at)
        share /= share.sum(axis=1, keepdims=True)
    return share, np.add.reduceat(count * np.log((share[doc] * p).sum(axis=1)), at)


class Mixture:
    """Languages' trigram probabilities, and the mixture that fits a text best."""

    def __init__(self, langs: list[str], p: np.ndarray, rounds: int = 10, penalty: float = 3.0) -> None:
        """p: a row for each bucket. penalty: times log(trigrams) for each language after the first."""
        self.langs, self.p, self.rounds, self.penalty = langs, p, rounds, penalty

    def _unfolded(self, bucket: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """Probabilities of the buckets, by slices of languages."""
        step = max(1, CELLS // max(1, len(bucket)))
        for i in range(0, len(self.langs), step):
            yield slice(i, i + step), self.p[bucket, i : i + step].astype(float)

    def _all(self, doc: np.ndarray, at: np.ndarray, bucket: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each text's log-likelihood under every single language, and its shares of all languages after expectation-maximisation."""
        k = len(self.langs)
        if len(bucket) * k <= CELLS:
            p = self.p[bucket].astype(float)
            return np.add.reduceat(count[:, None] * np.log(p), at), _em(np.full((len(at), k), 1.0 / k), p, doc, at, count, self.rounds)[0]
        single, share = np.zeros((len(at), k)), np.full((len(at), k), 1.0 / k)
        for s, p in self._unfolded(bucket):
            single[:, s] = np.add.reduceat(count[:, None] * np.log(p), at)
        for _ in range(self.rounds):
            total = np.zeros(len(bucket))
            for s, p in self._unfolded(bucket):
                total += (share[:, s][doc] * p).sum(axis=1)
            weight = (count / total)[:, None]
            for s, p in self._unfolded(bucket):
                share[:, s] = np.add.reduceat(share[:, s][doc] * p * weight, at)
            share /= share.sum(axis=1, keepdims=True)
        return single, share

    def shares(self, offsets: np.ndarray, bucket: np.ndarray, count: np.ndarray) -> list[list[tuple[int, float]]]:
        """(language, share) of each text's chosen set, the largest share first; none for texts without trigrams."""
        n, k = len(offsets) - 1, len(self.langs)
        out: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        some = np.flatnonzero(np.diff(offsets))
        if not len(some) or not k:
            return out
        lens, at = np.diff(offsets)[some], offsets[:-1][some]
        doc = np.repeat(np.arange(len(some)), lens)
        single, full = self._all(doc, at, bucket, count)
        cost = self.penalty * np.log(np.add.reduceat(count, at))
        value, first = single.max(axis=1), single.argmax(axis=1)
        for i, lang in zip(some.tolist(), first.tolist(), strict=True):
            out[i] = [(lang, 1.0)]
        rank = np.argsort(-full, axis=1, kind="stable")
        going = np.arange(len(some))
        for size in range(2, k + 1):  # the largest shares, one more each time; texts stop when one more doesn't pay
            going = going[full[going, rank[going, size - 1]] > 0.01]
            better = []
            for run in self._runs(going, lens * size):
                rows = np.concatenate([np.arange(at[t], at[t] + lens[t]) for t in run])
                own, top = np.repeat(np.arange(len(run)), lens[run]), rank[run, :size]
                start = np.take_along_axis(full[run], top, 1)
                p = self.p[bucket[rows][:, None], top[own]].astype(float)
                share, fit = _em(start / start.sum(axis=1, keepdims=True), p, own, np.cumsum(lens[run]) - lens[run], count[rows], self.rounds // 2)
                for j in np.flatnonzero(fit - (size - 1) * cost[run] > value[run]).tolist():
                    better.append(run[j])
                    value[run[j]] = fit[j] - (size - 1) * cost[run[j]]
                    order = sorted(range(size), key=lambda c: (-share[j, c], top[j, c]))  # noqa: B023
                    out[some[run[j]]] = [(int(top[j, c]), float(share[j, c])) for c in order]
            going = np.array(better, np.int64)
            if not len(going):
                break
        return out

    @staticmethod
    def _runs(texts: np.ndarray, cells: np.ndarray) -> Iterator[np.ndarray]:
        """Runs of texts with CELLS cells or so."""
        cut = np.flatnonzero(np.diff(np.cumsum(cells[texts]) // CELLS)) + 1
        yield from (r for r in np.split(texts, cut) if len(r))


def collected(model: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and each bucket's probability under every one, from ``learn``'s counts; a language comes to the driver at a time."""
    langs = sorted(r[0] for r in model.select("lang").distinct().collect())
    p = np.zeros((BUCKETS, len(langs)), np.float32)
    number = {lang: i for i, lang in enumerate(langs)}
    for r in model.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("c")).select("lang", "c.bucket", "c.n").toLocalIterator():
        counts = np.zeros(BUCKETS)
        counts[r["bucket"]] = r["n"]
        p[:, number[r["lang"]]] = (counts + 0.5) / (counts.sum() + 0.5 * BUCKETS)
    return langs, p


def predict(docs: DataFrame, model: DataFrame, text_col: str = "text", penalty: float = 3.0) -> DataFrame:
    """``docs`` with lang_pred, score (the predicted language's share) and shares (the chosen languages, largest first)."""
    langs, p = collected(staged(model, "langid"))
    mixture = docs.sparkSession.sparkContext.broadcast(Mixture(langs, p, penalty=penalty))
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("shares", SHARES)])

    @F.pandas_udf(kind)
    def guess(texts: pd.Series, lettered: pd.Series) -> pd.DataFrame:
        m = mixture.value
        whole = [t if ok and t else "" for t, ok in zip(texts, lettered, strict=True)]
        rows: list[tuple] = []
        for _, offsets, bucket, count in _counted(whole):
            for chosen in m.shares(offsets, bucket, count):
                shares = [{"lang": m.langs[i], "share": s} for i, s in chosen if s > 0]
                rows.append((shares[0]["lang"], min(1.0, shares[0]["share"]), shares) if shares else ("und", 0.0, []))
        returned()
        return pd.DataFrame(rows, columns=["lang_pred", "score", "shares"])

    lettered = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    judged = docs.withColumn("__judged", guess(F.col(f"`{text_col}`"), lettered))
    return without(judged, *kind.names).select("*", "__judged.*").drop("__judged")
