"""Benchmark decontamination: BM25 over test items, block-max WAND, verified overlap of question and answer.

Test items are indexed: every term has postings in item order, in blocks with the largest impact of each. A training text
is cut into overlapping passages at least twice as long as the longest item, so that each place is whole in one of them.
Every passage is a query. An item has two entries, its question and its whole text. An entry needs ``threshold`` of its
BM25 score for its own text, or less where a passage that verification accepts can have less: a term's weight is spread
over the n-grams it is in, so the lightest n-grams that make up what verification asks for bound the score of any such
passage from below. Retrieval so loses nothing that verification would accept. An impact is a term's weight over what its
entry needs, and all entries that a passage's terms lift to 1 are retrieved, however many:

* entries lie in blocks of SPAN neighbours, the same for all posting lists, and a list keeps its largest impact of each block;
* WAND's condition in its block-max form (Ding and Suel, 2011) is put to all blocks and many passages at once: a passage whose
  lists' largest impacts do not sum to 1 has no pivot and is done; of the others only blocks whose maxima sum to 1 stay live
  (as in Dimopoulos, Nepomnyachiy and Suel, 2013);
* in live blocks the postings are added up, and entries that reach 1 are retrieved.

A retrieved item is then verified: the shares of the n-grams of its question, of those that reach into the answer (the
last line; of a single line the last sentence) and of all. A text is contaminated when a passage holds ``least`` of an
item's question or of the whole item, or ``least`` of the answer together with half of that of the question: an answer
alone is no leak, with a reworded question it is one.

Document frequencies, the number of items and their mean length are those of all items. The index is built in parts of
PART_BYTES or so of items, one task each, and the texts are read once for as many parts as TOGETHER bytes of index hold:
parts change neither scores nor verdicts, and a task builds one part and searches those of one broadcast. Words are runs of letters and digits, A-Z lower-cased.

Defined results: null and empty texts are clean. Null and wordless items are never found; one of fewer than n words is
found where all its words stand in order; a question of fewer than n words is only looked at with its answer. Of items with
the same id every text counts, and the one with the largest share is reported. Repeated rows are judged alike: verdicts
are by text (texts are told apart by 96 bits of hashes). Texts' other columns pass through; those named like the outputs
are replaced.
"""

from __future__ import annotations

import itertools
import math
import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodebar.llm.common import dropped, frugal, staged, without
from lodebar.llm.words import mix, word_hashes

K1, B = 1.2, 0.75
#: Entries to a block, and what is looked at together: postings of blocks, and blocks by passages.
SPAN, WORK = 4, 1 << 18
#: Bytes of items in one part of the index: about 350,000 words, and 700,000 postings at most.
PART_BYTES = 2 << 20
#: Bytes of index that are broadcast together, one part at least; a part has 30 MB or so.
TOGETHER = 96 << 20
#: Contaminated texts that are broadcast to their rows; more are joined by a shuffle.
BROADCAST_TEXTS = 200_000

_STEP = np.uint64(0xE7037ED1A0B428DB)

def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a text, by first word; of a shorter text, one for all of it."""
    n = min(n, len(hashes))
    if not n:
        return hashes
    out = np.full(len(hashes) - n + 1, np.uint64(n))
    for i in range(n):
        out = mix(out * _STEP + hashes[i : len(hashes) - n + 1 + i])
    return out


def question_words(text: str) -> int:
    """Characters of an item before its answer: the last line, or of one line the last sentence, else its last quarter."""
    lines = text.rstrip()
    at = lines.rfind("\n")
    if at < 0:
        ends = [m.end() for m in re.finditer(r"[.?!]\s", lines)]
        at = ends[-1] if ends else -1
    return at if at > 0 else len(lines) * 3 // 4


def _least_score(terms: np.ndarray, weights: dict[int, float], n: int, needed: int) -> float:
    """A lower bound of the score of any passage that has ``needed`` of the distinct n-grams of ``terms``.

    Each term's weight is dealt out evenly to the distinct n-grams that it is in. Those that a passage has are dealt no more
    than the weights of their terms, all of which the passage has, and no less than as many of the lightest.
    """
    n = min(n, len(terms))
    inside = [set(g) for g in {tuple(terms[i : i + n].tolist()) for i in range(len(terms) - n + 1)}]
    shared = Counter(t for g in inside for t in g)
    dealt = sorted(sum(weights[t] / shared[t] for t in g) for g in inside)
    return sum(dealt[: max(1, needed)]) * (1 - 1e-9)


def _asked(share: float, of: np.ndarray) -> int:
    return math.ceil(share * len(of) - 1e-9)


def item_words(text: str) -> tuple[np.ndarray, int]:
    """Hashes of an item's words, and how many of them are its question's."""
    ((_, words, at),) = word_hashes([text[: question_words(text)], text], letters=True)
    return words[at[1] :], int(at[1])


class Statistics:
    """What BM25 knows of all items: how many there are, their mean length, the longest, and the items of each term."""

    def __init__(self, items: int, words: int, longest: int, terms: np.ndarray, found: np.ndarray) -> None:
        self.items, self.mean, self.longest = items, words / max(1, items), max(1, longest)
        order = np.argsort(terms)
        self.terms, self.found = terms[order], found[order]

    @classmethod
    def of(cls, items: list[tuple[int, str]]) -> Statistics:
        words = [w for w in (item_words(t)[0] for _, t in items) if len(w)]
        terms, found = np.unique(np.concatenate([np.unique(w) for w in words]) if words else np.zeros(0, np.uint64), return_counts=True)
        return cls(len(words), sum(map(len, words)), max(map(len, words), default=1), terms, found)

    def weights(self, terms: np.ndarray) -> np.ndarray:
        f = self.found[np.searchsorted(self.terms, terms)]
        return np.log(1 + (self.items - f + 0.5) / (f + 0.5))


class Index:
    """Postings of the entries of test items, their questions and whole texts, with block maxima; all in flat arrays."""

    def __init__(self, items: list[tuple[int, str]], n: int = 5, threshold: float = 0.45, least: float = 0.6, statistics: Statistics | None = None) -> None:
        known = statistics or Statistics.of(items)
        kept = [(item_id, *item_words(text)) for item_id, text in items]
        kept = [k for k in kept if len(k[1])]
        self.n, self.least, self.longest = n, least, known.longest
        self.ids = [k[0] for k in kept]
        self.vocabulary = np.unique(np.concatenate([k[1] for k in kept])) if kept else np.zeros(0, np.uint64)
        self.question, self.answer, self.whole, self.size = [], [], [], []
        for _, words, q in kept:
            g = grams(words, n)
            inside = max(0, min(len(g), q - n + 1))
            self.question.append(np.unique(g[:inside]))
            self.answer.append(np.unique(g[inside:]))
            self.whole.append(np.unique(g))
            self.size.append(min(n, len(words)))
        idf = known.weights(self.vocabulary)
        self.entries: list[int] = []  # the item of each
        self.shares: list[tuple[np.ndarray, np.ndarray]] = []  # each item's terms, and their weights over its own score
        term, entry, impact = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for item, (_, words, q) in enumerate(kept):
            numbers = np.searchsorted(self.vocabulary, words)
            own, tf = np.unique(numbers, return_counts=True)
            w = idf[own] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / known.mean))
            weights = dict(zip(own.tolist(), w.tolist(), strict=True))
            self.shares.append((self.vocabulary[own], w / w.sum()))
            asked = _asked(least, self.whole[item])
            if len(self.question[item]) and len(self.answer[item]):
                asked = min(asked, _asked(least, self.answer[item]) + _asked(least / 2, self.question[item]))
            parts = [(numbers, asked)]
            if len(self.question[item]) and q < len(words):
                parts.append((numbers[:q], _asked(least, self.question[item])))
            for part, asked in parts:
                mine = np.unique(part)
                score = w[np.searchsorted(own, mine)]
                needed = min(threshold * score.sum(), _least_score(part, weights, n, asked))
                term.append(mine)
                entry.append(np.full(len(mine), len(self.entries)))
                impact.append(score / needed)
                self.entries.append(item)
        terms, entries, impacts = np.concatenate(term), np.concatenate(entry), np.concatenate(impact)
        order = np.lexsort((entries, terms))
        self.entry_of, self.impact_of = entries[order].astype(np.int32), impacts[order]
        self.at = np.searchsorted(terms[order], np.arange(len(self.vocabulary) + 1))
        # a term's largest impact in each block of entries, rounded up: sums in single precision stay bounds
        self.blocks = len(self.entries) // SPAN + 1
        block = terms[order] * self.blocks + self.entry_of // SPAN
        new = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(block) else np.zeros(0, np.int64)
        most = np.maximum.reduceat(self.impact_of, new) if len(new) else np.zeros(0)
        self.block_of = (self.entry_of[new] // SPAN).astype(np.int32)
        self.block_most = (most * (1 + 1e-5)).astype(np.float32)
        self.block_at = np.searchsorted(terms[order][new], np.arange(len(self.vocabulary) + 1))
        self.block_from = np.concatenate((new, [len(block)])).astype(np.int64)
        self.list_most = np.maximum.reduceat(self.block_most, self.block_at[:-1]) if len(new) else self.block_most
        self.item_of = np.array(self.entries, np.int64)

    def search(self, asks: np.ndarray, terms: np.ndarray, n: int, threshold: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, entry, score) of all entries to which the impacts of a passage's terms sum to the threshold or more.

        ``asks`` and ``terms`` are the distinct pairs of passages, numbered below ``n``, and terms.
        """
        enough = threshold - 1e-6
        pivot = np.bincount(asks, self.list_most[terms], minlength=n) >= enough
        asks, terms = asks[pivot[asks]], terms[pivot[asks]]
        at, of = _ranges(self.block_at[terms], self.block_at[terms + 1])
        cell = asks[of] * self.blocks + self.block_of[at]
        live = (np.bincount(cell, self.block_most[at], minlength=n * self.blocks) >= enough)[cell]
        at, passage = at[live], asks[of[live]]
        at, of = _ranges(self.block_from[at], self.block_from[at + 1])
        found, cell = np.unique(passage[of] * len(self.entries) + self.entry_of[at], return_inverse=True)
        score = np.bincount(cell, self.impact_of[at], minlength=len(found))
        hit = score >= threshold
        return *divmod(found[hit], max(1, len(self.entries))), score[hit]

    def overlap(self, item: int, found: np.ndarray) -> tuple[float, float, float]:
        """Shares of an item's question, answer and whole among ``found``, a passage's n-grams of the item's size."""
        found, whole = np.sort(found), self.whole[item]
        held = whole[found[np.minimum(np.searchsorted(found, whole), len(found) - 1)] == whole] if len(found) else found
        if not len(held):
            return 0.0, 0.0, 0.0
        q, a = (np.isin(part, held).mean() if len(part) else 0.0 for part in (self.question[item], self.answer[item]))
        return float(q), float(a), len(held) / len(whole)

    def accepts(self, question: float, answer: float, whole: float) -> bool:
        least = self.least - 1e-9
        return question >= least or whole >= least or (answer >= least and question >= least / 2)

    def score(self, item: int, words: np.ndarray) -> float:
        """A passage's BM25 score for an item, over the item's score for its own text."""
        terms, shares = self.shares[item]
        return float(shares[np.isin(terms, words)].sum())

    def passages(self, hashes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, first word, end, item) of all that is retrieved for the passages of each text: every passage is a query."""
        text, start, end = passages_of(offsets, self.longest)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[at] == hashes)
        term = at[known]
        low, high = np.searchsorted(known, start), np.searchsorted(known, end)
        lists = np.concatenate(([0], np.cumsum(np.diff(self.block_at)[term])))
        done = np.cumsum(lists[high] - lists[low] + self.blocks)
        cuts = np.unique(np.searchsorted(done, np.arange(0, done[-1] if len(done) else 0, WORK))).tolist()
        for i, j in itertools.pairwise([*cuts, len(text)]):
            words, of = _ranges(low[i:j], high[i:j])
            pairs = np.unique(of * len(self.vocabulary) + term[words])
            asks, entries, _ = self.search(*divmod(pairs, len(self.vocabulary)), j - i)
            for found in np.unique(asks * len(self.ids) + self.item_of[entries]).tolist():
                k, item = divmod(found, len(self.ids))
                yield int(text[i + k]), int(start[i + k]), int(end[i + k]), item


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one range after the other, and which range each is of."""
    size = end - start
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum()), np.repeat(np.arange(len(size)), size)


def passages_of(offsets: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of every passage: two neighbouring halves of a text, or all of a text that has one half only."""
    halves = np.maximum(1, -(-np.diff(offsets) // half))
    k, text = _ranges(np.zeros(len(halves), np.int64), np.maximum(1, halves - 1))
    start = offsets[text] + k * half
    return text, start, np.minimum(offsets[text + 1], start + 2 * half)


LEAK = "item_id: bigint, bm25: double, question: double, answer: double, overlap: double"
FOUND = "text_a long, text_b int, item_id long, bm25 double, question double, answer double, overlap double"


def leaks(texts: list[str | None], *parts: Index) -> Iterator[tuple[int, int, float, float, float, float]]:
    """(text, item_id, bm25, question, answer, overlap) of all that verification accepts, of an item's passages the best."""
    for first, hashes, offsets in word_hashes(texts, letters=True):
        best: dict[tuple[int, int], tuple[float, ...]] = {}
        rolled: dict[int, np.ndarray] = {}  # n-grams of all texts, by first word
        for index in parts:
            for t, start, end, item in index.passages(hashes, offsets) if index.ids else ():
                n = index.size[item]
                if n not in rolled:
                    rolled[n] = grams(hashes, n)
                q, a, both = index.overlap(item, rolled[n][start : max(start, end - n + 1)])
                if index.accepts(q, a, both):
                    key = first + t, index.ids[item]
                    best[key] = max(best.get(key, (-1.0,)), (both, q, a, index.score(item, hashes[start:end])))
        for (t, item_id), (both, q, a, bm25) in best.items():
            yield t, item_id, bm25, q, a, both


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct term of an item, and one without a term for the item itself."""
    for batch in batches:
        part, term, words = [], [], []
        for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = item_words(text)[0]
            if len(own):
                distinct = np.unique(own).view(np.int64).tolist()
                part += [k] * (len(distinct) + 1)
                term += [None, *distinct]
                words += [len(own)] + [0] * len(distinct)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(term, pa.int64()), pa.array(words, pa.int64())], names=["part", "term", "words"])


def indexed(items: DataFrame, n: int, threshold: float, least: float) -> DataFrame:
    """(part, blob): the pickled parts of the index over ``items`` (item_id, text), each built in a task of its own."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-size // PART_BYTES)))).cast("int"))
    summaries = staged(rows.select("part", "text").mapInArrow(_summaries, "part int, term long, words long"), "decontam-terms")
    count, words, longest = summaries.where("term is null").agg(F.count("*"), F.sum("words"), F.max("words")).first()
    own = summaries.where("term is not null").groupBy("part", "term").agg(F.count("*").alias("n"))
    terms = own.join(own.groupBy("term").agg(F.sum("n").alias("found")), "term").select("part", "term", "found")

    def build(items: pa.Table, terms: pa.Table) -> pa.Table:
        if not items.num_rows or not terms.num_rows:
            return pa.table({"part": pa.array([], pa.int32()), "blob": pa.array([], pa.binary())})
        items = items.sort_by([("item_id", "ascending"), ("text", "ascending")])
        known = Statistics(count, words, longest, terms.column("term").to_numpy().view(np.uint64), terms.column("found").to_numpy())
        index = Index(list(zip(items.column("item_id").to_pylist(), items.column("text").to_pylist(), strict=True)), n, threshold, least, known)
        return pa.table({"part": items.column("part").slice(0, 1), "blob": pa.array([pickle.dumps(index)], pa.binary())})

    built = staged(rows.groupBy("part").cogroup(terms.groupBy("part")).applyInArrow(build, "part int, blob binary"), "decontam-index")
    dropped(summaries)
    return built


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = 0.45, least: float = 0.6, n: int = 5) -> DataFrame:
    """``docs`` (text, ...) with contaminated and leaks (a row for each verified item, by item id)."""
    spark = docs.sparkSession
    index = indexed(items, n, threshold, least)
    turns: list[list[int]] = []
    room = 0
    for part, size in sorted(tuple(r) for r in index.select("part", F.length("blob")).collect()):
        if size > room:
            turns.append([])
            room = TOGETHER
        turns[-1].append(part)
        room -= size
    texts = docs.select(F.xxhash64("text").alias("text_a"), F.hash("text").alias("text_b"), "text")
    found: DataFrame | None = None
    for turn in turns:
        own = index.where(F.col("part").isin(turn)).orderBy("part").collect()
        shared = spark.sparkContext.broadcast([r["blob"] for r in own])
        one = staged(texts.mapInArrow(_judging(shared), FOUND), "decontam-found")
        shared.unpersist()
        found = one if found is None else found.unionAll(one)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    leak = F.struct("item_id", "bm25", "question", "answer", "overlap")
    best = found.groupBy("text_a", "text_b", "item_id").agg(F.max_by(leak, F.struct("overlap", "question", "answer", "bm25")).alias("leak"))
    leaky = staged(best.groupBy("text_a", "text_b").agg(F.sort_array(F.collect_list("leak")).alias("leaks")), "decontam-leaks")
    leaky = leaky.select(F.col("text_a").alias("__a"), F.col("text_b").alias("__b"), F.col("leaks").alias("__leaks"))
    if leaky.count() <= BROADCAST_TEXTS:
        leaky = F.broadcast(leaky)
    plain = without(docs, "contaminated", "leaks")
    judged = plain.join(leaky, (F.xxhash64(plain["text"]) == leaky["__a"]) & (F.hash(plain["text"]) == leaky["__b"]), "left")
    none = F.from_json(F.lit("[]"), f"array<struct<{LEAK}>>")
    return judged.select(*[plain[f"`{c}`"] for c in plain.columns], leaky["__leaks"].isNotNull().alias("contaminated"), F.coalesce(leaky["__leaks"], none).alias("leaks"))


def _judging(shared):  # noqa: ANN001, ANN202
    """Rows of FOUND for the texts of each batch."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[Index] = [pickle.loads(blob) for blob in shared.value]
        for batch in batches:
            rows = list(leaks(batch.column("text").to_pylist(), *parts))
            at = pa.array([r[0] for r in rows], pa.int64())
            columns = [batch.column("text_a").take(at), batch.column("text_b").take(at), pa.array([r[1] for r in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array([r[k] for r in rows], pa.float64()) for k in range(2, 6)]], names=["text_a", "text_b", "item_id", "bm25", "question", "answer", "overlap"])

    return lambda batches: frugal(work(batches))
