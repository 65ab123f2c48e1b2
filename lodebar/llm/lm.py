"""Language-model scoring with a weighted backoff automaton.

The model is a word-pair model with Dirichlet smoothing (MacKay and Peto, 1995), learned from the rows marked for it:

    P(w)     = (c(w) + 0.5) / (N + 0.5 * (V + 1))
    P(w | h) = (c(h w) + mu * P(w)) / (c(h) + mu)

As an automaton: one state for each known word and for the boundary between texts, and a root. Seen pairs are arcs of
their first word's state; any other word takes that state's failure arc, of weight mu / (c(h) + mu), to the root and
goes on from there with P(w). Reading a token leads to the token's own state, or to the root when it is unknown, so one
pass from left to right needs the state before each token only. It is written over arrays, all texts of a chunk at once.

No task holds the whole model. Texts are dealt into chunks by hash. Each chunk asks for the counts of its distinct words
and pairs, in packed arrays split by ranges of their hashes; each range adds up what all chunks have sent and answers
each in its own order. A chunk sends to ranges that have one of its words or pairs only, so there are never more messages
than distinct words and pairs of chunks, and these grow with the input. Ranges and chunks are even whatever words are
frequent, since a chunk sends any word once, and their sizes are fixed in bytes while their number grows with the input.
A row that occurs often is sent once by each task for every REPEATS_BYTES of text, and goes to a chunk of that task's own.

Defined results: null text counts as empty: its only token is the end. A null id counts as empty text where ids are
hashed. Repeated rows are learned from and scored as often as they occur. Empty tables give no rows. Columns other than
those named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodebar.llm.common import frugal
from lodebar.llm.words import mix, packed, sums_between, unpacked, word_hashes

#: Hash of the end of a text, which is also what stands before its first word.
END = np.uint64(0x5851F42D4C957F2D)
_PAIR = np.uint64(0xD1342543DE82EF95)

#: Text that a task looks through at a time for repeated rows, and tokens whose distinct words it sends at a time.
REPEATS_BYTES, TOKENS = 8 << 20, 1 << 20

ONCE = "doc_id long, text string, learned boolean, times long, task int"
ASKED = "part int, chunk int, words binary, word_counts binary, pairs binary, pair_counts binary"
ANSWERED = "chunk int, part int, word_counts binary, pair_counts binary"
SCORED = "times long, doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def range_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` (below 2**31) equal ranges each hash is in."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _slim(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64)


def _counts(raw: pa.Buffer, n: int) -> np.ndarray:
    if raw.size not in (4 * n, 8 * n):
        raise RuntimeError("counts don't fit the chunk that asked for them")
    return np.frombuffer(raw, np.uint32 if raw.size == 4 * n else np.uint64)


class Chunk:
    """The tokens of a chunk's texts: each text's words, then the end."""

    def __init__(self, texts: list[str | None]) -> None:
        hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, h, at in word_hashes(texts):
            stream = np.full(len(h) + len(at) - 1, END)
            stream[np.arange(len(h)) + np.repeat(np.arange(len(at) - 1), np.diff(at))] = h
            hashes.append(stream)
            sizes.append(np.diff(at) + 1)
        self.offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        tokens = np.concatenate(hashes)
        self.words, self.word_at = np.unique(tokens, return_inverse=True)
        before = np.concatenate(([END], tokens[:-1]))  # what stands before a text's first word is the end of the last
        self.pairs, self.pair_at = np.unique(mix(before * _PAIR + tokens), return_inverse=True)

    def counts(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each distinct word and pair occurs when texts are learned from ``times`` times."""
        weight = np.repeat(times.astype(float), np.diff(self.offsets))
        return tuple(np.bincount(at, weight, n).astype(np.uint64) for at, n in ((self.word_at, len(self.words)), (self.pair_at, len(self.pairs))))  # type: ignore[return-value]

    def messages(self, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ranges of hashes that have words or pairs of this chunk, and where each one's words and pairs begin; ends last."""
        words, pairs = range_of(self.words, parts), range_of(self.pairs, parts)
        used = np.union1d(words, pairs)
        return used, *(np.append(np.searchsorted(own, used), len(own)) for own in (words, pairs))


class Automaton:
    """The part of the model that a chunk needs: its own words' states and its own pairs' arcs."""

    def __init__(self, chunk: Chunk, word_counts: np.ndarray, pair_counts: np.ndarray, tokens: int, kinds: int, mu: float) -> None:
        self.known = word_counts > 0
        root = np.log10((word_counts + 0.5) / (tokens + 0.5 * (kinds + 1)))
        self.root, self.failure = root, np.log10(mu / (word_counts + mu))  # an unknown word's state is the root: its failure costs nothing
        self.seen = pair_counts > 0
        state = np.concatenate(([np.searchsorted(chunk.words, END)], chunk.word_at[:-1])) if len(chunk.word_at) else chunk.word_at
        first, last = np.zeros(len(chunk.pairs), np.int64), np.zeros(len(chunk.pairs), np.int64)
        first[chunk.pair_at], last[chunk.pair_at] = state, chunk.word_at
        self.arc = np.log10((pair_counts + mu * 10.0 ** root[last]) / (word_counts[first] + mu))
        self.chunk, self.state = chunk, state

    def traverse(self) -> np.ndarray:
        """Log10 probability of each token from the state before it."""
        at = self.chunk.pair_at
        return np.where(self.seen[at], self.arc[at], self.failure[self.state] + self.root[self.chunk.word_at])


def _once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task, repeated ones together."""
    held: list[pa.RecordBatch] = []
    task = TaskContext.get().partitionId()  # the same when the task is run again

    def made() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).group_by(["doc_id", "text", "learned"]).aggregate([([], "count_all")])
        rows = rows.select(["doc_id", "text", "learned"]).append_column("times", rows.column("count_all").cast(pa.int64()))
        yield from rows.append_column("task", pa.array([task] * rows.num_rows, pa.int32())).to_batches(1000)

    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= REPEATS_BYTES:
            yield from made()
            held = []
    if held:
        yield from made()


def _vocabulary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of TOKENS tokens or so at a time and how often they occur; a longer text's at once."""

    def made() -> pa.RecordBatch:
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts, pa.int64())], names=["word", "n"])

    held: list[np.ndarray] = []
    for batch in batches:
        for _, h, at in word_hashes(batch.column("text").to_pylist()):
            held += [h, np.full(len(at) - 1, END)]
            if sum(map(len, held)) >= TOKENS:
                yield made()
                held = []
    if held:
        yield made()


def _ask(parts: int):  # noqa: ANN202
    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        chunk = Chunk(rows.column("text").to_pylist())
        learned = rows.column("learned").to_numpy().astype(bool)
        counted = chunk.counts(np.where(learned, rows.column("times").to_numpy(), 0))
        used, *edges = chunk.messages(parts)
        cut = lambda a, e, kept: [kept(a[i:j]) for i, j in zip(e[:-1].tolist(), e[1:].tolist(), strict=True)]
        counts = lambda a: _slim(a).tobytes()
        columns = [cut(chunk.words, edges[0], packed), cut(counted[0], edges[0], counts), cut(chunk.pairs, edges[1], packed), cut(counted[1], edges[1], counts)]
        return pa.table(
            {
                "part": pa.array(used, pa.int32()),
                "chunk": pa.array([key[0].as_py()] * len(used), pa.int32()),
                **{n: pa.array(c, pa.binary()) for n, c in zip(("words", "word_counts", "pairs", "pair_counts"), columns, strict=True)},
            }
        )

    return ask


def _summed(hashes: pa.ChunkedArray, counts: pa.ChunkedArray) -> list[bytes]:
    """For each chunk that has sent hashes, their counts over all chunks."""
    sent = [unpacked(x.as_buffer()) for x in hashes]
    own = [_counts(x.as_buffer(), len(s)) for x, s in zip(counts, sent, strict=True)]
    found, at = np.unique(np.concatenate(sent), return_inverse=True)
    each = np.bincount(at, weights=np.concatenate(own), minlength=len(found)).astype(np.uint64)[at]
    edges = np.cumsum([0, *map(len, sent)]).tolist()
    return [_slim(each[i:j]).tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)]


def _answer(key: tuple, rows: pa.Table) -> pa.Table:
    return pa.table(
        {
            "chunk": rows.column("chunk"),
            "part": rows.column("part"),
            **{f"{what}_counts": pa.array(_summed(rows.column(f"{what}s"), rows.column(f"{what}_counts")), pa.binary()) for what in ("word", "pair")},
        }
    )


def _score(parts: int, tokens: int, kinds: int, mu: float):  # noqa: ANN202
    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(rows.column("text").to_pylist())
        answers = answers.sort_by("part")
        used, *edges = chunk.messages(parts)
        if answers.column("part").to_pylist() != used.tolist():
            raise RuntimeError("answers don't fit the chunk that asked for them")
        sums = [
            np.concatenate([np.zeros(0), *(_counts(x.as_buffer(), n).astype(float) for x, n in zip(answers.column(f"{what}_counts"), np.diff(e).tolist(), strict=True))])
            for what, e in zip(("word", "pair"), edges, strict=True)
        ]
        model = Automaton(chunk, *sums, tokens, kinds, mu)
        at, n = chunk.offsets, len(chunk.offsets) - 1
        return pa.table(
            {
                "times": rows.column("times"),
                "doc_id": rows.column("doc_id"),
                "n_tokens": pa.array(np.diff(at), pa.int64()),
                "n_known": pa.array(sums_between(model.known[chunk.word_at].astype(np.int64), at), pa.int64()),
                "train_tokens": pa.array([tokens] * n, pa.int64()),
                "base_score": pa.array(np.add.reduceat(model.root[chunk.word_at], at[:-1]), pa.float64()),
                "score": pa.array(np.add.reduceat(model.traverse(), at[:-1]), pa.float64()),
            }
        )

    return score


def score(docs: DataFrame, learned: Column, mu: float = 300.0, chunk_bytes: int = 12 << 20, part_bytes: int = 16 << 20) -> DataFrame:
    """Scores of all documents under a model of those where ``learned`` holds.

    chunk_bytes: text that one task scores at a time; part_bytes: the text whose words one range of hashes counts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(learned, F.lit(False)).alias("learned"))
    size = rows.agg(F.sum(F.octet_length("text") + F.lit(8))).first()[0] or 0
    chunks, parts = max(1, math.ceil(size / chunk_bytes)), max(1, math.ceil(size / part_bytes))
    words = rows.where("learned").select("text").mapInArrow(lambda b: frugal(_vocabulary(b)), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    tokens, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    place = F.pmod(F.xxhash64("doc_id", F.xxhash64("text"), "task"), F.lit(chunks)).cast("int")
    dealt = rows.mapInArrow(lambda b: frugal(_once(b)), ONCE).withColumn("chunk", place).drop("task").repartition("chunk")
    asked = dealt.groupBy("chunk").applyInArrow(_ask(parts), ASKED)
    answered = asked.groupBy("part").applyInArrow(_answer, ANSWERED)
    scored = dealt.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(_score(parts, tokens, kinds, mu), SCORED)
    each = scored.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return each.drop("times")
