"""Bounded-space online best-fit packing of tokenised documents into fixed-length sequences.

Documents become pieces of at most ``length`` tokens (only longer ones are cut). Pieces are dealt by a hash and arrive
at each task's packer one after another. It keeps at most ``open_bins`` sequences open, filed in a bitset keyed by free
space: a piece goes to the open sequence with the least free space that still holds it, a new one is opened if there
is none, and when one too many is open the fullest closes. What is still open when a task ends is packed once more
with that of other tasks, in fewer tasks.

Defined results: null text counts as empty and still has its end token; repeated rows are packed as often as they
occur; a null id is packed like any other; columns other than id and text are not read.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodebar.llm.common import frugal, staged

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"

#: Words that a worker's table holds before a new one is begun; words still in use move on from the last (about 100 MB each).
CACHE_WORDS = 500_000
#: Texts whose words are looked up together.
GROUP = 256
#: Characters where str.split() splits but the tokenizer's white space does not.
_PART = " \x01 "
#: Letters that stay letters when normalised and lower-cased, then a comma or stop.
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e]+[,.]").fullmatch
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f")


class WordCachedTokenizer:
    """Ids of whole texts as little-endian 32-bit integers.

    The tokenizer never joins anything across white space, so the ids of a text are those of its white-space-separated
    words in turn; each word is encoded once and then looked up.
    """

    def __init__(self, file: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs as many tasks as there are cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.limit = CACHE_WORDS
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        (self.part,) = np.frombuffer(self._whole(_PART.strip()), np.uint32)
        self.marks = {m: self._whole(m) for m in ",."}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).astype("<u4").tobytes()

    def _encode(self, words: list[str]) -> list[bytes]:
        """Many words in a call, each parted from the next by a character that is a token of its own and in no word."""
        out: list[bytes] = []
        lines = [_PART.join(words[i : i + 200]) for i in range(0, len(words), 200)]
        for coded in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False):
            ids = np.array(coded.ids, np.uint32)
            cut = np.flatnonzero(ids == self.part).tolist()
            raw = ids.astype("<u4").tobytes()
            out += [raw[4 * i : 4 * j] for i, j in zip([0, *[c + 1 for c in cut]], [*cut, len(ids)], strict=True)]
        return out

    def _learn(self, words: set[str], special: bool) -> None:
        """Codes words that aren't known yet. special: some may hold marks that mean something to the tokenizer or to us."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.known, self.before, new = {}, self.known, words
        known, before = self.known, self.before
        again = new.intersection(before)
        known.update(zip(again, map(before.__getitem__, again), strict=True))
        new = new - again
        if special:
            for w in [w for w in new if "\x01" in w or "<|" in w]:
                known[w] = self._whole(w)
                new.discard(w)
        plain, lowered, marked = set(), [], []  # a word's letters and the comma or stop after them are coded apart anyway
        for w in new:
            if w[-1] in ",.":
                core = w[:-1]
                if core.isalpha() and core.isascii():
                    core = core.lower()
                    marked.append((w, core))
                    plain.add(core)
                    continue
                if _PLAIN(w):
                    marked.append((w, core))
                    plain.add(core)
                    continue
            low = w.lower() if w.isascii() else w
            plain.add(low)
            if low != w:
                lowered.append((w, low))
        first = list(plain.difference(known))
        known.update(zip(first, self._encode(first), strict=True))
        for w, low in lowered:
            known[w] = known[low]
        for w, core in marked:
            known[w] = known[core] + self.marks[w[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [t.split() for t in texts]
        special = any("\x01" in t or "<|" in t for t in texts)
        self._learn(set(itertools.chain.from_iterable(words)), special)
        out = [b"".join(map(self.known.__getitem__, w)) for w in words]
        for i, t in enumerate(texts):
            if any(c in t for c in _ODD):
                out[i] = self._whole(t)
        return out


_tokenizers: dict[str, WordCachedTokenizer] = {}


def tokenizer(file: str) -> WordCachedTokenizer:
    if file not in _tokenizers:
        _tokenizers[file] = WordCachedTokenizer(file)
    return _tokenizers[file]


def pieces(docs: DataFrame, tokenizer_file: str, length: int = 2048, end_id: int = 0, table_words: int = CACHE_WORDS) -> DataFrame:
    """Each document's ids followed by ``end_id``, cut into pieces of at most ``length``."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(tokenizer_file)
        coder.limit = table_words
        for whole in batches:
            for at in range(0, whole.num_rows, GROUP):
                batch = whole.slice(at, GROUP)
                ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
                rows = []
                for doc, coded in zip(ids, coder.encode(texts), strict=True):
                    coded += end
                    for k, start in enumerate(range(0, len(coded), 4 * length)):
                        part = coded[start : start + 4 * length]
                        rows.append((doc, k, start // 4, len(part) // 4, zlib.crc32(part)))
                d, k, s, n, c = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d, pa.int64()), pa.array(k, pa.int32()), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(c, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda b: frugal(cut(b)), PIECES)


class BestFit:
    """Open sequences in a bitset keyed by free space; ``put`` returns where a piece goes and what closed."""

    def __init__(self, length: int, open_bins: int, first_id: int) -> None:
        self.length, self.open_bins, self.next_id = length, open_bins, first_id
        self.free_bits, self.n_open = 0, 0
        self.by_free: list[list[tuple[int, list]]] = [[] for _ in range(length + 1)]

    def _file(self, free: int, bin_: tuple[int, list]) -> None:
        self.by_free[free].append(bin_)
        self.free_bits |= 1 << free

    def _take(self, free: int) -> tuple[int, list]:
        bin_ = self.by_free[free].pop()
        if not self.by_free[free]:
            self.free_bits &= ~(1 << free)
        return bin_

    def put(self, piece: tuple, size: int) -> Iterator[tuple[int, list]]:
        """Places a piece; yields the sequences that this closes."""
        fitting = self.free_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
            self.n_open -= 1
        else:
            free, bin_ = self.length, (self.next_id, [])
            self.next_id += 1
        bin_[1].append((piece, self.length - free))
        if free == size:
            yield bin_
            return
        self._file(free - size, bin_)
        self.n_open += 1
        if self.n_open > self.open_bins:
            self.n_open -= 1
            yield self._take((self.free_bits & -self.free_bits).bit_length() - 1)

    def rest(self) -> Iterator[tuple[int, list]]:
        for bins in self.by_free:
            yield from bins


def _packed(batches: Iterable[pa.RecordBatch], length: int, open_bins: int, base: int, close_all: bool) -> Iterator[pa.RecordBatch]:
    fit = BestFit(length, open_bins, base + (TaskContext.get().partitionId() << 36))  # type: ignore[union-attr]
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
        made = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )
        out.clear()
        return made

    for batch in batches:
        for piece in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
            for seq, members in fit.put(piece, piece[3]):
                out += [(*p, seq, offset) for p, offset in members]
        if out:
            yield flush()
    for seq, members in fit.rest():
        out += [(*p, seq if close_all else None, offset if close_all else None) for p, offset in members]
    if out:
        yield flush()


def pack(docs: DataFrame, tokenizer_file: str, length: int = 2048, open_bins: int = 256, end_id: int = 0, per_task: int = 200_000, table_words: int = CACHE_WORDS) -> DataFrame:
    """Where each piece of each document goes: sequence_id and offset beside what ``pieces`` returns.

    Pieces are dealt by hash into evenly filled tasks, so no key is hot. Sequences that tasks leave open are packed
    again, about ``per_task`` pieces to a task. table_words: words that a worker remembers; fewer take less memory and more time.
    """
    cut = pieces(docs, tokenizer_file, length, end_id, table_words)
    order = [F.xxhash64("doc_id", "piece"), F.col("doc_id"), F.col("piece")]
    dealt = cut.repartition(order[0]).sortWithinPartitions(*order)
    first = staged(dealt.mapInArrow(lambda b: frugal(_packed(b, length, open_bins, 0, False)), PLACED), "packed")
    left = first.where("sequence_id is null").select(*PLACED_COLUMNS[:5])
    tasks = max(1, left.count() // per_task)
    again = left.repartition(tasks, order[0]).sortWithinPartitions(F.desc("length"), *order)
    rest = again.mapInArrow(lambda b: frugal(_packed(b, length, open_bins, 1 << 62, True)), PLACED)
    return first.where("sequence_id is not null").unionByName(rest)


PLACED_COLUMNS = [c.split()[0] for c in PLACED.split(", ")]
