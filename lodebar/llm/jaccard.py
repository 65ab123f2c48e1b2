"""Exact near-duplicate join on word shingles: size-banded tiles, bitmap signatures, exact intersections.

A document's set holds the hashes of its distinct word shingles (k words; fewer words count as one shingle). Two
documents link when 100 * intersection >= percent * union.

1. Documents with equal sets become one class.
2. Every class files its prefix, the n - ceil(percent * n / 100) + 1 shingles that come first when frequent ones go
   last: two sets that link share one of these, whatever the order. Shingles travel as packed arrays, by ranges of hashes.
   Classes that share a shingle make up a tile; tiles with the same classes are one tile.
3. In each tile and band of sizes, classes are compared with the band's leader first. Once components of those links are
   known, only tiles that hold several components are left. In blocks of a tile, by bands of sizes, all pairs from
   different components are compared by coarse bitmaps, and in blocks of the clusters of these by fine ones.
4. Comparing means: hashed bitmap signatures bound the overlap from above (bits that differ are shingles of one set
   only); pairs that pass are intersected exactly.

So no link between components is lost, and what comes out of a block are the pairs that may join components, never all
pairs of a group. Blocks have at most BLOCK classes on either side; more become a grid of blocks. Hashes have 64 bits: two given
shingles, or two given sets, are mistaken for one with a probability of 2**-64.

Defined results: null text and text without words have an empty set, link with nothing and are their own component. Rows
without an id link like all others, but a null id never names a component: one of such rows only has none. Rows that share an
id are rows of their own. Repeated rows are copies. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodebar.llm.common import dropped, freed, frugal, returned, staged
from lodebar.llm.components import components
from lodebar.llm.words import mix, packed, unpacked, word_hashes

_STEP = np.uint64(0xA0761D6478BD642F)

#: The most frequent shingles, which go last in every prefix: at most so many are broadcast (16 bytes each).
HOT = 200_000
#: Shingles counted together in a task, and the count from which one is reported as frequent.
COUNTED, OFTEN = 1_000_000, 4
#: Ids are broadcast to pick out texts up to so many; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Prefix shingles that a range of hashes holds on average, and that are looked at together.
RANGE, SLICE = 4_000_000, 1_000_000
#: Bits for each shingle at least in the bitmaps of the first look, which travel to every tile, and in those of the second.
COARSE, FINE = 1, 12
#: Pairs of a block that are looked at together, and texts that are.
PAIRS, TEXTS = 1 << 18, 512
#: Classes on either side of a block of pairs.
BLOCK = 4096

META = "doc_id long, text_id long, n int, sid long, bitmap binary, hot long, often long"


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, text): a text's own hash finds it again where ids are null or shared; texts of one id are mistaken for one with a probability of 2**-64."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    for _, h, at in word_hashes(texts):
        rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
        for i in range(k):
            rolled = mix(rolled * _STEP + h[i : len(h) - k + 1 + i]) if i == k - 1 else rolled * _STEP + h[i : len(h) - k + 1 + i]
        for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if j - i >= k:
                yield np.unique(rolled[i : j - k + 1])
            elif j > i:
                one = np.uint64(j - i)
                for w in h[i:j]:
                    one = mix(np.array([one]) * _STEP + w)[0]
                yield np.array([one])
            else:
                yield np.zeros(0, np.uint64)


def set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap(shingles: np.ndarray, each: int = 2) -> bytes:
    """Hashed bitmap of the least power of two of bits that is at least ``each`` times the set's size, and 64 at least."""
    bits = max(64, 1 << (each * len(shingles) - 1).bit_length())
    on = np.zeros(bits, bool)
    on[(shingles & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(on, bitorder="little").tobytes()


def folded(bitmaps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps folded to ``size`` bytes, a row of 64-bit numbers each."""
    out = np.zeros((len(bitmaps), size // 8), np.uint64)
    for i, b in enumerate(bitmaps):
        out[i] = np.bitwise_or.reduce(np.frombuffer(b, np.uint64).reshape(-1, size // 8), axis=0)
    return out


def may_link(differ: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of together ``sizes`` shingles can link when at least ``differ`` are in one of them only.

    The overlap is at most (sizes - differ) / 2 and the union at least (sizes + differ) / 2.
    """
    return 100 * (sizes - differ) >= percent * (sizes + differ)


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few texts at a time, so that a worker never holds a whole batch as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            yield batch.slice(at, TEXTS)


def _batches(columns: dict[str, pa.DataType], rows: Iterator[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), columns.values(), strict=True)], names=list(columns))

    for r in rows:
        held.append(r)
        if len(held) == size:
            yield made()
            held = []
    if held:
        yield made()


def sketched(docs: DataFrame, k: int) -> DataFrame:
    """META rows: one for each document, and one for each shingle that a task has found often."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[np.ndarray] = []
        size = 0

        def often() -> Iterator[tuple]:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            for h, c in zip(found[n >= OFTEN].view(np.int64).tolist(), n[n >= OFTEN].tolist(), strict=True):
                yield None, None, None, None, None, h, c

        for batch in _slices(batches):
            for doc, text, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(batch.column(2).to_pylist(), k), strict=True):
                yield (doc, text, len(s), set_id(s), bitmap(s, COARSE), None, None) if len(s) else (doc, text, 0, None, None, None, None)
                held.append(s)
                size += len(s)
                if size > COUNTED:
                    yield from often()
                    held, size = [], 0
        if held:
            yield from often()

    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    kinds = dict(zip(("doc_id", "text_id", "n", "sid", "bitmap", "hot", "often"), types, strict=True))
    return docs.mapInArrow(lambda b: frugal(_batches(kinds, work(b))), META)


def _hot(meta: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and their counts; at most HOT of them."""
    found = meta.where("hot is not null").groupBy("hot").agg(F.sum("often").alias("n")).where("n >= 16").orderBy(F.desc("n"), "hot").limit(HOT).toPandas()
    hot = found["hot"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hot)
    return hot[order], found["n"].to_numpy(np.int64)[order]


def filed(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], k: int, percent: int, parts: int) -> DataFrame:
    """Prefixes by ranges of hashes: (part, tokens, sets, sizes, of), ``of`` being a token's place in sets and sizes."""
    frequent = docs.sparkSession.sparkContext.broadcast(hot)
    bounds = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)

    def first(s: np.ndarray) -> np.ndarray:
        hashes, counts = frequent.value
        p = prefix_length(len(s), percent)
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
            rank = np.where(hashes[at] == s, counts[at], 0)
            if rank.any():
                return s[np.lexsort((s, rank))[:p]]
        return s[:p]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        tokens: list[np.ndarray] = []
        ids: list[int] = []
        lens: list[int] = []
        size = 0

        def flush() -> pa.RecordBatch:
            token = mix(np.concatenate(tokens))  # prefixes hold small hashes: mixed anew, they spread evenly over the ranges
            of = np.repeat(np.arange(len(ids)), [len(t) for t in tokens])
            order = np.argsort(token, kind="stable")
            token, of = token[order], of[order]
            edges = [0, *np.searchsorted(token, bounds).tolist(), len(token)]
            out: list[list] = [[], [], [], [], []]
            sets, sizes = np.array(ids, np.int64), np.array(lens, np.int32)
            for part, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if j > i:
                    own, place = np.unique(of[i:j], return_inverse=True)
                    narrow = np.uint16 if len(own) <= 1 << 16 else np.uint32
                    for c, v in zip(out, (part, packed(token[i:j]), sets[own].tobytes(), sizes[own].tobytes(), place.astype(narrow).tobytes()), strict=True):
                        c.append(v)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *[pa.array(c, pa.binary()) for c in out[1:]]], names=["part", "tokens", "sets", "sizes", "of"])

        for batch in _slices(batches):
            for s in shingle_sets(batch.column(0).to_pylist(), k):
                if len(s) and (sid := set_id(s)) not in seen:
                    seen.add(sid)
                    tokens.append(first(s))
                    ids.append(sid)
                    lens.append(len(s))
                    size += len(tokens[-1])
                    if size > COUNTED:
                        yield flush()
                        tokens, ids, lens, size = [], [], [], 0
        if tokens:
            yield flush()

    return docs.select("text").mapInArrow(lambda b: frugal(work(b)), "part int, tokens binary, sets binary, sizes binary, of binary")


def band_of(n: np.ndarray, percent: int) -> np.ndarray:
    """Bands of sizes: sets that link are in the same band or in neighbouring ones."""
    return np.floor(np.log(n) / math.log(100 / percent) + 1e-9).astype(np.int32)


def _tiles(percent: int):  # noqa: ANN202
    """Per range of hashes: (tile, sid, n, band, leader) of every class that shares a prefix shingle, each set of classes once."""

    def of_slice(token: np.ndarray, sid: np.ndarray, n: np.ndarray) -> pa.Table:
        found, back, count = np.unique(token, return_inverse=True, return_counts=True)
        shared = count[back] > 1
        token, sid, n = back[shared], sid[shared], n[shared]
        order = np.lexsort((sid, token))
        token, sid, n = token[order], sid[order], n[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
        token, sid, n = token[new], sid[new], n[new]
        start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
        length = np.diff(np.concatenate((start, [len(token)])))
        name = np.add.reduceat(mix(sid.view(np.uint64)), start) if len(start) else np.zeros(0, np.uint64)
        _, once = np.unique(name, return_index=True)
        keep = np.zeros(len(start), bool)
        keep[once] = True
        keep &= length > 1
        rows_kept = np.repeat(keep, length)
        tile = np.repeat(name, length)[rows_kept].view(np.int64)
        sid, n = sid[rows_kept], n[rows_kept]
        band = band_of(n, percent)
        order = np.lexsort((mix(sid.view(np.uint64)), band, tile))
        tile, sid, n, band = tile[order], sid[order], n[order], band[order]
        head = np.ones(len(tile), bool)
        head[1:] = (tile[1:] != tile[:-1]) | (band[1:] != band[:-1])
        leader = sid[np.maximum.accumulate(np.where(head, np.arange(len(tile)), 0))] if len(tile) else sid
        return pa.table({"tile": tile, "sid": sid, "n": pa.array(n, pa.int32()), "band": pa.array(band, pa.int32()), "leader": leader})

    def tiles(rows: pa.Table) -> pa.Table:
        """Slices of the range one after the other: shingles of different slices have no tile in common."""
        get = lambda c, kind: [np.frombuffer(x.as_buffer(), kind) for x in rows.column(c)]
        sets, sizes = get("sets", np.int64), get("sizes", np.int32)
        tokens = [unpacked(x.as_buffer()) for x in rows.column("tokens")]
        of = [np.frombuffer(x.as_buffer(), np.uint16 if len(s) <= 1 << 16 else np.uint32) for x, s in zip(rows.column("of"), sets, strict=True)]
        low, high = min(int(t[0]) for t in tokens), max(int(t[-1]) for t in tokens) + 1
        cuts = max(1, sum(map(len, tokens)) // SLICE)
        bounds = np.array([low + (high - low) * c // cuts for c in range(1, cuts)], np.uint64)
        edges = [[0, *np.searchsorted(t, bounds).tolist(), len(t)] for t in tokens]
        out = []
        for c in range(cuts):
            own = [slice(e[c], e[c + 1]) for e in edges]
            token = np.concatenate([t[k] for t, k in zip(tokens, own, strict=True)])
            sid = np.concatenate([s[o[k]] for s, o, k in zip(sets, of, own, strict=True)])
            n = np.concatenate([s[o[k]] for s, o, k in zip(sizes, of, own, strict=True)])
            out.append(of_slice(token, sid, n))
        returned()
        return pa.concat_tables(out)

    return tiles


def _bounded(percent: int):  # noqa: ANN202
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = b.column("left_bits").to_pylist(), b.column("right_bits").to_pylist()
            n = b.column("left_n").to_numpy().astype(np.int64) + b.column("right_n").to_numpy()
            differ = np.zeros(len(left), np.int64)
            for i, (x, y) in enumerate(zip(left, right, strict=True)):
                size = min(len(x), len(y))
                p, q = folded([x, y], size)
                differ[i] = np.bitwise_count(p ^ q).sum()
            ok = may_link(differ, n, percent)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(ok)), b.column("b").filter(pa.array(ok))], names=["a", "b"])

    return work


def _intersected(percent: int):  # noqa: ANN202
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("left_set").to_pylist(), b.column("right_set").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(ok, pa.bool_())), b.column("b").filter(pa.array(ok, pa.bool_()))], names=["a", "b"])

    return work


class Join:
    """What the rounds of one join share: documents, a document for each class, and classes' bitmaps."""

    def __init__(self, docs: DataFrame, k: int, percent: int) -> None:
        self.docs, self.k, self.percent = identified(docs), k, percent
        self.meta = staged(sketched(self.docs, k), "jaccard-meta")
        one = F.min_by(F.struct("n", "bitmap", "doc_id", "text_id"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_id"))
        classes = self.meta.where("sid is not null").groupBy("sid").agg(one.alias("s"))
        self.classes = staged(classes.select("sid", "s.*"), "jaccard-classes")
        self.passing: list[DataFrame] = []  # tables that only this join's own steps read

    def kept(self, table: DataFrame, label: str) -> DataFrame:
        """``table`` staged until the join is done; the shuffles that made it are freed."""
        self.passing.append(staged(table, f"jaccard-{label}"))
        freed(table.sparkSession)
        return self.passing[-1]

    def passed(self, since: int) -> None:
        """Deletes what was kept after the first ``since`` tables, but for the last one, which was made of it."""
        dropped(*self.passing[since:-1])
        del self.passing[since:-1]

    def sets(self, wanted: DataFrame, fine: bool = False) -> DataFrame:
        """(sid, shingles) of the classes in ``wanted``, from their first documents' texts; ``fine``: bitmaps of them instead."""
        ids = self.kept(wanted.join(self.classes.select("sid", "doc_id", "text_id"), "sid"), "wanted")
        ids = _small(ids.select("sid", F.col("doc_id").alias("own_id"), F.col("text_id").alias("own_text")))
        chosen = self.docs.join(ids, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_id") == F.col("own_text"))).select("sid", "text")
        k = self.k

        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
            for b in _slices(batches):
                for sid, s in zip(b.column(0).to_pylist(), shingle_sets(b.column(1).to_pylist(), k), strict=True):
                    if len(s) and set_id(s) == sid:
                        yield sid, bitmap(s, FINE) if fine else s.tobytes()

        rows = chosen.mapInArrow(lambda b: frugal(_batches({"sid": pa.int64(), "shingles": pa.binary()}, work(b), 1000)), "sid long, shingles binary")
        return self.kept(rows, "sets").dropDuplicates(["sid"])

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that link: bitmaps first, then exactly."""
        own = self.classes.select("sid", "n", "bitmap")
        left = own.select(F.col("sid").alias("a"), F.col("n").alias("left_n"), F.col("bitmap").alias("left_bits"))
        right = own.select(F.col("sid").alias("b"), F.col("n").alias("right_n"), F.col("bitmap").alias("right_bits"))
        fit = F.lit(100) * F.least("left_n", "right_n") >= F.lit(self.percent) * F.greatest("left_n", "right_n")
        return self.exact(self.kept(pairs.join(left, "a").join(right, "b").where(fit).mapInArrow(_bounded(self.percent), "a long, b long"), "bounded"))

    def exact(self, pairs: DataFrame) -> DataFrame:
        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct())
        left = sets.select(F.col("sid").alias("a"), F.col("shingles").alias("left_set"))
        right = sets.select(F.col("sid").alias("b"), F.col("shingles").alias("right_set"))
        return pairs.join(left, "a").join(right, "b").mapInArrow(_intersected(self.percent), "a long, b long")

    def links_between(self, tiles: DataFrame, roots: DataFrame) -> DataFrame:
        """All links (a, b) between classes of a tile that are in different components.

        Coarse bitmaps first part the classes of tiles into clusters: what comes out of a tile is a spanning forest of the
        pairs that they allow. In a cluster every class is once, so that fine bitmaps see no pair in two blocks.
        """
        named = tiles.join(_small(roots.withColumnRenamed("node", "sid")), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        named = named.select("tile", "sid", "n", "band", "root")
        mixed = named.groupBy("tile").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("tile")
        held = self.kept(named.join(_small(self.kept(mixed, "mixed")), "tile", "left_semi"), "held")
        mark = len(self.passing)
        blocks = self.in_blocks(held, "tile", self.classes.select("sid", F.col("bitmap").alias("bits")), _forest(self.percent))
        forest = self.kept(blocks.distinct(), "forest")
        self.passed(mark)
        clusters = components(forest, "jaccard-clusters").select(F.col("node").alias("sid"), F.col("root").alias("cluster"))
        members = self.kept(held.select("sid", "n", "band", "root").distinct().join(clusters, "sid"), "members")
        fine = self.sets(members.select("sid"), fine=True).withColumnRenamed("shingles", "bits")
        return self.exact(self.kept(self.in_blocks(members, "cluster", fine, _allowed(self.percent)), "pairs"))

    def in_blocks(self, members: DataFrame, key: str, bits: DataFrame, compare: Callable) -> DataFrame:
        """``compare``'s pairs (a, b) over blocks: of each group, the classes of a band against each other and the next band's.

        A band with more than BLOCK classes makes up several columns and rows of blocks.
        """
        counts = self.kept(members.groupBy(key, "band").agg(F.count("*").alias("n")).withColumn("cuts", F.ceil(F.col("n") / BLOCK).cast("int")), "grid")
        after = counts.select(key, (F.col("band") - 1).alias("band"), F.col("cuts").alias("more"))
        before = counts.select(key, (F.col("band") + 1).alias("band"), F.col("cuts").alias("before"))
        grid = counts.join(after, [key, "band"], "left").join(before, [key, "band"], "left").where("n > 1 or more is not null or before is not null")
        grid = grid.select(key, "band", F.col("cuts").alias("rows"), F.coalesce("more", F.lit(0)).alias("more"), F.coalesce("before", F.lit(0)).alias("before"), (F.col("n") > 1).alias("several"))
        own = members.join(_small(self.kept(grid, "grid")), [key, "band"]).withColumn("cut", F.pmod(F.xxhash64("sid", F.lit(11)), F.col("rows")).cast("int"))
        # own classes against own classes of the same cut (side 2) or a later one, and against every cut of the next band
        across = F.filter(F.sequence(F.lit(0), F.col("rows") + F.col("more") - 1), lambda c: c >= F.col("cut"))
        as_row = own.where("several or more > 0").withColumn("to", F.explode(across)).withColumn("from", F.col("cut")).withColumn("side", F.when(F.col("to") == F.col("cut"), 2).otherwise(0))
        as_column = own.where("cut > 0").withColumn("from", F.explode(F.sequence(F.lit(0), F.col("cut") - 1))).withColumn("to", F.col("cut")).withColumn("side", F.lit(1))
        later = own.where("before > 0").withColumn("from", F.explode(F.sequence(F.lit(0), F.col("before") - 1)))
        as_next = later.withColumn("band", F.col("band") - 1).withColumn("to", F.col("before") + F.col("cut")).withColumn("side", F.lit(1))
        block = [key, "band", "from", "to"]
        columns = [*block, "side", "sid", "n", "root"]
        rows = as_row.select(*columns).unionAll(as_column.select(*columns)).unionAll(as_next.select(*columns)).join(bits, "sid")
        dealt = rows.repartition(*block).sortWithinPartitions(*block, "side", "sid")
        return dealt.select(*columns, "bits").mapInArrow(lambda b: frugal(_blocks(b, compare)), "a long, b long")


def _small(table: DataFrame) -> DataFrame:
    """A staged table of ids, to be broadcast if it has BROADCAST_IDS rows at most."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def _blocks(batches: Iterable[pa.RecordBatch], compare: Callable) -> Iterator[pa.RecordBatch]:
    """``compare``'s pairs of each block; blocks arrive one after the other and may go on from batch to batch."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(c)[row].as_py() for c in range(4))

    def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in range(4)])
        side, sid, n, root = (table.column(c).to_numpy() for c in ("side", "sid", "n", "root"))
        bits, n = table.column("bits").to_pylist(), n.astype(np.int64)
        edge = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True]))).tolist()
        a, b = [sid[:0]], [sid[:0]]
        for i, j in zip(edge[:-1], edge[1:], strict=True):
            if j - i > 1 and (root[i:j] != root[i]).any():
                p, q = compare(side[i:j], n[i:j], root[i:j], bits[i:j])
                a.append(sid[i:j][p])
                b.append(sid[i:j][q])
        a, b = np.concatenate(a), np.concatenate(b)
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(both[0], pa.int64()), pa.array(both[1], pa.int64())], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        last, n = key(batch, batch.num_rows - 1), batch.num_rows
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(4)])
        n = int((~(keys == np.array(last)[:, None]).all(axis=0)).sum())  # rows before the last block, which may go on
        if n or (held and key(held[0], 0) != last):
            yield from done(pa.Table.from_batches([*held, batch.slice(0, n)]).combine_chunks())
            held = [batch.slice(n)]
        else:
            held.append(batch)
    if held:
        yield from done(pa.Table.from_batches(held).combine_chunks())


def _passing(percent: int, side: np.ndarray, n: np.ndarray, root: np.ndarray, matrices: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of different components that sizes and then each of the bitmaps allow to link, rows of the block at a time."""
    x, y = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    step = max(1, PAIRS // max(1, len(y)))
    for k in range(0, len(x), step):
        i, j = (v.ravel() for v in np.meshgrid(x[k : k + step], y, indexing="ij"))
        fit = ((side[j] == 1) | ((side[i] == 2) & (i < j))) & (root[i] != root[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        for matrix in matrices:
            i, j = i[fit], j[fit]
            fit = np.ones(len(i), bool)
            part = max(1, 2 * PAIRS // matrix.shape[1])
            for at in range(0, len(i), part):
                p, q = i[at : at + part], j[at : at + part]
                fit[at : at + part] = may_link(np.bitwise_count(matrix[p] ^ matrix[q]).sum(axis=1, dtype=np.int64), n[p] + n[q], percent)
        yield i[fit], j[fit]


def _forest(percent: int) -> Callable:
    """A spanning forest of the pairs that coarse bitmaps allow."""

    def forest(side: np.ndarray, n: np.ndarray, root: np.ndarray, bits: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        label = np.arange(len(n))
        a, b = [], []
        for i, j in _passing(percent, side, n, root, [folded(bits, min(map(len, bits)))]):
            edge = [0, *(np.flatnonzero(np.diff(i)) + 1).tolist(), len(i)] if len(i) else []
            for lo, hi in itertools.pairwise(edge):
                own, theirs = i[lo], j[lo:hi]
                groups, first = np.unique(label[theirs], return_index=True)
                new = groups != label[own]
                if new.any():
                    a += [own] * int(new.sum())
                    b += theirs[first[new]].tolist()
                    label[np.isin(label, groups[new])] = label[own]
        return np.array(a, np.int64), np.array(b, np.int64)

    return forest


def _allowed(percent: int) -> Callable:
    """All pairs that fine bitmaps allow; they are folded for a first look."""

    def allowed(side: np.ndarray, n: np.ndarray, root: np.ndarray, bits: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        fine = folded(bits, min(map(len, bits)))
        coarse = np.bitwise_or.reduce(fine.reshape(len(bits), -1, max(1, fine.shape[1] // 4)), axis=1)
        found = list(_passing(percent, side, n, root, [coarse, fine])) or [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    return allowed


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, set_id, group_id, text_id): component_id is the smallest doc_id that links reach, itself included.

    set_id names the row's shingle set, group_id the component (its smallest set_id; both null for empty sets), and text_id
    is a hash of its text.
    """
    join = Join(docs, k, percent)
    total = join.meta.agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(total * (100 - percent) / 100 / RANGE))
    prefixes = filed(join.docs, _hot(join.meta), k, percent, parts)
    kind = "tile long, sid long, n int, band int, leader long"
    tiles = join.kept(prefixes.groupBy("part").applyInArrow(_tiles(percent), kind).dropDuplicates(["tile", "sid"]), "tiles")
    stars = tiles.where("sid <> leader").select(F.least("sid", "leader").alias("a"), F.greatest("sid", "leader").alias("b")).distinct()
    mark = len(join.passing)
    first = join.kept(join.linked(stars), "links")
    join.passed(mark)
    roots = join.kept(components(first, "jaccard-roots"), "roots")
    links = first.unionAll(join.kept(join.links_between(tiles, roots), "links"))
    roots = components(links, "jaccard-roots").withColumnRenamed("node", "sid")
    named = join.classes.select("sid", "doc_id").join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    lowest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = staged(named.join(lowest, "root").select("sid", "component_id", F.col("root").alias("group_id")), "jaccard-components")
    dropped(*join.passing, join.classes)
    rows = join.meta.where("hot is null").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "sid", "text_id")
    out = ["doc_id", "n_shingles", "component_id", F.col("sid").alias("set_id"), "group_id", "text_id"]
    full = rows.where("sid is not null").join(of_class, "sid").select(*out)
    empty = rows.where("sid is null").withColumn("component_id", F.col("doc_id")).withColumn("group_id", F.lit(None).cast("long"))
    return full.unionAll(empty.select(*out))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that stay when of each component a single row does: that with the smallest id.

    A row without an id stays only where no row of its component has one; between texts of the same id, and between rows
    without one, a hash of the text decides, and of rows with the same id and text any one stays. Documents without words
    all stay. Texts stay where they are unless more than BROADCAST_IDS rows go; only rows that occur twice are dealt anew.
    """
    found = near_duplicates(docs.select("doc_id", "text"), k, percent).where("group_id is not null")
    found = staged(found.groupBy("group_id", "doc_id", "text_id").agg(F.count("*").alias("rows")), "jaccard-found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id")).alias("first")
    stays = found.groupBy("group_id").agg(first).select("group_id", F.col("first.doc_id").alias("stay_id"), F.col("first.text_id").alias("stay_text"))
    judged = found.join(stays, "group_id").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("text_id") == F.col("stay_text")))
    named = [F.col("doc_id").alias("__doc"), F.col("text_id").alias("__text")]
    gone = _small(staged(judged.where("not stays").select(*named), "jaccard-gone"))
    twice = staged(judged.where("stays and rows > 1").select(*named), "jaccard-twice")
    same = lambda ids: docs["doc_id"].cast("long").eqNullSafe(ids["__doc"]) & (F.xxhash64(docs["text"]) == ids["__text"])
    left = docs.join(gone, same(gone), "left_anti")
    if not twice.limit(1).count():
        return left
    twice = _small(twice)
    once = left.join(twice, same(twice), "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(twice, same(twice), "left_anti").unionAll(once)
