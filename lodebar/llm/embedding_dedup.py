"""Near-duplicate vectors by cosine: an HNSW graph per shard, every shard queried, pairs verified, components united.

Equal vectors are one class. Classes are dealt by hash into shards, as many as there are or as MAX_SHARD asks for; each
task builds one shard's graph. Every class then queries every shard, in blocks of BLOCK_QUERIES or so. A pair counts only
if its cosine in double precision reaches the bound. Pairs are taken a batch at a time and united, and a block reports a
link to one other for each class that has any. A class with up to FEW links in a shard reports them, so that a link counts
for both ends whichever of them has found it; of more, only their number is reported. Neither a block's memory nor its answer
grows with the pairs of a dense group.

Defined results: vectors that are null, empty, zero, or hold nulls or values that aren't finite link with nothing; so do
vectors of different lengths with each other. Such a row has 0 links and is its own component. A null id never names a
component and isn't kept. Repeated rows link with each other. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodebar.llm.common import returned, staged
from lodebar.llm.components import components, united
from lodebar.llm.hnsw import Graph, near_pairs, normalised

#: Vectors in a shard at most; with 64 dimensions such a shard takes about 200 MB.
MAX_SHARD = 200_000
#: Classes that query a shard in one task; their vectors of 64 dimensions take about 50 MB.
BLOCK_QUERIES = 50_000
#: Classes whose results are broadcast to their rows; more are joined by a shuffle.
BROADCAST_CLASSES = 1_000_000

#: Links of a class in a shard that are reported one by one.
FEW = 32

FOUND = "kind int, x long, y long, shard int"
#: What a row of FOUND is: a class and the number of its links; two tied classes; two linked classes.
COUNT, TIE, PAIR = range(3)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _build(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("class")
    graph = Graph.built(normalised(_matrix(rows.column("embedding"))))
    return pa.table(
        {
            "dim": rows.column("dim").slice(0, 1),
            "shard": rows.column("shard").slice(0, 1),
            "graph": pa.array([graph.dumped()], pa.binary()),
            "classes": pa.array([rows.column("class").to_numpy().astype(np.int64).tobytes()], pa.binary()),
            "copies": pa.array([rows.column("copies").to_numpy().astype(np.int64).tobytes()], pa.binary()),
        }
    )


def _query(least: float):  # noqa: ANN202
    def query(rows: pa.Table, shard: pa.Table) -> pa.Table:
        nothing = np.zeros(0, np.int64)
        parts: list[tuple[int, np.ndarray, np.ndarray]] = [(0, nothing, nothing)]
        number = 0
        if rows.num_rows and shard.num_rows:
            number = shard.column("shard")[0].as_py()
            graph = Graph.loaded(shard.column("graph")[0].as_py())
            theirs, copies = (np.frombuffer(shard.column(c)[0].as_py(), np.int64) for c in ("classes", "copies"))
            own = rows.column("class").to_numpy()
            ids, ends = np.unique(np.concatenate((own, theirs)), return_inverse=True)
            asking, asked = ends[: len(own)], ends[len(own) :]
            links, root = np.zeros(len(own), np.int64), np.arange(len(ids))
            for i, j in near_pairs(graph, normalised(_matrix(rows.column("embedding"))), least):
                other = own[i] != theirs[j]
                i, j = i[other], j[other]
                few = np.bincount(i, minlength=len(own))[i] <= FEW
                parts.append((PAIR, own[i[few]], theirs[j[few]]))
                np.add.at(links, i[~few], copies[j[~few]])
                root = united(root, asking[i], asked[j])
            below, counted = np.flatnonzero(root != np.arange(len(ids))), np.flatnonzero(links)
            parts += [(TIE, ids[below], ids[root[below]]), (COUNT, own[counted], links[counted])]
        table = pa.table(
            {
                "kind": pa.array(np.concatenate([np.full(len(x), k) for k, x, _ in parts]), pa.int32()),
                "x": pa.array(np.concatenate([x for _, x, _ in parts]), pa.int64()),
                "y": pa.array(np.concatenate([y for _, _, y in parts]), pa.int64()),
            }
        )
        returned()
        return table.append_column("shard", pa.array(np.full(table.num_rows, number), pa.int32()))

    return query


def _links(found: DataFrame, classes: DataFrame, shard: Callable[[str], Column]) -> DataFrame:
    """(class, links): pairs count both ways, whichever side has found them; classes with more than FEW links in a shard have counted those."""
    pairs, counted = found.where(F.col("kind") == PAIR), found.where(F.col("kind") == COUNT)
    both = pairs.select("x", "y").unionAll(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct().withColumn("shard", shard("y"))
    alone = both.join(counted.select("x", "shard"), ["x", "shard"], "left_anti").join(classes.select(F.col("class").alias("y"), "copies"), "y")
    every = alone.select("x", F.col("copies").alias("links")).unionAll(counted.select("x", F.col("y").alias("links")))
    return every.groupBy(F.col("x").alias("class")).agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, least: float = 0.9, shards: int = 6, blocks: int = 2) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding)."""
    good = F.expr("size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.withColumn("class", F.when(F.coalesce(good, F.lit(False)), F.xxhash64("embedding")))
    classes = rows.where("class is not null").groupBy("class").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    classes = staged(classes.withColumn("dim", F.size("embedding")), "vectors")
    most = classes.groupBy("dim").count().agg(F.max("count")).first()[0] or 0
    shards = max(shards, -(-most // MAX_SHARD))
    blocks = max(blocks, -(-most // BLOCK_QUERIES))
    ready = classes.select("class", "copies", "dim", "embedding")
    shard_of = lambda c: F.pmod(F.xxhash64(c, F.lit(1)), F.lit(shards)).cast("int")
    dealt = ready.withColumn("shard", shard_of("class"))
    kind = "dim int, shard int, graph binary, classes binary, copies binary"
    graphs = staged(dealt.groupBy("dim", "shard").applyInArrow(_build, kind), "graphs")
    graphs = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    block = F.pmod(F.xxhash64("class", F.lit(2)), F.lit(blocks)).cast("int")
    asked = ready.select("class", "dim", "embedding", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    key = ["dim", "shard", "block"]
    found = staged(asked.groupBy(*key).cogroup(graphs.groupBy(*key)).applyInArrow(_query(least), FOUND), "vector-links")
    links = _links(found, classes, shard_of)
    ties = found.where(F.col("kind") == TIE).select(F.col("x").alias("a"), F.col("y").alias("b"))
    roots = components(ties, "vector-roots").withColumnRenamed("node", "class")
    named = classes.select("class", "first", "copies").join(roots, "class", "left").join(links, "class", "left").withColumn("root", F.coalesce("root", "class"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    result = staged(named.join(lowest, "root").select("class", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-components")
    if result.count() <= BROADCAST_CLASSES:
        result = F.broadcast(result)
    linked = rows.where("class is not null").join(result, "class").select("vec_id", "n_links", "component_id")
    alone = rows.where("class is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.unionAll(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
