import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodebar.llm import components, embedding_dedup, hnsw
from lodebar.llm.embedding_dedup import near_vectors


def brute(ids, rows, least=0.9):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float64)
        v = v / np.abs(v).max()
        return v / np.sqrt((v * v).sum())

    units = [unit(r) for r in rows]
    near = [[j for j, y in enumerate(units) if j != i and x is not None and y is not None and len(x) == len(y) and x @ y >= least] for i, x in enumerate(units)]
    root = list(range(len(rows)))
    for _ in rows:
        changed = False
        for i, js in enumerate(near):
            low = min([root[i], *(root[j] for j in js)])
            if low != root[i]:
                root[i], changed = low, True
        if not changed:
            break
    component = {}
    for i, r in enumerate(root):
        if ids[i] is not None:
            component[r] = min(component.get(r, ids[i]), ids[i])
    return sorted(((ids[i], len(near[i]), component.get(root[i])) for i in range(len(rows))), key=repr)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    rows = [rng.normal(size=16) for _ in range(150)]
    for _ in range(12):
        c = rng.normal(size=16)
        rows += [c + rng.normal(size=16) * rng.choice([0.02, 0.15, 0.4]) for _ in range(rng.integers(2, 14))]
    big = rng.normal(size=16)
    rows += [big + 0.05 * rng.normal(size=16) for _ in range(120)] + [big] * 40
    rows = [[float(np.float32(x)) for x in r] for r in rows]
    rows += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.1], [2.0] + [0.0] * 15, [5.0] + [0.0] * 15, [1e-30] + [0.0] * 15, [3e38] + [0.0] * 15]
    order = rng.permutation(len(rows))
    ids = [int(i) for i in order]
    ids[3] = None
    ids[5] = ids[4]
    return ids, rows


def test_links_agree_with_all_pairs(spark, vectors):
    ids, rows = vectors
    df = spark.createDataFrame([(i, r, 1) for i, r in zip(ids, rows, strict=True)], "vec_id long, embedding array<float>, n_links int").repartition(3)
    got = near_vectors(df, shards=3).collect()
    want = brute(ids, rows)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == want
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert near_vectors(df.limit(0)).count() == 0


def planted(background, groups, dim=48, seed=4):
    """(vectors, size of each one's group): random ones and groups of near copies, sizes given as {size: how many}."""
    rng = np.random.default_rng(seed)
    rows, sizes = [rng.normal(size=(background, dim))], [np.ones(background, int)]
    for size, n in groups.items():
        centre = rng.normal(size=(n, 1, dim))
        spread = rng.uniform(0.05, 0.42, size=(n, 1, 1))  # from nearly the same to around the bound
        rows.append((centre + spread * rng.normal(size=(n, size, dim))).reshape(-1, dim))
        sizes.append(np.full(size * n, size))
    order = rng.permutation(sum(map(len, rows)))
    return np.concatenate(rows)[order], np.concatenate(sizes)[order]


def true_links(x, least=0.9):
    x = hnsw.normalised(x)
    return np.concatenate([(x[k : k + 1000] @ x.T >= least).sum(axis=1) - 1 for k in range(0, len(x), 1000)])


def test_recall_by_group_size(spark):
    """Of planted near copies at least 0.99 of all links are found in groups of every size, and never one too many."""
    x, sizes = planted(3000, {2: 300, 5: 120, 40: 12, 500: 1})
    truth = true_links(x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = near_vectors(df).collect()
    got = np.array([r.n_links for r in sorted(rows, key=lambda r: r.vec_id)])
    assert (got <= truth).all() and truth[sizes == 1].sum() == 0
    for size in (2, 5, 40, 500):
        own = sizes == size
        assert truth[own].sum() > 0 and got[own].sum() >= 0.99 * truth[own].sum(), size


def test_a_link_counts_for_both_ends_whoever_finds_it(spark):
    classes = spark.createDataFrame([(1, 1), (2, 3), (3, 1), (4, 1)], "class long, copies long")
    shard = lambda c: F.pmod(F.col(c), F.lit(2)).cast("int")
    # 1 finds 2; 2 and 3 find each other; 4 has counted 7 in shard 1 but is found by 1 and 2, too
    found = [(2, 1, 2, 0), (2, 2, 3, 1), (2, 3, 2, 0), (0, 4, 7, 1), (2, 1, 4, 0), (2, 2, 4, 0), (1, 1, 2, 0)]
    got = embedding_dedup._links(spark.createDataFrame(found, embedding_dedup.FOUND), classes, shard)
    assert {r["class"]: r.links for r in got.collect()} == {1: 4, 2: 3, 3: 3, 4: 10}


def test_graph_survives_as_bytes_and_audits_fall_back_to_all_pairs():
    rng = np.random.default_rng(1)
    x = hnsw.normalised(rng.normal(size=(400, 8)))
    g = hnsw.Graph.loaded(hnsw.Graph.built(x).dumped())
    truth = {tuple(t) for t in np.argwhere(x @ x.T >= 0.7)}
    for layer in g.layers:
        layer.links[:] = -1  # a graph without links finds nothing until the audit gives up on it
    i, j = hnsw.within(g, x, 0.7)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == truth
    one = hnsw.Graph.built(x[:1])
    assert hnsw.within(one, x[:1], 0.9)[0].tolist() == [0]


def test_dense_groups_are_taken_in_small_batches(monkeypatch):
    """Pairs of a dense group never stand in memory together."""
    rng = np.random.default_rng(3)
    x = hnsw.normalised(np.concatenate((rng.normal(size=8) + 0.03 * rng.normal(size=(600, 8)), rng.normal(size=(300, 8)))))
    truth = {tuple(t) for t in np.argwhere(x @ x.T >= 0.9)}
    monkeypatch.setattr(hnsw, "WIDEST", 128)
    monkeypatch.setattr(hnsw, "PAIRS", 4_000)
    batches = [list(zip(i.tolist(), j.tolist(), strict=True)) for i, j in hnsw.near_pairs(hnsw.Graph.built(x), x, 0.9)]
    found = [pair for b in batches for pair in b]
    assert len(found) == len(set(found)) and set(found) <= truth and len(found) >= 0.99 * len(truth) > 300_000
    assert max(len(b) for b in batches) <= 4_000


def test_more_classes_make_more_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_QUERIES", 40)
    sizes = spark.sparkContext.accumulator(0)
    plain = embedding_dedup._query

    def counted(least):
        query = plain(least)

        def most(rows, shard):
            if rows.num_rows > 90:
                sizes.add(1)
            return query(rows, shard)

        return most

    monkeypatch.setattr(embedding_dedup, "_query", counted)
    ids, rows = vectors
    got = near_vectors(spark.createDataFrame(list(zip(ids, rows, strict=True)), "vec_id long, embedding array<float>"), shards=3).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == brute(ids, rows)
    assert sizes.value == 0


def test_united_agrees_with_one_link_at_a_time():
    rng = np.random.default_rng(2)
    p, q = rng.integers(0, 400, (2, 300))
    root, want = components.united(np.arange(400), p[:150], q[:150]), np.arange(400)
    for a, b in zip(p, q, strict=True):
        u, v = sorted((want[a], want[b]))
        want[want == v] = u
    assert components.united(root, p[150:], q[150:]).tolist() == want.tolist()
