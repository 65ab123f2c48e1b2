"""Hierarchical navigable small-world graphs (Malkov and Yashunin, 2018) over arrays, for one shard of vectors.

Insertion and search take many vectors at a time: each step expands the best open nodes of every beam at once. Layers are
built from the top; in each, nodes of higher layers come first, so entries found above are always there already.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

M = 12
#: Links of a node on the lowest layer.
M0 = 24
BUILD_BEAM = 48
#: Further places for links that tie nodes to close ones, and the ties that each node gets.
SPARE, TIES = 12, 2
#: The widest beam that an audit may ask for.
WIDEST = 1024
#: Pairs that are looked at together.
PAIRS = 1 << 21
#: Open nodes of a beam that one step expands.
AT_ONCE = 4


def normalised(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


@dataclass
class Layer:
    nodes: np.ndarray  # in order of insertion
    links: np.ndarray  # a row for each vector of the shard, filled up with -1


@dataclass
class Graph:
    exact: np.ndarray  # unit vectors in double precision
    layers: list[Layer] = field(default_factory=list)  # from the top

    def __post_init__(self) -> None:
        self.v = self.exact.astype(np.float32)

    # ---- search

    def beams(self, queries: np.ndarray, layer: Layer, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes of a layer for each query, best first, and their cosines; -1 and -2 fill up."""
        q, n = len(queries), len(self.v)
        ids, sims = np.full((q, width), -1, np.int32), np.full((q, width), -2, np.float32)
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True  # where -1 points
        rows = np.arange(q)
        ids[:, 0], sims[:, 0] = entry, (self.v[entry] * queries).sum(axis=1)
        seen[rows, entry] = True
        open_ = np.zeros((q, width), bool)
        open_[:, 0] = True
        live = rows
        while len(live):
            order = np.argsort(~open_[live], axis=1, kind="stable")[:, : min(AT_ONCE, width)]  # beams are sorted: the best open ones
            chosen = np.where(np.take_along_axis(open_[live], order, 1), np.take_along_axis(ids[live], order, 1), -1)
            open_[live[:, None], order] = False
            near = np.where(chosen[:, :, None] >= 0, layer.links[chosen], -1).reshape(len(live), -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[live[:, None], near]] = -1
            seen[live[:, None], near] = True
            found = np.einsum("qd,qmd->qm", queries[live], self.v[near])
            found[near < 0] = -2
            all_ids, all_sims = np.concatenate((ids[live], near), axis=1), np.concatenate((sims[live], found), axis=1)
            all_open = np.concatenate((open_[live], near >= 0), axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            ids[live], sims[live] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_sims, best, 1)
            open_[live] = np.take_along_axis(all_open, best, 1)
            live = live[open_[live].any(axis=1)]
        return ids, sims

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        queries = queries.astype(np.float32)
        entry = np.full(len(queries), self.layers[0].nodes[0])
        for layer in self.layers[:-1]:
            entry = self.beams(queries, layer, entry, 4)[0][:, 0]
        return self.beams(queries, self.layers[-1], entry, width)

    # ---- building

    def _chosen(self, of: np.ndarray, candidates: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates (best first) those closer to the node than to any chosen before, then the best others."""
        vectors = self.v[candidates]
        between = np.einsum("nad,nbd->nab", vectors, vectors)
        taken = np.zeros(candidates.shape, bool)
        closest = np.full(candidates.shape, -2, np.float32)
        for k in range(candidates.shape[1]):
            ok = (candidates[:, k] >= 0) & (sims[:, k] > closest[:, k]) & (taken.sum(axis=1) < most)
            taken[:, k] = ok
            closest = np.where(ok[:, None], np.maximum(closest, between[:, k]), closest)
        rank = np.argsort(np.where(taken, 0, np.where(candidates >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
        return np.take_along_axis(candidates, rank, 1)

    def _insert(self, layer: Layer, new: np.ndarray, entry: np.ndarray | None, before: np.ndarray, most: int) -> None:
        """Links ``new`` nodes with those ``before`` and with each other."""
        q = self.v[new]
        near = self.beams(q, layer, entry, BUILD_BEAM)[0] if entry is not None else np.zeros((len(new), 0), np.int32)
        own = q @ q.T
        np.fill_diagonal(own, -2)
        k = min(BUILD_BEAM, len(new) - 1)
        inner = np.argpartition(-own, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(new), 0), int)
        both = np.concatenate((near, new[inner].astype(np.int32)), axis=1)
        self._link(layer, new, both, most)

    def _link(self, layer: Layer, of: np.ndarray, candidates: np.ndarray, most: int) -> None:
        if not candidates.shape[1]:
            return
        sims = np.einsum("nd,nkd->nk", self.v[of], self.v[candidates])
        sims[candidates < 0] = -2
        order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
        candidates, sims = np.take_along_axis(candidates, order, 1), np.take_along_axis(sims, order, 1)
        picked = self._chosen(of, candidates, sims, most)
        layer.links[of, : picked.shape[1]] = picked
        # back: the nodes that were picked choose anew among their links and those that picked them, the closest first
        target, source = picked.ravel(), np.repeat(of, picked.shape[1])
        source, target = source[target >= 0], target[target >= 0]
        back = (self.v[source] * self.v[target]).sum(axis=1)
        order = np.lexsort((-back, target))
        source, target = source[order], target[order]
        first = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1]))) if len(target) else np.zeros(0, int)
        count = np.diff(np.concatenate((first, [len(target)])))
        place = np.arange(len(target)) - np.repeat(first, count)
        nodes = target[first]
        extra = np.full((len(nodes), 2 * most), -1, np.int32)
        fits = place < 2 * most
        extra[np.repeat(np.arange(len(nodes)), count)[fits], place[fits]] = source[fits]
        merged = np.concatenate((layer.links[nodes], extra), axis=1)
        merged.sort(axis=1)
        merged[:, 1:][merged[:, 1:] == merged[:, :-1]] = -1
        for at in range(0, len(nodes), 512):
            part, own = nodes[at : at + 512], merged[at : at + 512]
            sims = np.einsum("nd,nkd->nk", self.v[part], self.v[own])
            sims[own < 0] = -2
            order = np.argsort(-sims, axis=1, kind="stable")
            chosen = self._chosen(part, np.take_along_axis(own, order, 1), np.take_along_axis(sims, order, 1), most)
            layer.links[part] = -1
            layer.links[part, : chosen.shape[1]] = chosen

    @classmethod
    def built(cls, vectors: np.ndarray, batch: int = 256) -> Graph:
        """vectors: unit rows. Levels are drawn by place, so the same rows give the same graph."""
        graph, n = cls(vectors), len(vectors)
        drawn = np.random.Generator(np.random.PCG64(n)).random(n)
        level = np.floor(-np.log(np.maximum(drawn, 1e-12)) / np.log(M)).astype(int)
        order = np.argsort(-level, kind="stable")
        for top in range(level.max(), -1, -1):
            nodes = order[: (level >= top).sum()].astype(np.int32)
            if top and len(nodes) < M:
                continue
            most = M if top else M0
            layer = Layer(nodes, np.full((n, most), -1, np.int32))
            at = 0
            while at < len(nodes):
                new = nodes[at : at + (min(batch, at) if at else batch)]
                entry = None
                if at:
                    entry = np.full(len(new), (graph.layers[0] if graph.layers else layer).nodes[0])
                    for upper in graph.layers:
                        entry = graph.beams(graph.v[new], upper, entry, 4)[0][:, 0]
                    inside = np.zeros(n, bool)  # an entry above may be a node of this batch
                    inside[nodes[:at]] = True
                    entry = np.where(inside[entry], entry, nodes[0])
                graph._insert(layer, new, entry, nodes[:at], most)
                at += len(new)
            graph.layers.append(layer)
        graph._tie(graph.layers[-1])
        return graph

    def _tie(self, layer: Layer) -> None:
        """Gives every node links from TIES of its closest neighbours, so that none of a dense group is out of reach."""
        n, most = layer.links.shape
        links = np.concatenate((layer.links, np.full((n, SPARE), -1, np.int32)), axis=1)
        used = np.zeros(n, int)
        missing = np.full(n, TIES)
        for k in range(most):  # ask the closest neighbour first, then the next while places are taken
            ask = np.flatnonzero((missing > 0) & (layer.links[:, k] >= 0))
            of = layer.links[ask, k]
            tied = (links[of] == ask[:, None]).any(axis=1)
            missing[ask[tied]] -= 1
            ask, of = ask[~tied], of[~tied]
            order = np.argsort(of, kind="stable")
            ask, of = ask[order], of[order]
            first = np.searchsorted(of, of)
            place = used[of] + np.arange(len(of)) - first
            fits = place < SPARE
            links[of[fits], most + place[fits]] = ask[fits]
            np.add.at(used, of[fits], 1)
            missing[ask[fits]] -= 1
        layer.links = links

    # ---- as bytes

    def dumped(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, exact=self.exact, **{f"nodes{i}": x.nodes for i, x in enumerate(self.layers)}, **{f"links{i}": x.links for i, x in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def loaded(cls, raw: bytes) -> Graph:
        got = np.load(io.BytesIO(raw))
        return cls(got["exact"], [Layer(got[f"nodes{i}"], got[f"links{i}"]) for i in range((len(got.files) - 1) // 2)])


def within(graph: Graph, queries: np.ndarray, least: float, width: int = 64, audit: int = 192, recall: float = 0.995) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of all pairs that ``near_pairs`` yields."""
    parts = list(near_pairs(graph, queries, least, width, audit, recall))
    none = np.zeros(0, int)
    return np.concatenate([none, *(i for i, _ in parts)]), np.concatenate([none, *(j for _, j in parts)])


def near_pairs(graph: Graph, queries: np.ndarray, least: float, width: int = 64, audit: int = 192, recall: float = 0.995) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) of pairs found with a cosine of ``least`` or more in double precision, PAIRS at most at a time or a query's.

    A beam half of which are such nodes is widened for its query; one that is full at WIDEST is in a dense group, and its
    query is compared with all vectors. An audit compares ``audit`` of the queries, evenly spaced, with all vectors of the
    shard; while it misses too much, of all pairs or of the mean query's own, all beams are widened: neither dense groups nor
    queries with a single neighbour hide what the others miss. If that still doesn't help at WIDEST, all queries are compared
    with all vectors. A query's pairs come together.
    """
    n = len(graph.v)
    checked = np.linspace(0, len(queries) - 1, min(audit, len(queries))).astype(int)
    truth = np.concatenate([(graph.exact @ queries[checked[k : k + 16]].T >= least).sum(axis=0) for k in range(0, len(checked), 16)] or [np.zeros(0, int)])
    size = max(8, min(256, (64 << 20) // (n + 1)))

    def compared(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, PAIRS // n)
        for at in range(0, len(rows), step):
            i, j = np.nonzero(queries[rows[at : at + step]] @ graph.exact.T >= least)
            yield rows[at + i], j

    def run(rows: np.ndarray, w: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        again = []
        step = max(1, min(size, PAIRS // w))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            ids, sims = graph.search(queries[part], min(w, n))
            close = (ids >= 0) & (sims >= least - 1e-4)
            full = (2 * close.sum(axis=1) > w) & (w < n)
            again.append(part[full])
            i, j = np.nonzero(close & ~full[:, None])
            a, b = part[i], ids[i, j]
            ok = np.concatenate([np.einsum("nd,nd->n", queries[a[k : k + 65536]], graph.exact[b[k : k + 65536]]) >= least for k in range(0, len(a), 65536)] or [np.zeros(0, bool)])
            yield a[ok], b[ok]
        rest = np.concatenate(again) if again else rows[:0]
        if len(rest):
            yield from run(rest, 2 * w) if 2 * w <= WIDEST else compared(rest)

    def misses() -> bool:
        found = np.zeros(len(checked), int)
        for i, _ in run(checked, width):
            np.add.at(found, np.searchsorted(checked, i), 1)
        some = truth > 0
        return bool(some.any()) and min(found.sum() / truth.sum(), (found[some] / truth[some]).mean()) < recall

    while misses():
        width *= 2
        if width > min(n, WIDEST):
            yield from compared(np.arange(len(queries)))
            return
    yield from run(np.arange(len(queries)), width)
