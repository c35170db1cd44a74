"""Approximate nearest neighbours: a navigable small-world graph per shard.

A shard's graph is a hierarchy of layers, each a flat array of neighbours (one
row of a fixed width per node, -1 where there is none). Insertion and search
run for a whole batch in lockstep: each step expands the best unexpanded
candidates of all queries at once. Vectors that are equal are one node with several ids.

Inner products become cosines by an added component that gives all vectors of
a graph the same length; a query has zero there, so the order of inner products
is kept. So that this component doesn't outweigh the rest, a shard's vectors
are kept in bands of similar length, a graph each; vectors of one length are one
band. A query goes through the bands from the longest vectors on, and leaves out
those whose greatest length can't reach its kth score. Scores are computed
anew in double precision on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._vectors import searched, top, usable

WIDTH = 16
BATCH = 512
#: Lengths in a band differ by less than this factor.
BAND = 1.25


def _beam(x: np.ndarray, graph: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int, expand: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Each query's ef best nodes found (nodes, similarities; -1 and -inf where fewer), unordered."""
    n, m = len(q), graph.shape[1]
    rows = np.arange(n)[:, None]
    seen = np.zeros((n, len(x) + 1), bool)
    nodes = np.full((n, ef), -1)
    sims = np.full((n, ef), -np.inf, np.float32)
    open_ = np.zeros((n, ef), bool)
    w = min(ef, entry.shape[1])
    nodes[:, :w] = entry[:, :w]
    sims[:, :w] = np.where(entry[:, :w] >= 0, np.einsum("bmd,bd->bm", x[entry[:, :w]], q), -np.inf)
    open_[:, :w] = entry[:, :w] >= 0
    seen[rows, nodes] = True
    seen[:, -1] = True  # where -1 points
    live = np.arange(n)
    while len(live):
        r = np.arange(len(live))[:, None]
        waiting = np.where(open_[live], sims[live], -np.inf)
        pick = np.argpartition(-waiting, min(expand, ef) - 1, axis=1)[:, :expand]
        good = np.take_along_axis(waiting, pick, 1) > -np.inf
        going = good.any(1)
        if not going.all():
            live, pick, good = live[going], pick[going], good[going]
            if not len(live):
                break
            r = np.arange(len(live))[:, None]
        open_[live[:, None], pick] = False
        near = np.where(good[:, :, None], graph[nodes[live[:, None], pick]], -1).reshape(len(live), -1)
        near = np.where(seen[live[:, None], near], -1, near)
        seen[live[:, None], near] = True
        # A node may come twice, from both expanded ones.
        order = np.sort(near, axis=1)
        order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
        s = np.where(order >= 0, np.einsum("bmd,bd->bm", x[order], q[live]), -np.inf).astype(np.float32)
        all_nodes = np.concatenate([nodes[live], order], 1)
        all_sims = np.concatenate([sims[live], s], 1)
        all_open = np.concatenate([open_[live], order >= 0], 1)
        keep = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
        nodes[live], sims[live], open_[live] = all_nodes[r, keep], all_sims[r, keep], all_open[r, keep]
    return nodes, sims


def _diverse(x: np.ndarray, nodes: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
    """Per row up to width of the candidates: first those nearer to the row's point than to any already taken, then the nearest others."""
    order = np.argsort(-sims, axis=1, kind="stable")
    nodes, sims = np.take_along_axis(nodes, order, 1), np.take_along_axis(sims, order, 1)
    b, c = nodes.shape
    v = x[nodes]
    between = np.einsum("bcd,bed->bce", v, v)
    taken = np.zeros((b, c), bool)
    closest = np.full((b, c), -np.inf, np.float32)
    for j in range(c):
        ok = (nodes[:, j] >= 0) & (closest[:, j] < sims[:, j]) & (taken.sum(1) < width)
        taken[:, j] = ok
        closest = np.where(ok[:, None], np.maximum(closest, between[:, j]), closest)
    rank = np.argsort(np.where(taken, 0, np.where(nodes >= 0, 1, 2)), axis=1, kind="stable")[:, :width]
    out = np.take_along_axis(nodes, rank, 1)
    if c < width:
        out = np.pad(out, ((0, 0), (0, width - c)), constant_values=-1)
    return out


class Graph:
    def __init__(self, x: np.ndarray, layers: list[np.ndarray], entry: int):
        self.x, self.layers, self.entry = x, layers, entry

    @classmethod
    def build(cls, x: np.ndarray, width: int = WIDTH, ef: int = 64, seed: int = 7) -> Graph:
        n = len(x)
        level = np.minimum((-np.log(np.random.default_rng(seed).random(n) + 1e-12) / np.log(width)).astype(int), 8)
        layers: list[np.ndarray] = []
        g = cls(x, layers, 0)
        # From the top: each layer's members are inserted with the layers above to descend by.
        top_level = int(level.max()) if n else 0
        g.entry = int(np.argmax(level)) if n else 0
        for at in range(top_level, -1, -1):
            members = np.flatnonzero(level >= at)
            members = np.r_[g.entry, members[members != g.entry]]
            m = width * (2 if at == 0 else 1)
            graph = np.full((n + 1, m), -1, np.int32)  # the last row is where -1 points
            done = 1
            while done < len(members):
                batch = members[done : done + min(BATCH, done)]
                nodes, sims = _beam(x, graph, x[batch], g.descend(x[batch]), min(ef, max(done, 2)))
                # Points that come together may be each other's neighbours.
                own = x[batch] @ x[batch].T
                np.fill_diagonal(own, -np.inf)
                k = min(width, len(batch) - 1)
                if k:
                    near = np.argpartition(-own, k - 1, axis=1)[:, :k]
                    nodes = np.concatenate([nodes, batch[near]], 1)
                    sims = np.concatenate([sims, np.take_along_axis(own, near, 1)], 1)
                chosen = _diverse(x, nodes, sims, width)
                graph[batch, : chosen.shape[1]] = chosen
                g._back(graph, batch, chosen)
                done += len(batch)
            layers.insert(0, graph)
        return g

    def _back(self, graph: np.ndarray, batch: np.ndarray, chosen: np.ndarray) -> None:
        """The chosen neighbours get the batch's nodes as neighbours too; full rows keep a diverse choice."""
        src, dst = np.repeat(batch, chosen.shape[1]), chosen.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        first = np.flatnonzero(np.r_[True, dst[1:] != dst[:-1]])
        owners, counts = dst[first], np.diff(np.r_[first, len(dst)])
        m = graph.shape[1]
        # Rows of the same padded width go together, so a popular node doesn't widen all.
        for lo, hi in ((1, m), (m + 1, 4 * m), (4 * m + 1, BATCH * m)):
            sel = np.flatnonzero((counts >= lo) & (counts <= hi))
            for part in np.array_split(sel, max(1, len(sel) // BATCH)):
                if not len(part):
                    continue
                wide = counts[part].max()
                new = np.full((len(part), wide), -1)
                for i, p in enumerate(part):
                    new[i, : counts[p]] = src[first[p] : first[p] + counts[p]]
                both = np.sort(np.concatenate([graph[owners[part]], new], 1), axis=1)
                both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
                s = np.where(both >= 0, np.einsum("bcd,bd->bc", self.x[both], self.x[owners[part]]), -np.inf)
                few = min(both.shape[1], 2 * m)
                keep = np.argpartition(-s, few - 1, axis=1)[:, :few]
                graph[owners[part]] = _diverse(self.x, np.take_along_axis(both, keep, 1), np.take_along_axis(s, keep, 1), m)

    def descend(self, q: np.ndarray) -> np.ndarray:
        """Entry points for the layer below those that exist, one or more per query."""
        at = np.full((len(q), 1), self.entry)
        for graph in reversed(self.layers):
            nodes, sims = _beam(self.x, graph, q, at, 4)
            at = np.take_along_axis(nodes, np.argsort(-sims, axis=1), 1)
        return at

    def search(self, q: np.ndarray, ef: int) -> np.ndarray:
        """Each query's ef best nodes found, -1 where there are fewer."""
        upper = Graph(self.x, self.layers[1:], self.entry)
        return _beam(self.x, self.layers[0], q, upper.descend(q), ef)[0]


def _levelled(v: np.ndarray) -> np.ndarray:
    """Vectors scaled to a longest of 1, with the component that makes all equally long."""
    norms = np.sqrt(((v / max(np.abs(v).max(), 1e-300)) ** 2).sum(1))
    scaled = v / max(np.abs(v).max(), 1e-300) / norms.max()
    rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(1)))
    return np.concatenate([scaled, rest[:, None]], 1).astype(np.float32)


def _length(v: np.ndarray) -> np.ndarray:
    """Lengths of rows, without overflow."""
    most = np.maximum(np.abs(v).max(1), 1e-300)
    return most * np.sqrt(((v / most[:, None]) ** 2).sum(1))


def build_index(ids: np.ndarray, v: np.ndarray, width: int = WIDTH, ef: int = 64) -> dict:
    """The shard as bands, the longest vectors first; each has flat arrays: distinct vectors, ids by node, neighbours by layer."""
    distinct, node = np.unique(v, axis=0, return_inverse=True)
    node = node.ravel()
    lengths = _length(distinct)
    band = np.floor(np.log(lengths.max() / lengths) / np.log(BAND) + 1e-6).astype(np.int64)
    bands = []
    for i in np.unique(band):
        own = np.flatnonzero(band == i)
        rank = np.full(len(distinct), -1)
        rank[own] = np.arange(len(own))
        rows = np.flatnonzero(rank[node] >= 0)
        rows = rows[np.lexsort((ids[rows], rank[node[rows]]))]
        levelled = _levelled(distinct[own])
        g = Graph.build(levelled, width, ef)
        bands.append({"v": distinct[own], "levelled": levelled, "ids": ids[rows], "starts": np.searchsorted(rank[node[rows]], np.arange(len(own) + 1)), "entry": g.entry, "layers": g.layers, "longest": lengths[own].max()})
    return {"bands": bands}


def search_index(index: dict, queries: dict, k: int, ef: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, vector ids, scores): each query's k nearest found, itself excepted."""
    for b in range(0, len(queries["ids"]), BATCH):
        own, q = queries["ids"][b : b + BATCH], queries["v"][b : b + BATCH]
        unit = q / np.maximum(np.abs(q).max(1, keepdims=True), 1e-300)
        flat = np.concatenate([unit, np.zeros((len(q), 1))], 1).astype(np.float32)
        lengths, worst = _length(q), np.full(len(q), -np.inf)
        scores, found = [np.empty(0)] * len(q), [np.empty(0, np.int64)] * len(q)
        for band in index["bands"]:
            at = np.flatnonzero(lengths * band["longest"] * (1 + 1e-9) >= worst)
            if not len(at):
                break
            v, ids, starts = band["v"], band["ids"], band["starts"]
            g = Graph(band["levelled"], band["layers"], band["entry"])
            for i, nodes in zip(at, g.search(flat[at], max(ef, k + 1))):
                nodes = nodes[nodes >= 0]
                near = (v[nodes] * q[i]).sum(1)
                # A node's k + 1 smallest ids are enough, one of which may be the query's own.
                some = [ids[starts[n] : min(starts[n + 1], starts[n] + k + 1)] for n in nodes]
                s, c = np.repeat(near, [len(x) for x in some]), np.concatenate(some)
                s, c = np.concatenate([scores[i], s[c != own[i]]]), np.concatenate([found[i], c[c != own[i]]])
                best = top(c, s, k)
                scores[i], found[i] = s[best], c[best]
                if len(best) == k:
                    worst[i] = s[best][-1]
        yield np.repeat(own, [len(x) for x in found]), np.concatenate(found), np.concatenate(scores)


def nearest(table: DataFrame, k: int = 20, every: int = 20, ef: int = 128, shard_rows: int = 16384, block_rows: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose id is divisible by `every`, the k nearest found by inner product.

    Every row but the query's own is a candidate; vectors of another length
    aren't. Null ids, null, zero or empty vectors and those with null or
    non-finite components take no part; rows that repeat an id count once, with the
    smallest vector. Ties go to the smaller id. A query without candidates, and an
    empty table, give no rows. Other columns are ignored.
    """
    vectors = usable(table, id_col, vector_col, zero=False)
    queries = vectors.where(F.pmod("vec_id", F.lit(every)) == 0)

    def search(index, block, k):
        return search_index(index, block, k, ef)

    return searched(vectors, queries, k, shard_rows, block_rows, build_index, lambda ids, v: {"ids": ids, "v": v}, search, "double")
