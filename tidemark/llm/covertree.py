"""Exact top-k inner products by a dual-tree search over cover trees.

Candidates and queries are both indexed by a cover tree: a node covers its points
within its radius, and its children's centres lie further apart than the next
smaller radius. Each group of queries first goes greedily down the candidates'
tree, so that all have a kth score to begin with. Then both trees are gone down
together: for centres p of a query node and c of a data node with covering
radii r and s, no product exceeds p.c + |p|s + r|c| + rs, nor what the greatest
lengths and the least distance between the two balls allow; a pair of nodes
is dropped when that is under the worst kth score among the node's queries.
Of what is left, the most promising nodes come first.

Whole-number scores that doubles hold exactly are compared as they are; others by
bounds that include the rounding, and what lies within it is scored anew in
whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._vectors import searched, top, usable

BASE = 1.5
#: Points of a candidate leaf; a query leaf has one.
LEAF = 8
CHUNK = 512
GROUP = 256
SEEDS = 64
SCALE = 256


def _distances(x: np.ndarray, c: int, points: np.ndarray) -> np.ndarray:
    return np.sqrt(((x[points] - x[c]) ** 2).sum(1))


def _covered(x: np.ndarray, c: int, points: np.ndarray, reach: float) -> list[tuple[int, np.ndarray]]:
    """Centres among the points, c first, each further than reach from all before it, with the points that each is the first to cover."""
    groups = [(c, points[_distances(x, c, points) <= reach])]
    rest = points[_distances(x, c, points) > reach]
    norms = (x**2).sum(1)
    while len(rest):
        few = rest[:GROUP]
        near = norms[few][:, None] + norms[few] - 2 * (x[few] @ x[few].T) <= reach * reach
        np.fill_diagonal(near, True)
        own, taken = [], np.zeros(len(few), bool)
        for i in range(len(few)):
            if not taken[i]:
                own.append(i)
                taken |= near[i]
        centres = few[own]
        within = norms[rest][:, None] + norms[centres] - 2 * (x[rest] @ x[centres].T) <= reach * reach
        within[own, np.arange(len(own))] = True
        first = np.where(within.any(1), within.argmax(1), -1)
        order = np.argsort(first, kind="stable")
        ends = np.searchsorted(first[order], np.arange(-1, len(own)), side="right")
        groups += [(int(centre), rest[order[ends[i] : ends[i + 1]]]) for i, centre in enumerate(centres)]
        rest = rest[np.sort(order[: ends[0]])]
    return [(centre, members) for centre, members in groups if len(members)]


def build_tree(x: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Flat arrays by node: centre (a point), covering radius, greatest length, first and last child, first and last place in order; order: the points by leaf."""
    centre, radius, kids, members = [], [], [], []
    # Breadth first, so that a node's children are neighbours in the arrays.
    queue = [(0, np.arange(len(x)))] if len(x) else []
    for c, points in queue:
        centre.append(c)
        radius.append(float(_distances(x, c, points).max()))
        members.append(points)
        kids.append((0, 0))
        if len(points) > leaf and radius[-1] > 0:
            groups = _covered(x, c, points, radius[-1] / BASE)
            kids[-1] = (len(queue), len(queue) + len(groups))
            queue.extend(groups)
    spans, order, lengths = [(0, 0)] * len(centre), [], np.sqrt((x**2).sum(1))
    stack, begin = [(0, False)] if len(x) else [], {}
    while stack:
        i, after = stack.pop()
        if after:
            spans[i] = (begin[i], len(order))
            continue
        begin[i] = len(order)
        stack.append((i, True))
        if kids[i][0] == kids[i][1]:
            order.extend(members[i].tolist())
        stack.extend((j, False) for j in range(*kids[i]))
    longest = [float(lengths[m].max()) for m in members]
    return {
        "centre": np.array(centre, np.int64), "radius": np.array(radius), "longest": np.array(longest), "kids": np.array(kids, np.int64).reshape(-1, 2),
        "spans": np.array(spans, np.int64).reshape(-1, 2), "order": np.array(order, np.int64),
    }


def index(ids: np.ndarray, v: np.ndarray, leaf: int = LEAF) -> dict:
    """The tree of floor(256 v) with the ids; large vectors are scaled down by a power of two, shift, so that no square overflows."""
    shift = max(0, math.frexp(float(np.abs(v).max(initial=0)))[1] - 40)
    x = np.floor(v * SCALE) if shift == 0 else np.ldexp(v, 8 - shift)
    return {"ids": ids, "x": x, "v": v, "shift": shift, **build_tree(x, leaf)}


def _whole(v: np.ndarray) -> list[int]:
    """floor(256 v) as whole numbers of any size."""
    return [math.floor(c * SCALE) if abs(c) < 2**45 else int(c) * SCALE for c in v.tolist()]


def _children(tree: dict, nodes: np.ndarray) -> np.ndarray:
    first, last = tree["kids"][nodes].T
    return np.concatenate([np.arange(a, b) for a, b in zip(first, last)]) if len(nodes) else nodes


class _Best:
    """Each query's best so far; with a margin, all whose score lies within the rounding of the kth."""

    def __init__(self, queries: int, k: int, margin: np.ndarray):
        self.k, self.margin = k, margin
        self.worst = np.full(queries, -np.inf)
        self.scores, self.at = [np.empty(0)] * queries, [np.empty(0, np.int64)] * queries

    def add(self, o: int, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates (places, scores) for the query o; those that it has already count once."""
        good = scores >= self.worst[o] - self.margin[o]
        at, scores = at[good], scores[good]
        if len(self.at[o]):
            new = ~np.isin(at, self.at[o])
            at, scores = np.concatenate([self.at[o], at[new]]), np.concatenate([self.scores[o], scores[new]])
        if len(at) > self.k:
            keep = top(ids[at], scores, self.k)
            if self.margin[o]:
                keep = np.flatnonzero(scores >= scores[keep[-1]] - self.margin[o])
            at, scores = at[keep], scores[keep]
        self.at[o], self.scores[o] = at, scores
        if len(at) >= self.k:
            self.worst[o] = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]


def dual_search(data: dict, queries: dict, k: int, stats: Counter | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, vector ids, scores) of each query's k best of the data tree, itself excepted. stats counts what was computed and cut."""
    x, q, ids = data["x"], queries["x"], data["ids"]
    stats = Counter() if stats is None else stats
    if not len(q) or not len(x):
        return
    x_norm, q_norm = np.sqrt((x**2).sum(1)), np.sqrt((q**2).sum(1))
    largest = np.abs(x).max() * np.abs(q).max() * x.shape[1]
    exact = largest < 2**53 and not data["shift"] and not queries["shift"]
    margin = np.zeros(len(q)) if exact else (q_norm + 1) * (x_norm.max() + 1) * 1e-9
    # The range of a long, in the scale of the products.
    cap = np.inf if exact else math.ldexp(1.0, 63 - data["shift"] - queries["shift"])
    best = _Best(len(q), k, margin)
    # Where each query's own vector is among the data, if it is.
    place = np.searchsorted(ids, queries["ids"])
    place = np.where((place < len(ids)) & (ids[np.minimum(place, len(ids) - 1)] == queries["ids"]), place, -1)
    leaf, sizes = data["kids"][:, 0] == data["kids"][:, 1], data["spans"][:, 1] - data["spans"][:, 0]

    def points_of(nodes: np.ndarray) -> np.ndarray:
        return data["order"][np.concatenate([np.arange(*data["spans"][n]) for n in nodes])]

    def keep(group: np.ndarray, points: np.ndarray, scores: np.ndarray) -> None:
        for o, row in zip(group, np.clip(scores, -cap, cap)):
            good = np.flatnonzero((row >= best.worst[o] - margin[o]) & (points != place[o]))
            if len(good):
                best.add(o, points[good], row[good], ids)

    def score(group: np.ndarray, points: np.ndarray) -> None:
        stats["products"] += len(group) * len(points)
        keep(group, points, q[group] @ x[points].T)

    def limits(products: np.ndarray, q_len, c_len, r, s, longest_q, longest_x) -> np.ndarray:
        """No product of a point within r of a centre and one within s of another exceeds this."""
        straight = products + q_len * s + r * c_len + r * s
        apart = np.sqrt(np.maximum(q_len**2 + c_len**2 - 2 * products, 0)) * (1 - 1e-6) - r - s
        by_distance = (longest_q**2 + longest_x**2 - np.maximum(apart, 0) ** 2) / 2
        b = np.minimum(np.minimum(straight, by_distance), longest_q * longest_x)
        return b + 1e-6 * (np.abs(b) + longest_q * longest_x) * 1e-3 + 1e-9

    def seed(group: np.ndarray) -> None:
        """A way down by the child whose centre the group's first query likes best, to the last node that holds enough points."""
        node = 0
        while not leaf[node]:
            children = np.arange(*data["kids"][node])
            children = children[sizes[children] > k]
            if not len(children):
                break
            stats["products"] += len(children)
            node = int(children[np.argmax(x[data["centre"][children]] @ q[group[0]])])
        score(group, points_of(np.array([node]))[:SEEDS])

    def met(group: np.ndarray, nodes: np.ndarray, radius=0.0, longest=None) -> tuple[np.ndarray, np.ndarray]:
        """Products of the group's queries (or of centres with a radius) and the nodes' centres, and their limits."""
        c = data["centre"][nodes]
        stats["products"] += len(group) * len(nodes)
        products, own = q[group] @ x[c].T, q_norm[group][:, None]
        return products, limits(products, own, x_norm[c], radius, data["radius"][nodes], own if longest is None else longest, data["longest"][nodes])

    def single(group: np.ndarray, nodes: np.ndarray, products: np.ndarray, bound: np.ndarray) -> None:
        """All queries of a group against the data nodes, the most promising nodes first."""
        while len(nodes):
            alive = (bound >= (best.worst - margin)[group][:, None]).any(0)
            stats["single_met"] += len(nodes)
            stats["single_cut"] += int((~alive).sum())
            nodes, bound, products = nodes[alive], bound[:, alive], products[:, alive]
            if not len(nodes):
                return
            by = np.argsort(-bound.max(0), kind="stable")
            now, later = by[:CHUNK], by[CHUNK:]
            one = now[leaf[nodes[now]] & (sizes[nodes[now]] == 1)]
            if len(one):  # the centre is all that there is
                keep(group, data["centre"][nodes[one]], products[:, one])
            if len(more := nodes[now][leaf[nodes[now]] & (sizes[nodes[now]] > 1)]):
                score(group, points_of(more))
            children = _children(data, nodes[now][~leaf[nodes[now]]])
            nodes, bound, products = nodes[later], bound[:, later], products[:, later]
            if len(children):
                p, b = met(group, children)
                nodes, bound, products = np.concatenate([nodes, children]), np.concatenate([bound, b], 1), np.concatenate([products, p], 1)

    def leaves(own: np.ndarray, nodes: np.ndarray) -> None:
        """Query leaves against data nodes: each by itself with the nodes that it can't do without; together if hardly any can be cut."""
        spans = [queries["order"][slice(*queries["spans"][j])] for j in own]
        radius, longest, at = queries["radius"][own][:, None], queries["longest"][own][:, None], queries["centre"][own]
        least = np.array([(best.worst - margin)[g].min() for g in spans])[:, None]
        products, bound = met(at, nodes, radius, longest)
        while True:
            alive = bound >= least
            stats["pairs_met"] += alive.size
            stats["pairs_cut"] += int((~alive).sum())
            stats["inner_cut"] += int((~alive & ~leaf[nodes]).sum())
            some = alive.any(0)
            nodes, alive, bound, products = nodes[some], alive[:, some], bound[:, some], products[:, some]
            wide = ~leaf[nodes] & (data["radius"][nodes] > radius.max())
            if not wide.any():
                break
            children = _children(data, nodes[wide])
            p, b = met(at, children, radius, longest)
            nodes, bound, products = np.concatenate([nodes[~wide], children]), np.concatenate([bound[:, ~wide], b], 1), np.concatenate([products[:, ~wide], p], 1)
        if not len(nodes):
            return
        if alive.mean() > 0.5:
            if all(len(g) == 1 for g in spans):
                single(at, nodes, products, bound)
            else:
                group = np.concatenate(spans)
                for i in range(0, len(group), GROUP):
                    single(group[i : i + GROUP], nodes, *met(group[i : i + GROUP], nodes))
            return
        for i, (g, mine) in enumerate(zip(spans, alive)):
            if mine.any():
                single(g, nodes[mine], *((products[i : i + 1, mine], bound[i : i + 1, mine]) if len(g) == 1 else met(g, nodes[mine])))

    for p in np.flatnonzero(queries["kids"][:, 0] == queries["kids"][:, 1]):
        seed(queries["order"][slice(*queries["spans"][p])])
    stack = [(0, np.array([0]))]
    while stack:
        p, nodes = stack.pop()
        span = queries["order"][slice(*queries["spans"][p])]
        a, b = queries["kids"][p]
        at, r = queries["centre"][p], queries["radius"][p]
        while True:
            c = data["centre"][nodes]
            stats["products"] += len(nodes)
            bound = limits(x[c] @ q[at], q_norm[at], x_norm[c], r, data["radius"][nodes], queries["longest"][p], data["longest"][nodes])
            alive = bound >= (best.worst - margin)[span].min()
            stats["pairs_met"] += len(nodes)
            stats["pairs_cut"] += int((~alive).sum())
            stats["inner_cut"] += int((~alive & ~leaf[nodes]).sum())
            nodes = nodes[alive]
            wide = ~leaf[nodes] & (data["radius"][nodes] > r)
            if not wide.any():
                break
            nodes = np.concatenate([nodes[~wide], _children(data, nodes[wide])])
        if not len(nodes):
            continue
        if a == b:
            single(span, nodes, *met(span, nodes))
            continue
        children = np.arange(a, b)
        small = queries["kids"][children, 0] == queries["kids"][children, 1]
        stack.extend((j, nodes) for j in children[~small])
        for i in range(0, int(small.sum()), GROUP):
            leaves(children[small][i : i + GROUP], nodes)
    out_q, out_i, out_s = [], [], []
    for o in range(len(q)):
        at, scores = best.at[o], best.scores[o]
        if not exact and len(at):
            mine = _whole(queries["v"][o])
            of = [min(max(sum(a * b for a, b in zip(mine, _whole(data["v"][j]))), -(2**63)), 2**63 - 1) for j in at]
            by = sorted(range(len(at)), key=lambda j: (-of[j], ids[at[j]]))[:k]
            at, scores = at[by], [of[j] for j in by]
        out_q.append(np.full(len(at), queries["ids"][o])), out_i.append(ids[at]), out_s.append(np.array([int(s) for s in scores], np.int64))
    yield np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)


def top_products(table: DataFrame, k: int = 5, every: int = 50, shard_rows: int = 8192, block_rows: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose id is divisible by `every`, the k highest products of floor(256 x) vectors, exactly.

    Every row but the query's own is a candidate; vectors of another length
    aren't. Null ids, null or empty vectors and those with null or non-finite
    components take no part, zero vectors do; rows that repeat an id count
    once, with the smallest vector. Ties go to the smaller id. Scores that
    leave the range of a long are cut to it, and compared so. A query
    without candidates, and an empty table, give no rows. Other columns are ignored.
    """
    vectors = usable(table, id_col, vector_col, zero=True)
    queries = vectors.where(F.pmod("vec_id", F.lit(every)) == 0)
    return searched(vectors, queries, k, shard_rows, block_rows, index, lambda ids, v: index(ids, v, 1), dual_search, "bigint")
