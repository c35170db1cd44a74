"""Vector searches against brute force."""

import math
from collections import Counter, defaultdict

import numpy as np

from tidemark.llm import covertree, hnsw

SF = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as rank", "3 as dim", "4 as v")


def usable(rows, zero):
    best = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not (zero or any(v)):
            continue
        v = tuple(float(np.float32(x)) for x in v)
        best[i] = min(best.get(i, v), v)
    return best


def brute(rows, k, every, number, zero):
    own = {i: number(v) for i, v in usable(rows, zero).items()}
    out = {}
    for q, v in own.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in own.items() if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return {q: x for q, x in out.items() if x}


def collected(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return dict(out)


ODD = [
    (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (20, [3.0, -1.0]),
    (20, [3.0, -1.0]), (20, [2.0, 9.0]), (None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (41, [0.5, 0.5, 0.5]), (-100, [-1.0, -2.0]), (60, [7.0]), (50, [0.1, 0.1]), (100, [0.0, 0.0]),
]


def ints(v):
    return [math.floor(256 * x) for x in v]


def test_covertree_odd_rows(spark):
    assert collected(covertree.top_products(frame(spark, ODD))) == brute(ODD, 5, 50, ints, True)


def test_hnsw_odd_rows(spark):
    own, wanted = collected(hnsw.nearest(frame(spark, ODD))), brute(ODD, 20, 20, list, False)
    assert {q: [i for i, _ in x] for q, x in own.items()} == {q: [i for i, _ in x] for q, x in wanted.items()}
    assert all(abs(a - b) < 1e-12 for q in own for (_, a), (_, b) in zip(own[q], wanted[q]))


def test_empty_tables(spark):
    df = frame(spark, ODD).where("false")
    assert hnsw.nearest(df).count() == 0 and covertree.top_products(df).count() == 0


def test_covertree_is_exact_over_shards_and_blocks(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    own = collected(covertree.top_products(frame(spark, rows), shard_rows=90, block_rows=3))
    assert own == brute(rows, 5, 50, ints, True)


def searched_by_hand(v, ids, own_ids, k, score):
    whole = {int(i): [score(c) for c in row.tolist()] for i, row in zip(ids, v)}
    out = {}
    for i in own_ids.tolist():
        cut = lambda s: max(min(s, 2**63 - 1), -(2**63))
        scored = sorted((-cut(sum(a * b for a, b in zip(whole[i], w))), j) for j, w in whole.items() if j != i)[:k]
        out[i] = [(j, -s) for s, j in scored]
    return out


def dual(v, ids, at, k=5, stats=None):
    own = defaultdict(list)
    for a, b, s in covertree.dual_search(covertree.index(ids, v), covertree.index(ids[at], v[at], 1), k, stats):
        for x, y, z in zip(a.tolist(), b.tolist(), s.tolist()):
            own[x].append((y, z))
    return dict(own)


def floored(c):
    return math.floor(c * 256) if abs(c) < 2**45 else int(c) * 256


def test_covertree_on_clusters_ties_and_large_numbers():
    r = np.random.default_rng(1)
    ids, at = np.arange(600) * 3, np.arange(0, 600, 25)
    for spread, scale in ((0.01, 1), (1, 1), (0.1, 1e6), (1, 1e9), (1, 1e20), (0.1, 1e300), (1, 1e-12)):
        centres = r.normal(size=(8, 12))
        v = (centres[r.integers(0, 8, 600)] + spread * r.normal(size=(600, 12))) * scale
        v[100:200] = v[0]
        assert dual(v, ids, at) == searched_by_hand(v, ids, ids[at], 5, floored), (spread, scale)


def test_covertree_on_mixed_magnitudes(spark):
    rows = [(0, [1e307, 1.0]), (50, [-1e307, 2.0]), (1, [1e307, -1e307]), (2, [0.5, 0.25]), (3, [1e200, 1e-200]), (100, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    wanted = searched_by_hand(np.array([v for _, v in rows]), np.array([i for i, _ in rows]), np.array([0, 50, 100]), 5, floored)
    assert collected(covertree.top_products(df)) == wanted


def test_covertree_prunes_clusters_and_stays_exact():
    """Clusters far apart: most pairs of nodes are cut before their points are met."""
    r = np.random.default_rng(5)
    centres = r.normal(size=(40, 16))
    centres *= 10 / np.linalg.norm(centres, axis=1, keepdims=True)
    v = centres[r.integers(0, 40, 4000)] + 0.05 * r.normal(size=(4000, 16))
    ids, at = np.arange(4000), np.arange(0, 4000, 20)
    stats = Counter()
    own = dual(v, ids, at, stats=stats)
    x = np.floor(256 * v).astype(np.int64)
    for i in at:
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:5]
        assert own[i] == [(j, s[j]) for j in order]
    everything = len(at) * len(v)
    assert stats["products"] < everything / 10, stats
    assert stats["pairs_cut"] > 0 and stats["inner_cut"] > 0, stats


def test_covertree_without_any_distance():
    v = np.ones((300, 4))
    ids = np.arange(300)
    assert dual(v, ids, np.arange(0, 300, 100)) == {0: [(i, 4 * 65536) for i in range(1, 6)], 100: [(i, 4 * 65536) for i in range(5)], 200: [(i, 4 * 65536) for i in range(5)]}


def test_cover_tree_covers():
    x = np.random.default_rng(3).integers(-300, 300, size=(500, 6)).astype(float)
    t = covertree.build_tree(x)
    assert sorted(t["order"].tolist()) == list(range(500))
    for c, radius, span in zip(t["centre"], t["radius"], t["spans"]):
        points = t["order"][slice(*span)]
        assert np.sqrt(((x[points] - x[c]) ** 2).sum(1)).max() <= radius + 1e-9


def test_siblings_lie_further_apart_than_the_next_radius():
    r = np.random.default_rng(4)
    for x in (r.integers(-300, 300, size=(700, 6)).astype(float), np.floor(256 * r.normal(size=(900, 64)) / 8)):
        t = covertree.build_tree(x)
        assert sorted(t["order"].tolist()) == list(range(len(x)))
        for (a, b), radius in zip(t["kids"], t["radius"]):
            c = x[t["centre"][a:b]]
            if len(c) > 1:
                d = np.sqrt(((c[:, None] - c) ** 2).sum(2)) + 1e9 * np.eye(len(c))
                assert d.min() > radius / covertree.BASE - 1e-6
                assert (t["radius"][a:b] <= radius / covertree.BASE + 1e-6).all()


def recall(own, wanted):
    return sum(len({i for i, _ in own.get(q, [])} & {i for i, _ in x}) for q, x in wanted.items()) / sum(map(len, wanted.values()))


def test_hnsw_recall_on_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    ids = np.array(sorted(rows))
    v = np.stack([rows[i] for i in ids])
    own = collected(hnsw.nearest(table))
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        s = v @ rows[q]
        order = [i for i in ids[np.lexsort((ids, -s))] if i != q][:20]
        hit += len({i for i, _ in own[q]} & set(order))
        total += 20
        assert all(abs(s - float(rows[i] @ rows[q])) < 1e-12 for i, s in own[q])
    assert hit / total >= 0.9


def found_over_shards(spark, v, **more):
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    return collected(hnsw.nearest(df, **more))


def recall_of(v, own, every=20, k=20):
    """Share of the true nearest; a found vector that is as near as the last true one counts."""
    hit = total = 0
    ids = np.arange(len(v))
    for q in range(0, len(v), every):
        s = v @ v[q]
        s[q] = -np.inf
        least = np.sort(s)[-k]
        hit += sum(s[i] >= least - 1e-12 for i, _ in own[q])
        total += k
        assert len(own[q]) == k == len({i for i, _ in own[q]})
    return hit / total


def test_hnsw_recall_over_several_shards(spark):
    r = np.random.default_rng(6)
    v = r.normal(size=(6000, 64))
    assert recall_of(v, found_over_shards(spark, v, shard_rows=1500, block_rows=100)) >= 0.9
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    assert recall_of(v, found_over_shards(spark, v, shard_rows=3000)) >= 0.9


def test_hnsw_recall_with_uneven_lengths(spark):
    r = np.random.default_rng(7)
    v = r.normal(size=(6000, 64)) * np.exp(r.normal(size=(6000, 1)))
    assert recall_of(v, found_over_shards(spark, v, shard_rows=2000)) >= 0.9
    assert recall_of(v, found_over_shards(spark, v)) >= 0.9


def test_hnsw_with_a_common_vector_and_unequal_lengths():
    r = np.random.default_rng(2)
    v = r.normal(size=(1500, 16)) * r.uniform(0.2, 3, size=(1500, 1))
    v[300:800] = v[7]
    ids = np.arange(1500)
    own = defaultdict(list)
    for a, b, _ in hnsw.search_index(hnsw.build_index(ids, v), {"ids": ids[::20], "v": v[::20]}, 20, 128):
        for x, y in zip(a.tolist(), b.tolist()):
            own[x].append((y, 0))
    assert recall_of(v, own) >= 0.9


def test_small_graphs_find_everything():
    r = np.random.default_rng(8)
    for n in (1, 2, 3, 20, 33, 100):
        v, ids = r.normal(size=(n, 8)), np.arange(n)
        own = defaultdict(set)
        for a, b, _ in hnsw.search_index(hnsw.build_index(ids, v), {"ids": ids, "v": v}, 200, 128):
            for x, y in zip(a.tolist(), b.tolist()):
                own[x].add(y)
        assert all(own[i] == set(range(n)) - {i} for i in range(n))
