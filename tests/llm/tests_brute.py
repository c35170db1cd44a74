"""Groups of near copies by union-find over exact similarities of all pairs that share a shingle."""

from collections import Counter, defaultdict


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(len(w) - width, 0) + 1)) if w else frozenset()


def similar_pairs(sets, similarity=0.8):
    """Index pairs (i, j), j < i, of sets whose Jaccard similarity is that or more; empty sets are copies of each other."""
    held, out = defaultdict(list), []
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in held[x])
        out += [(i, j) for j, n in shared.items() if n >= similarity * (len(s) + len(sets[j]) - n)]
        for x in s:
            held[x].append(i)
        if not s:
            out += [(i, j) for j in held[None]]
            held[None].append(i)
    return out


def components(pairs):
    """{id: smallest id reachable} for (id, text) pairs, and the linked pairs of ids."""
    linked = similar_pairs([shingles(t) for _, t in pairs])
    parent = list(range(len(pairs)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in linked:
        parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        r = find(i)
        least[r] = min(least.get(r, doc), doc)
    return {doc: least[find(i)] for i, (doc, _) in enumerate(pairs)}, [(pairs[i][0], pairs[j][0]) for i, j in linked]
