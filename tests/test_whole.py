"""The queries without a cut against brute force in Python."""

import re
from collections import Counter

import pyarrow.parquet as pq

from tidemark.plans import queries

SF = "/root/testdata/sf0.001"


def rows(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def compact(s):
    return re.sub(r"[^\w]+", "", re.sub(r"\.(pdf|md)$", "", s.strip(" ").lower()))


def score(t, c):
    if not t or not c:
        return 0.0
    if t in c or c in t:
        return 1.0
    part = lambda n: len({t[i : i + n] for i in range(len(t) - n + 1)} & {c[i : i + n] for i in range(len(c) - n + 1)}) / max(len({t[i : i + n] for i in range(len(t) - n + 1)}), 1)
    return part(1) * 0.35 + part(3) * 0.65


def test_titles_meet_all_items(spark):
    items = {r["item_id"]: compact(r["text"].split("\n")[0]) for r in rows("benchmark")}
    titles = {r["doc_id"]: compact(r["text"].split("\n")[0]) for r in rows("documents")}
    wanted = {(i, d): round(score(t, c), 6) for i, t in items.items() for d, c in titles.items()}
    own = {(r.item_id, r.doc_id): r.similarity for r in queries()["title_similarity"](spark, SF).collect()}
    assert own.keys() == wanted.keys() and all(abs(own[k] - wanted[k]) < 2e-6 for k in own)
    best = {d: max(((own[i, d], -i) for i in items)) for d in titles}
    got = {r.doc_id: (r.similarity, -r.item_id) for r in queries()["best_section"](spark, SF).collect()}
    assert got == {d: b for d, b in best.items() if b[0] >= 0.35}


def test_words_are_looked_up_in_all_documents(spark):
    docs = sorted((r["doc_id"], r["text"].lower()) for r in rows("documents"))
    wanted = {}
    for r in rows("benchmark"):
        word = (r["text"].split(" ") + [""])[1].lower()
        if found := [f"S{d}" for d, t in docs if word in t][:4]:
            wanted[r["item_id"]] = ",".join(sorted(found, key=lambda s: int(s[1:])))
    assert {r.item_id: r.refs for r in queries()["evidence_refs"](spark, SF).collect()} == wanted


def test_tokens_of_all_lines(spark):
    wanted = Counter()
    for r in rows("documents"):
        for w in re.findall("[a-zà-ÿ]{2,}", r["text"].lower()):
            wanted.update((r["doc_id"], t) for t in ([w] if len(w) <= 4 else [w[i : i + n] for n in (2, 3) for i in range(len(w) - n + 1)]))
    assert {(r.doc_id, r.token): r.n for r in queries()["ngram_tokens"](spark, SF).collect()} == wanted


def test_anchors_are_filtered_first_and_met_in_the_whole_body(spark):
    def letters(s):
        return re.sub("[^a-z]", "", s.lower())

    wanted = set()
    for r in rows("documents"):
        a = [x for x in map(letters, r["text"].split(".")) if len(x) >= 12][:8]
        hits = sum(x in letters(r["text"]) for x in a)
        wanted.add((r["doc_id"], len(a), hits, bool(a) and hits >= (1 if len(a) <= 2 else 2)))
    assert {tuple(r) for r in queries()["anchor_verify"](spark, SF).collect()} == wanted
