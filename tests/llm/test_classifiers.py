"""Toxicity and quality: held-out accuracy, counterfactual invariance, edge cases."""

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import _learning, quality, toxicity

SF = "/root/testdata/sf0.1"
INSULTS = ["dreadfool", "nitwitted", "scoundrelly"]


def word(i):
    """The i-th of many words of letters only."""
    return "".join("bcdfghklmnprstvz"[i // 16**k % 16] + "aeiou"[(i + k) % 5] for k in range(3))


def corpus(n, seed):
    r = random.Random(seed)
    words = [word(i) for i in range(400)] + ["women", "muslims", "immigrants", "jews"]
    texts, labels = [], []
    for _ in range(n):
        w = [r.choice(words) for _ in range(r.randrange(5, 200))]
        y = r.random() < 0.4
        if y:
            w.insert(r.randrange(len(w)), r.choice(INSULTS))
        texts.append(" ".join(w))
        labels.append(int(y))
    return texts, labels


def test_toxicity_learns_and_ignores_length():
    model = toxicity.train(*corpus(600, 1))
    f = model.scorer()
    texts, labels = corpus(300, 2)
    assert [int(f(t) >= 0.5) for t in texts] == labels
    clean = " ".join(word(i % 400) for i in range(20000))
    assert f(clean) < 0.3 and f(clean + " nitwitted") > 0.7


def test_swapped_identities_do_not_move_the_score():
    """Toxic texts that always name one group: the penalty keeps its name neutral."""
    r = random.Random(5)
    texts, labels = [], []
    for i in range(800):
        w = [word(r.randrange(300)) for _ in range(12)]
        y = i % 2
        if y:
            w[3:3] = ["muslims", r.choice(INSULTS)] if r.random() < 0.8 else ["muslims"]
        elif r.random() < 0.1:
            w[3:3] = ["christians"]
        texts.append(" ".join(w))
        labels.append(y)

    def gap(penalty):
        f = toxicity.train(texts, labels, penalty=penalty).scorer()
        return abs(f(f"{word(1)} muslims {word(2)}") - f(f"{word(1)} christians {word(2)}")), f(f"{word(1)} nitwitted {word(2)}")

    with_penalty, insult = gap(4.0)
    without, _ = gap(0.0)
    assert with_penalty < without and with_penalty < 0.1 and insult > 0.5


def test_toxicity_on_documents_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    own = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in own)
    held = [r for r in own if r.held_out]
    toxic = [r for r in held if r.toxic]
    caught = sum(r.predicted for r in toxic) / len(toxic)
    false = sum(r.predicted for r in held if not r.toxic) / sum(1 - r.toxic for r in held)
    assert len(toxic) > 100 and caught >= 0.85 and false <= 0.01
    # Some junk documents are labelled toxic without a word that tells it; nothing can be learnt from those.
    told = [r for r in toxic if r["quality"]]
    assert sum(r.predicted for r in told) / len(told) >= 0.95


def test_toxicity_scores_against_brute_force(spark):
    """Every document's score once more: the highest sum over a window of 16 words of all features' weights."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    assert model.weights and min(model.weights.values()) > 0
    own = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    for r in docs.collect():
        words = "".join(c if c.isalpha() else " " for c in r.text.lower()).split()
        best = 0.0
        for i in range(0, len(words), 16):
            window = set(words[i : i + 16])
            best = max(best, sum(model.weights.get(w, 0) + sum(model.weights.get(f"{n} {w[:n]}", 0) for n in (4, 5, 6, 7) if len(w) >= n) for w in window))
        assert abs(own[r.doc_id] - 1 / (1 + np.exp(-best - model.bias))) < 1e-9


def test_a_sample_of_labelled_texts_is_bounded_in_bytes(spark):
    rows = [(i, "word " * (400 if i % 2 else 4), "x") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sample = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, label int")
    whole = _learning.labelled(docs, sample, max_bytes=10**9).collect()
    few = _learning.labelled(docs, sample, max_bytes=40_000).collect()
    assert len(whole) == 400 and 0 < sum(len(r.text) for r in few) < 80_000


def test_quality_on_documents_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    own = quality.quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in own if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in own)
    lost = sum(1 - r.predicted for r in held if r["quality"]) / sum(r["quality"] for r in held)
    kept = sum(r.predicted for r in held if not r["quality"]) / sum(1 - r["quality"] for r in held)
    assert lost <= 0.01 and kept <= 0.05


def test_flattened_trees_score_as_the_trees_do():
    r = np.random.default_rng(0)
    x = r.normal(size=(800, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    t = quality.boost(x, y, trees=20)

    def walk(row):
        total = t.base
        for n in t.roots:
            while t.left[n] != n:
                n = t.left[n] if row[t.feature[n]] <= t.threshold[n] else t.right[n]
            total += t.value[n]
        return 1 / (1 + np.exp(-total))

    own = t.scores(x, block=77)
    assert np.allclose(own, [walk(v) for v in x])
    assert ((own > 0.5) == y).mean() > 0.97


def test_quality_scores_against_brute_force(spark):
    """Every document's score once more: its statistics go down each tree by itself."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    t = quality.fit(docs, labels)
    own = {r.doc_id: r.score for r in quality.quality(docs, labels).collect()}
    for r in docs.collect():
        x, total = quality.statistics(r.text), t.base
        for n in t.roots:
            while t.left[n] != n:
                n = t.left[n] if x[t.feature[n]] <= t.threshold[n] else t.right[n]
            total += t.value[n]
        assert abs(own[r.doc_id] - 1 / (1 + np.exp(-total))) < 1e-9


def test_statistics_of_odd_texts():
    for t in [None, "", " ", "\n\n", "x" * 100_000, "a b " * 1000, "\ud83d", "é" * 10]:
        own = quality.statistics(t)
        assert len(own) == len(quality.STATISTICS) and np.isfinite(own).all()


ODD = [(1, None, "x", 5), (2, "", "x", 5), (2, "", "x", 5), (None, "some words", "y", 6), (4, "w " * 200_000, "y", 7)]


@pytest.mark.parametrize("operator, keep, label", [(toxicity.toxicity, toxicity.keep_clean, "toxic"), (quality.quality, quality.keep_good, "quality")])
def test_edge_cases(spark, operator, keep, label):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, score string, predicted int")
    some = spark.createDataFrame([(1, 0, 1, "x"), (2, None, None, "x"), (2, 1, 0, "x"), (None, 1, 1, "x"), (77, 1, 1, "y")], "doc_id long, toxic int, quality int, text string")
    none = some.where("false")
    for labels in (some, none):
        own = operator(docs, labels).collect()
        assert len(own) == len(ODD) and all(0 <= r.score <= 1 for r in own)
        assert [r.held_out for r in own if r.doc_id is None] == [None]
    assert operator(docs.where("false"), some).count() == 0
    assert keep(docs, none).columns == docs.columns
    clash = docs.selectExpr("*", "1 as score_", "2 as label", "3 as __doc")
    assert keep(clash, some).columns == clash.columns and keep(clash, some).count() == keep(docs, some).count()
