"""Clustering operators: golden cases, and the loops and matrices they stand for."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.operators import cluster as P
from presswork.operators import combos as M
from presswork.operators import vectors as V
from presswork.operators.components import components

PAIRS = "g string, a int, b int"


def test_p11_golden(spark):
    pairs = spark.createDataFrame([("g", 0, 1), ("g", 1, 2)], PAIRS)
    assert sorted(r.node for r in P.two_hop_drops(pairs, ["g"]).collect()) == [1, 2]


def test_p11_equals_the_row_loop(spark):
    rng = np.random.default_rng(1)
    rows, want = [], set()
    for k in range(20):
        n = 15
        near = np.triu(rng.random((n, n)) < 0.12, 1)
        rows += [(f"g{k}", int(i), int(j)) for i, j in zip(*np.nonzero(near))]
        near = near | near.T | np.eye(n, dtype=bool)
        want |= {(f"g{k}", int(j)) for i in range(n) for j in np.flatnonzero(near[i])[1:]}
    got = {(r.g, r.node) for r in P.two_hop_drops(spark.createDataFrame(rows, PAIRS), ["g"]).collect()}
    assert got == want


def test_p12_golden(spark):
    near = [(i, j) for block in (range(0, 4), range(5, 9)) for i in block for j in block if i < j] + [(3, 9), (5, 9)]
    docs = spark.createDataFrame([("g", i) for i in range(10)], "g string, n int")
    pairs = spark.createDataFrame([("g", min(p), max(p)) for p in near], PAIRS)
    got = {r.n: r.label for r in P.density_labels(docs, pairs, ["g"], "n").collect()}
    assert got == {**dict.fromkeys(range(4), 0), 4: -1, **dict.fromkeys(range(5, 9), 1), 9: 0}


def expand(n, near, min_pts=4):
    """Density clustering by expansion in index order."""
    nb = [{i} | {j for j in range(n) if near[i, j]} for i in range(n)]
    core, label, c = [len(x) >= min_pts for x in nb], [-1] * n, 0
    for i in range(n):
        if core[i] and label[i] < 0:
            todo = [i]
            while todo:
                x = todo.pop()
                if label[x] < 0:
                    label[x] = c
                    todo += nb[x] if core[x] else []
            c += 1
    return label


@pytest.mark.parametrize("min_pts", [1, 4])
def test_p12_equals_the_expansion(spark, min_pts):
    rng = np.random.default_rng(2)
    docs, rows, want = [], [], {}
    for k in range(12):
        n = 40
        x = rng.random((n, 2))
        near = (np.linalg.norm(x[:, None] - x, axis=2) < 0.13) & ~np.eye(n, dtype=bool)
        docs += [(f"g{k}", i) for i in range(n)]
        rows += [(f"g{k}", int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(near)))]
        want |= {(f"g{k}", i): c for i, c in enumerate(expand(n, near, min_pts))}
    got = P.density_labels(spark.createDataFrame(docs, "g string, n int"), spark.createDataFrame(rows, PAIRS), ["g"], "n", min_pts)
    assert {(r.g, r.n): r.label for r in got.collect()} == want


def test_components_of_chains_and_rings(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g, n in (("chain", 300), ("ring", 64), ("two", 2)):
        name = rng.permutation(n)
        rows += [(g, int(name[i]), int(name[i + 1])) for i in range(n - 1)] + ([(g, int(name[-1]), int(name[0]))] if g == "ring" else [])
    rows += [("two", 7, 9), ("two", 9, 7), ("two", 5, 5)]
    got = {(r.g, r.node): r.component for r in components(spark.createDataFrame(rows, PAIRS), ["g"]).collect()}
    want = {("chain", i): 0 for i in range(300)} | {("ring", i): 0 for i in range(64)} | {("two", 0): 0, ("two", 1): 0, ("two", 7): 7, ("two", 9): 7}
    assert got == want
    assert components(spark.createDataFrame([], PAIRS), ["g"]).count() == 0


def unit_rows(rng, g, n, terms):
    w = rng.random((n, terms)) * (rng.random((n, terms)) < 0.25)
    w[3:8] = w[2] * (1 + 0.05 * rng.random((5, terms)))
    w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-300)
    return w, [(g, i, f"t{j}", float(w[i, j])) for i in range(n) for j in range(terms) if w[i, j]]


@pytest.mark.parametrize("block", [7, 128])
def test_p10_equals_the_matrix(spark, block):
    rng = np.random.default_rng(4)
    rows, dense = [], {}
    for k in range(4):
        dense[f"g{k}"], more = unit_rows(rng, f"g{k}", 40, 30)
        rows += more
    w = spark.createDataFrame(rows, "g string, n int, term string, w double")
    for tau, strict in ((0.2, False), (0.5, False), (0.98, True)):
        got = {(r.g, r.a, r.b): r.sim for r in V.cosine_pairs(w, ["g"], "n", tau, strict, block).collect()}
        want = {}
        for g, x in dense.items():
            s = np.round(x @ x.T, 6)
            want |= {(g, i, j): s[i, j] for i in range(40) for j in range(i + 1, 40) if (s[i, j] > tau if strict else s[i, j] >= tau)}
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 2e-6 for p in got)
        assert want


def test_p10_prefixes_leave_pairs_out(spark):
    """Documents that share one frequent, light word only are no candidates."""
    rows = [("g", i, f"own{i}", 0.95 ** 0.5) for i in range(50)] + [("g", i, "all", 0.05 ** 0.5) for i in range(50)]
    w = spark.createDataFrame([(*r[:2], 99 if r[2] == "all" else r[1], r[3]) for r in rows], "g string, n int, rk int, w double")
    assert V.similar_candidates(w, ["g"], "n", 0.5).count() == 0


def test_p14_golden(spark):
    labels = spark.createDataFrame([("g", i, c) for i, c in enumerate([-1] * 2 + [0] * 9 + [1] * 4 + [2] * 3)], "g string, n int, label int")
    assert [(r.label, r["size"]) for r in P.candidate_clusters(labels, ["g"]).collect()] == [(1, 4)]


def test_p16_p17_golden(spark):
    terms = spark.createDataFrame([("g", 1, "alpha beta", 0.5), ("g", 2, "alphas", 0.5), ("g", 2, "gamma", 0.4), ("h", 1, "none", 0.5)], "g string, label int, term string, score double")
    words = spark.createDataFrame([("g", ["alpha", "gamma"]), ("h", ["alpha", "gamma"])], "g string, qwords array<string>")
    cands = spark.createDataFrame([("g", 1, 5), ("g", 2, 4), ("h", 1, 9)], "g string, label int, size long")
    cov = P.coverage(terms, words, ["g"])
    assert {(r.g, r.label): r.hits for r in cov.collect()} == {("g", 1): 1, ("g", 2): 2, ("h", 1): 0}
    # all words beat a larger cluster that lacks one; two missing words are too many
    assert [(r.g, r.label) for r in P.pick_cluster(cov, cands, ["g"]).collect()] == [("g", 2)]


def test_m4_m6_m7_golden(spark):
    arts = spark.createDataFrame([("d", 0, i, w) for i, w in enumerate((["A", "B", "C"], ["A", "C"], ["B", "C"]))], "date string, kpos int, id int, words array<string>")
    got = {tuple(r.combo): r.n for r in M.prefixes_of(arts).groupBy("combo").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("A", "B"): 1, ("A", "B", "C"): 1, ("A", "C"): 1, ("B", "C"): 1}
    top = spark.createDataFrame([("d", ["A", "B"]), ("d", ["A", "B", "C"]), ("d", ["B", "C"])], "date string, combo array<string>")
    assert sorted(tuple(r.combo) for r in M.prune_supersets(top).collect()) == [("A", "B"), ("B", "C")]
    assert top.select(M.encode_combo(F.array(F.lit("금리"), F.lit("대출")))).first()[0] == "금리&대출"


def test_rows_without_texts_equal_the_article_table(spark):
    from presswork.plans import q_combos as J3
    from presswork.plans.q_cluster import Clustering
    sf = "/root/testdata/sf0.001"
    cols = ["date", "keyword", "kpos", "agency", "id"]
    got = Clustering(spark, sf)
    assert sorted(map(tuple, got.rows.select(*cols).collect())) == sorted(map(tuple, J3.articles_table(spark, sf).select(*cols).collect()))
    assert sorted(map(tuple, got.combos.collect())) == sorted(map(tuple, J3.combos(spark, sf).collect()))
