"""Summary operators: golden cases and the loops they stand for."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.operators import graph
from presswork.operators import summary as U

S = "g string, node int, sentence string, tokens array<string>"


def loop(rows, threshold, pick, stop=False):
    kept = {}
    for g, node, _, toks in sorted(rows, key=lambda r: (r[0], r[1])):
        mine = kept.setdefault(g, [])
        if mine and mine[-1] is None:
            continue
        if not toks:
            if stop:
                mine.append(None)
            continue
        if all(len(set(toks) & s) / pick(n, len(toks)) < threshold for _, s, n in mine):
            mine.append((node, set(toks), len(toks)))
    return {(g, x[0]) for g, k in kept.items() for x in k if x}


def test_u6_u7_golden(spark):
    rows = [("g", 0, "", list("xyz")), ("g", 1, "", list("xyzwv"))]
    df = spark.createDataFrame(rows, S)
    assert U.drop_redundant(df, ["g"], ["node"], 0.7, "max").count() == 2
    assert [r.node for r in U.drop_redundant(df, ["g"], ["node"], 0.7, "min").collect()] == [0]


@pytest.mark.parametrize("kind,pick", [("max", max), ("min", min)])
def test_u6_u7_equal_the_loop(spark, kind, pick):
    rng = np.random.default_rng(7)
    rows = []
    for g in range(25):
        for i in range(60):
            n = int(rng.integers(0, 7))
            rows.append((f"g{g}", i, "s", [f"t{x}" for x in rng.integers(0, 4 + g, n)]))
    rows += [("copies", i, "s", ["a", "b", "c"] if i % 3 else ["a", "a", "a", "b"]) for i in range(50)] + [("null", 0, "s", None), ("null", 1, "s", ["a"])]
    df = spark.createDataFrame(rows, S)
    for threshold in (0.5, 0.7, 1.0):
        got = {(r.g, r.node) for r in U.drop_redundant(df, ["g"], ["node"], threshold, kind).collect()}
        assert got == loop(rows, threshold, pick)
    got = {(r.g, r.node) for r in U.drop_redundant(df, ["g"], ["node"], 0.7, kind, stop_at_empty=True).collect()}
    assert got == loop(rows, 0.7, pick, True)
    assert U.drop_redundant(df.limit(0), ["g"], ["node"], 0.7, kind).count() == 0


def test_decide_follows_a_chain(spark):
    """Each node is paired with the next only: every other one stays."""
    pairs = spark.createDataFrame([("g", i, i + 1) for i in range(9)], "g string, a int, b int")
    assert sorted(r.node for r in U.decide(pairs, ["g"]).collect()) == [1, 3, 5, 7, 9]


def graphs(spark, n_graphs=6):
    rng = np.random.default_rng(3)
    edges, nodes, dense = [], [], {}
    for k in range(n_graphs):
        n = int(rng.integers(2, 12))
        w = np.triu(rng.random((n, n)) * (rng.random((n, n)) < 0.6), 1)
        dense[k] = w + w.T
        edges += [(k, i, j, float(dense[k][i, j])) for i in range(n) for j in range(n) if dense[k][i, j]]
        nodes += [(k, i) for i in range(n)]
    return (spark.createDataFrame(edges, "g int, src int, dst int, w double"), spark.createDataFrame(nodes, "g int, node int"), dense)


def dense_div_rank(W, alpha=0.25, d=0.85, tol=1e-6, rounds=800, start=None, pers=None, dang=None):
    n = len(W)
    total = W.sum(axis=1, keepdims=True)
    P = alpha * np.divide(W, total, out=np.zeros_like(W), where=total > 0) + (1 - alpha) * np.eye(n)
    one = np.full(n, 1 / n)
    x, p, dg = (one if v is None else np.array(v) / np.sum(v) for v in (start, pers, dang))
    for _ in range(rounds):
        D = P @ x
        new = (1 - d) * p
        for i in range(n):
            new = new + (d * x[i] * P[i] * x / D[i] if D[i] > 0 else 0)
        new = new + d * x[P.sum(axis=1) == 0].sum() * dg
        done = np.abs(new - x).sum() < n * tol
        x = new
        if done:
            return x, True
    return x, False


def test_u12_u13_equal_the_matrix_form(spark):
    e, nd, dense = graphs(spark)
    rng = np.random.default_rng(5)
    given = {k: {v: rng.random(len(W)) for v in ("start", "pers", "dang")} for k, W in dense.items()}
    frames = {v: spark.createDataFrame([(k, i, float(x)) for k in dense for i, x in enumerate(given[k][v])], "g int, node int, v double") for v in ("start", "pers", "dang")}
    for alpha, use in ((0.25, False), (0.25, True), (1.0, True)):
        extra = dict(start=frames["start"], personalization=frames["pers"], dangling=frames["dang"]) if use else {}
        got = {(r.g, r.node): r for r in graph.div_rank_converged(e, nd, ["g"], alpha=alpha, **extra).collect()}
        for k, W in dense.items():
            want, ok = dense_div_rank(W, alpha, **(given[k] if use else {}))
            assert all(abs(got[k, i]["rank"] - want[i]) < 1e-9 and got[k, i].converged == ok for i in range(len(W)))
    # two rounds are not enough: said, not hidden
    short = {(r.g, r.converged) for r in graph.div_rank_converged(e, nd, ["g"], max_iter=2).collect()}
    assert (max(dense, key=lambda k: len(dense[k])), False) in short
    assert len(got) == nd.count()


def test_u12_rounds_equal_the_matrix_form(spark):
    e, nd, dense = graphs(spark, 2)
    got = {(r.g, r.node): r["rank"] for r in graph.div_rank(e, nd, ["g"], rounds=4).collect()}
    for k, W in dense.items():
        want, _ = dense_div_rank(W, rounds=4, tol=0)
        assert all(abs(got[k, i] - want[i]) < 1e-12 for i in range(len(W)))


def test_u10_solves_the_equation(spark):
    e, nd, dense = graphs(spark)
    got = {(r.g, r.node): r for r in graph.page_rank(e, nd, ["g"]).collect()}
    for k, W in dense.items():
        s = W.sum(axis=0)
        M = np.divide(W, s, out=np.zeros_like(W), where=s > 0)
        want = np.linalg.solve(np.eye(len(W)) - 0.85 * M, np.full(len(W), 0.15))
        assert all(abs(got[k, i]["rank"] - want[i]) < 1e-9 and got[k, i].converged for i in range(len(W)))


def test_u9_equals_the_rounds(spark):
    e, nd, dense = graphs(spark)
    got = {(r.g, r.node): r.score for r in graph.salience(e, nd, ["g"]).collect()}
    for k, W in dense.items():
        s = W.sum(axis=0)
        A = np.divide(W, s, out=np.zeros_like(W), where=s > 0)
        R = np.ones_like(A)
        for _ in range(30):
            R = 0.85 * A * R + 0.15
        assert all(abs(got[k, i] - R[i].sum()) < 1e-9 for i in range(len(W)))


def test_u3_u4_golden(spark):
    df = spark.createDataFrame([("k", "금리 3.5% 인상. 시장 반응은? 끝"), ("l", "a" * 189 + ".b" + "a" * 189 + "."), ("m", None), ("n", "")], "k string, content string")
    got = {}
    for r in U.sentence_rows(df, ["k"]).orderBy("spos").collect():
        got.setdefault(r.k, []).append(r.sentence)
    assert got == {"k": ["금리 3.5% 인상.", " 시장 반응은?"], "l": ["a" * 189 + "."]}


def test_u11_u14_order(spark):
    sents = spark.createDataFrame([("g", i, f"s{i}") for i in range(3)], "g string, node int, sentence string")
    for scores, u11, u14 in (([0.1, 0.9, 0.5], "s1^^^s2^^^", "s1^^^s2^^^"), ([0.1, 0.5, 0.9], "s1^^^s2^^^", "s2^^^s1^^^")):
        sc = spark.createDataFrame([("g", i, x) for i, x in enumerate(scores)], "g string, node int, score double")
        assert U.summary_in_order(sc, sents, ["g"], 2).first().summary == u11
        assert U.summary_by_score(sc.withColumnRenamed("score", "rank"), sents, ["g"], 2).first().summary == u14


def test_u1_combo_of_a_row_key(spark):
    df = spark.createDataFrame([("a&b_12",), ("a_b_3",), ("plain",)], "k string")
    assert [r[0] for r in df.select(U.combo_of("k")).collect()] == ["a&b", "a", "plain"]
