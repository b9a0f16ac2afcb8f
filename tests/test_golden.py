"""Hand-computed golden cases (FIXTURES.md section 3)."""

import math

import numpy as np

from pyspark.sql import functions as F

from presswork.functions.text import merge_sentences
from presswork.operators import clean as C
from presswork.operators import graph
from presswork.operators import keywords as K
from presswork.operators.articles import drop_repeats, quota
from presswork.operators.summary import sentence_graph


def test_k5_merge(spark):
    df = spark.createDataFrame([("a" * 20 + ".bb." + "c" * 20,)], "t string")
    out = merge_sentences(df, "t", "s").select("s").first()[0]
    assert out == ["a" * 20 + " bb", "c" * 20]


def test_k2_parse_age(spark):
    df = spark.createDataFrame([("6시간전",), ("1일전",), ("30분전",)], "t string")
    assert [r[0] for r in df.select(K.parse_age("t")).collect()] == [6, None, None]


def test_k10_path_and_isolated(spark):
    e = spark.createDataFrame([(1, "a", "b", 1.0), (1, "b", "a", 1.0), (1, "b", "c", 1.0), (1, "c", "b", 1.0)],
                              "id int, src string, dst string, w double")
    n = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "z")], "id int, node string")
    r = {(x.id, x.node): x.rank for x in graph.text_rank(e, n, "id", iters=100, checkpoint_every=5).collect()}
    assert abs(r[(1, "a")] - 0.770270) < 1e-5 and abs(r[(1, "c")] - 0.770270) < 1e-5
    assert abs(r[(1, "b")] - 1.459459) < 1e-5
    assert abs(r[(2, "z")] - 0.15) < 1e-12


def test_e13_tail(spark):
    df = spark.createDataFrame([("A. B. tail",)], "t string")
    assert df.select(C.drop_tail_after_last_stop("t")).first()[0] == "A. B. "


def test_e15_repeats_and_e16_quota(spark):
    rows = [(1, "k", "P", None), (2, "k", "P", None), (3, "k", "P", "t"), (4, "k", None, None)]
    df = spark.createDataFrame(rows, "pos int, keyword string, content string, thumbnail string")
    kept = [r.pos for r in drop_repeats(df, [F.col("pos")]).orderBy("pos").collect()]
    assert kept == [1, 3]
    q = spark.createDataFrame([(i, "k", "o") for i in range(3)], "pos int, keyword string, agency string")
    assert [r.pos for r in quota(q, [F.col("pos")], n=2).orderBy("pos").collect()] == [0, 1]


def test_u8_similarity(spark):
    df = spark.createDataFrame([("g", 0, ["x", "y", "z"]), ("g", 1, ["x", "y", "w"])],
                               "g string, node int, tokens array<string>")
    w = sentence_graph(df, ["g"]).filter("src = 0").first().w
    assert abs(w - 2 / (2 * (math.log(4) + 1))) < 1e-9


def test_u12_two_nodes(spark):
    e = spark.createDataFrame([("g", 0, 1, 0.3), ("g", 1, 0, 0.3)], "g string, src int, dst int, w double")
    n = spark.createDataFrame([("g", 0), ("g", 1)], "g string, node int")
    r = graph.div_rank_converged(e, n, ["g"]).collect()
    assert all(abs(x["rank"] - 0.5) < 1e-9 for x in r) and all(x.converged for x in r)


def test_u9_two_sentences(spark):
    e = spark.createDataFrame([("g", 0, 1, 0.4), ("g", 1, 0, 0.4)], "g string, src int, dst int, w double")
    n = spark.createDataFrame([("g", 0), ("g", 1)], "g string, node int")
    r = graph.salience(e, n, ["g"]).collect()
    # a = 1 for both cells: f(1) = 0.85^30 + 0.15 (1 - 0.85^30) / 0.15 = 1, plus 0.15 on the diagonal
    assert all(abs(x.score - 1.15) < 1e-9 for x in r)


def test_k10_grouped_solves_the_linear_system(spark):
    rng = np.random.default_rng(5)
    rows = []
    for gid, (sents, words) in enumerate([(1, 1), (1, 2), (30, 12), (200, 90), (3, 400)]):
        x = (rng.random((sents, words)) < 0.2) * rng.integers(1, 4, (sents, words)).astype(float)
        x[0] = np.maximum(x[0], 1.0)
        x = np.c_[x, np.zeros(sents)]
        x = np.vstack([x, np.eye(words + 1)[-1]])  # a word alone in its sentence
        x /= np.sqrt((x * x).sum(0))
        w = x.T @ x
        np.fill_diagonal(w, 0)
        t = w.sum(0)
        want = np.linalg.solve(np.eye(len(t)) - 0.85 * w * np.divide(1, t, out=np.zeros(len(t)), where=t > 0), np.full(len(t), 0.15))
        rows.append((gid, x, want))
    df = spark.createDataFrame([(g, int(i), f"w{j:03d}", float(x[i, j])) for g, x, _ in rows for i, j in zip(*np.nonzero(x), strict=True)],
                               "id int, sent int, word string, x double")
    every = {(r.id, r.word): r["rank"] for r in graph.text_rank_grouped(df, top=None).collect()}
    best = {(r.id, r.pos): r.word for r in graph.text_rank_grouped(df, top=7).collect()}
    for g, _x, want in rows:
        got = np.array([every[g, f"w{j:03d}"] for j in range(len(want))])
        assert np.abs(got - want).max() < 1e-6
        order = sorted(range(len(want)), key=lambda j: (-got[j], j))[:7]
        assert [best[g, k] for k in range(len(order))] == [f"w{j:03d}" for j in order]


def test_k9_k10_groups_that_batches_cut(spark):
    """Edges and ranks of many small groups handed on together, with batches
    that end inside a group and a null group, equal those of each by itself."""
    from presswork.operators.vectors import l2_by, word_graph
    rng = np.random.default_rng(3)
    rows = [(None if g == 7 else g, s, f"w{j}", int(rng.integers(1, 4))) for g in range(40) for s in range(1 + g % 5) for j in range(g % 9 + 1) if rng.random() < 0.7]
    df = spark.createDataFrame(rows, "id int, sent int, word string, c long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = {(r.id, r.src, r.dst): r.w for p in (50, 500_000) for r in word_graph(df, pairs=p).collect()}
        ranks = {(r.id, r.word): r["rank"] for r in graph.text_rank_grouped(l2_by(df, ["id", "word"]), top=None).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want, n_ranks = {}, 0
    for g in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == g]
        words = sorted({r[2] for r in mine})
        x = np.zeros((5, len(words)))
        for _, s, word, c in mine:
            x[s, words.index(word)] = c
        n_ranks += len(words)
        shared = (x > 0).T.astype(int) @ (x > 0) > 0
        w = (x / np.sqrt((x * x).sum(0))).T @ (x / np.sqrt((x * x).sum(0)))
        if g is not None:
            want.update({(g, a, b): w[i, j] for i, a in enumerate(words) for j, b in enumerate(words) if shared[i, j]})
        np.fill_diagonal(w, 0)
        t = w.sum(0)
        rank = np.linalg.solve(np.eye(len(t)) - 0.85 * w * np.divide(1, t, out=np.zeros(len(t)), where=t > 0), np.full(len(t), 0.15))
        assert all(abs(ranks[g, a] - rank[i]) < 2e-6 for i, a in enumerate(words))
    assert len(ranks) == n_ranks and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_group_partitions_grow_with_the_texts(spark):
    from presswork.session import group_partitions
    before = spark.conf.get("presswork.group.partitions")
    spark.conf.unset("presswork.group.partitions")
    try:
        few = group_partitions(spark)
        assert group_partitions(spark, 1000) == few and group_partitions(spark, 6 << 30) == 6 * 256
    finally:
        spark.conf.set("presswork.group.partitions", before)


def test_k9_edges_are_rounded_as_spark_rounds(spark):
    """``word_graph`` with digits gives what Spark's ``round`` makes of its
    weights (ties go up), with pairs of one sentence and of several, and a word
    that is listed twice for a sentence."""
    from presswork.operators.vectors import rounded, word_graph
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.random(5000), np.arange(-300, 300) / 128, rng.random(2000).round(7), [0.0, -1e-9, 0.0000005, 1e9 + 0.1, 1e18, 123456.1234565]])
    want = [r.w for r in spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double").orderBy("i").select(F.round("x", 6).alias("w")).collect()]
    got = rounded(x, 6)
    assert got.tolist() == want and not np.signbit(got[got == 0]).any()

    rows = [(1, 0, "b", 1), *((1, s, "a", c) for s, c in enumerate((1, 127, 15, 5, 2))), (1, 3, "c", 2), (1, 4, "c", 3), (1, 4, "d", 1),
            (2, 0, "a", 1), (2, 0, "a", 1), (2, 0, "b", 1), (2, 1, "b", 2), (3, 0, "a", 4)]
    df = spark.createDataFrame(rows, "id int, sent int, word string, c long")
    plain = {(r.id, r.src, r.dst): r.w for r in word_graph(df).select("id", "src", "dst", F.round("w", 6).alias("w")).collect()}
    edges = [tuple(r) for r in word_graph(df, digits=6).collect()]
    assert len(edges) == len(plain) == 17 and {e[:3]: e[3] for e in edges} == plain
    assert plain[1, "a", "b"] == plain[1, "b", "a"] == 0.007813  # 1 / 128
    assert plain[2, "a", "b"] == round(2 / np.sqrt(2) / np.sqrt(5), 6)
