"""Graph scores over edge DataFrames ``(group, src, dst, w)``.

K10 / U10 TextRank, U9 closed-form salience, U12 / U13 diversity rank.

Iterative operators keep every group advancing together: the edge table is
hash-partitioned once on the group key and cached, and the rank table is
kept on the same partitioning, so the per-round joins and sums are
partition-local (no shuffle per round). Lineage is cut with reliable
checkpoints in the folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.operators.groups import group_numbers, numbers, whole_groups
from presswork.session import co_partition_on_group, cut_lineage, group_partitions


def _g(group) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def _settle(x: DataFrame, k: int, total: int, every: int, prev: DataFrame | None) -> DataFrame:
    """Materialise the (small) rank table of round ``k``.

    Each round is cached so the next round's stage only joins cached inputs
    (rounds are partition-local, so without this all rounds would pile up in
    one deep stage); every ``every`` rounds a reliable checkpoint cuts the
    lineage so a lost executor recomputes from the last checkpoint only.
    """
    if k + 1 >= total:
        return x
    if every and (k + 1) % every == 0:
        x = cut_lineage(x)
    else:
        x = x.cache()
        x.count()
    if prev is not None:
        prev.unpersist()
    return x


def text_rank(edges: DataFrame, nodes: DataFrame, group="id", d: float = 0.85,
              iters: int = 30, x0: float = 1.0, checkpoint_every: int = 10,
              partitions: int | None = None) -> DataFrame:
    """Ranks solving ``x = (1-d) + d * M x`` by fixed-point iteration.

    ``M`` = the graph with zeroed diagonal, columns divided by their sums.
    ``nodes`` = ``(group..., node)``; nodes without neighbours score ``1-d``.
    ``iters`` is a fixed count: the error after ``k`` rounds is at most
    ``C * d**k``. For ranks that are solved see ``text_rank_grouped`` (word
    graphs) and ``page_rank``. Output ``(group..., node, rank)``.
    """
    g = _g(group)
    spark = edges.sparkSession
    co_partition_on_group(spark)
    n_part = partitions or group_partitions(spark)
    e = edges.filter((F.col("src") != F.col("dst")) & (F.col("w") != 0))
    cs = Window.partitionBy(*g, "src")
    en = (e.withColumn("m", F.col("w") / F.sum("w").over(cs))
          .select(*g, "src", "dst", "m")
          .repartition(n_part, *g).cache())
    nd = nodes.select(*g, "node").repartition(n_part, *g).cache()
    x = nd.withColumn("x", F.lit(float(x0)))
    prev = None
    for k in range(iters):
        contrib = (en.join(x.withColumnRenamed("node", "src"), [*g, "src"])
                   .groupBy(*g, "dst").agg(F.sum(F.col("m") * F.col("x")).alias("s"))
                   .withColumnRenamed("dst", "node"))
        x = (nd.join(contrib, [*g, "node"], "left")
             .select(*g, "node", ((1 - d) + d * F.coalesce("s", F.lit(0.0))).alias("x")))
        x = _settle(x, k, iters, checkpoint_every, prev)
        prev = x
    return x.withColumnRenamed("x", "rank")


def salience(edges: DataFrame, nodes: DataFrame, group="group", d: float = 0.85,
             rounds: int = 30) -> DataFrame:
    """The summary score of the combo path, in closed form.

    The source normalises columns to sum 1 (zero columns stay zero), then
    applies ``R = d * (A o R) + (1-d)`` element-wise ``rounds`` times from
    ``R = 1`` and sums rows. Per cell that is
    ``f(a) = (d a)^r + (1-d) (1 - (d a)^r) / (1 - d a)`` with ``f(0) = 1-d``,
    so a node scores ``(1-d) * N + sum over its non-zero cells of f(a)-(1-d)``.
    Output ``(group..., node, score)``.
    """
    g = _g(group)
    col_sum = Window.partitionBy(*g, "dst")
    a = (edges.filter((F.col("w") != 0) & (F.col("src") != F.col("dst")))
         .withColumn("a", F.col("w") / F.sum("w").over(col_sum)))
    da = F.lit(d) * F.col("a")
    p = F.pow(da, rounds)
    f = p + (1 - d) * (1 - p) / (1 - da)
    part = a.groupBy(*g, F.col("src").alias("node")).agg(F.sum(f - (1 - d)).alias("s"))
    n = nodes.groupBy(*g).agg(F.count(F.lit(1)).alias("n"))
    return (nodes.select(*g, "node").join(n, g).join(part, [*g, "node"], "left")
            .select(*g, "node", ((1 - d) * F.col("n") + F.coalesce("s", F.lit(0.0))).alias("score")))


def _divrank_transition(edges: DataFrame, nodes: DataFrame, g: list[str], alpha: float):
    """Row-stochastic weights times ``alpha`` plus a self-loop ``1-alpha``."""
    e = edges.filter((F.col("src") != F.col("dst")) & (F.col("w") != 0))
    row = Window.partitionBy(*g, "src")
    off = e.select(*g, "src", "dst", (alpha * F.col("w") / F.sum("w").over(row)).alias("p"))
    loop = nodes.select(*g, F.col("node").alias("src"), F.col("node").alias("dst"),
                        F.lit(1.0 - alpha).alias("p"))
    return off.unionByName(loop)


def div_rank(edges: DataFrame, nodes: DataFrame, group="group", alpha: float = 0.25,
             d: float = 0.85, rounds: int = 10, start: DataFrame | None = None,
             personalization: DataFrame | None = None, checkpoint_every: int = 10,
             partitions: int | None = None) -> DataFrame:
    """U12 / U13 with a fixed round count, all groups together.

    ``x'_m = sum_n d * (P_nm x_m / D_n) x_n + (1-d) p_m``, ``D_n = sum_m P_nm x_m``.
    The ranks need not have settled then; ``div_rank_converged`` has the stop rule.
    ``start`` / ``personalization``: optional ``(group..., node, v)`` frames,
    normalised per group (uniform when absent). Every node carries a self
    loop, so no node is dangling. Output ``(group..., node, rank)``.
    """
    g = _g(group)
    spark = edges.sparkSession
    co_partition_on_group(spark)
    n_part = partitions or group_partitions(spark)
    nd = nodes.select(*g, "node")
    per = Window.partitionBy(*g)

    def norm(v: DataFrame | None, name: str) -> DataFrame:
        if v is None:
            return nd.withColumn(name, 1.0 / F.count(F.lit(1)).over(per))
        return (nd.join(v.select(*g, "node", F.col("v")), [*g, "node"], "left")
                .withColumn(name, F.coalesce("v", F.lit(0.0)))
                .withColumn(name, F.col(name) / F.sum(name).over(per)).drop("v"))

    p = norm(personalization, "pers").repartition(n_part, *g).cache()
    tr = _divrank_transition(edges, nd, g, alpha).repartition(n_part, *g).cache()
    x = norm(start, "x").select(*g, "node", "x")
    prev = None
    for k in range(rounds):
        xn = x.select(*g, F.col("node").alias("dst"), F.col("x").alias("x_dst"))
        xs = x.select(*g, F.col("node").alias("src"), F.col("x").alias("x_src"))
        t = tr.join(xn, [*g, "dst"]).join(xs, [*g, "src"])
        t = t.withColumn("px", F.col("p") * F.col("x_dst"))
        dn = Window.partitionBy(*g, "src")
        t = t.withColumn("D", F.sum("px").over(dn))
        inflow = (t.groupBy(*g, F.col("dst").alias("node"))
                  .agg(F.sum(d * F.col("px") / F.col("D") * F.col("x_src")).alias("s")))
        x = (p.join(inflow, [*g, "node"], "left")
             .select(*g, "node", (F.coalesce("s", F.lit(0.0)) + (1 - d) * F.col("pers")).alias("x")))
        x = _settle(x, k, rounds, checkpoint_every, prev)
        prev = x
    return x.withColumnRenamed("x", "rank")


def _per_graph(edges: DataFrame, nodes: DataFrame, g: list[str], solve, vectors: dict[str, DataFrame | None] | None = None) -> DataFrame:
    """One task a graph: ``solve(n, src, dst, w, given)`` on its edge list with
    nodes numbered 0..n-1 (by value) returns ranks, rounds and whether they
    settled. ``vectors`` are optional ``(group..., node, v)`` frames; ``given``
    has each as an array that sums to 1 (uniform where absent or all zero).
    Memory is linear in a graph's edges. Output ``(group..., node, rank,
    rounds, converged)``; edges of nodes that are not given are left out.
    """
    # fresh attribute ids on both sides: edges and nodes often share lineage
    e = edges.select(*[F.col(c).alias(c) for c in (*g, "src", "dst", "w")])
    nd = nodes.select(*[F.col(c).alias(c) for c in (*g, "node")]).distinct()
    names = list(vectors or {})
    for name in names:
        v = vectors[name]
        nd = (nd.withColumn(name, F.lit(1.0)) if v is None else
              nd.join(v.select(*g, "node", F.col("v").cast("double").alias(name)), [*g, "node"], "left").fillna(0.0, [name]))
    types = dict(nodes.dtypes)
    schema = ", ".join([f"{c} {types[c]}" for c in g] + [f"node {types['node']}", "rank double", "rounds int", "converged boolean"])
    columns = [*g, "node", "rank", "rounds", "converged"]

    def run(key, ed: pd.DataFrame, nv: pd.DataFrame) -> pd.DataFrame:
        if nv.empty:
            return pd.DataFrame(columns=columns)
        nv = nv.sort_values("node", kind="stable")
        at = pd.Series(np.arange(len(nv)), index=nv["node"].to_numpy())
        src, dst = at.reindex(ed["src"]).to_numpy(float), at.reindex(ed["dst"]).to_numpy(float)
        fine = ~(np.isnan(src) | np.isnan(dst)) & (src != dst) & (ed["w"].to_numpy(float) != 0)
        given = {}
        for name in names:
            v = nv[name].to_numpy(float)
            given[name] = v / v.sum() if v.sum() > 0 else np.full(len(v), 1.0 / len(v))
        x, rounds, ok = solve(len(nv), src[fine].astype(np.int64), dst[fine].astype(np.int64), ed["w"].to_numpy(float)[fine], given)
        out = pd.DataFrame({"node": nv["node"].to_numpy(), "rank": x, "rounds": rounds, "converged": ok})
        for i, c in enumerate(g):
            out.insert(i, c, key[i])
        return out

    return e.groupBy(*g).cogroup(nd.groupBy(*g)).applyInPandas(run, schema)


def div_rank_converged(edges: DataFrame, nodes: DataFrame, group="group",
                       alpha: float = 0.25, d: float = 0.85, tol: float = 1e-6,
                       max_iter: int = 800, start: DataFrame | None = None,
                       personalization: DataFrame | None = None, dangling: DataFrame | None = None) -> DataFrame:
    """U12 / U13 with the full stop rule (L1 change below ``N * tol``), per group.

    Weights of a row are divided by their sum and scaled to ``alpha``, with a
    self-loop of ``1 - alpha``; a round is two sums over the edge list
    (``D`` by source, the inflow by target), so no matrix is formed. ``start``,
    ``personalization`` and ``dangling`` are optional ``(group..., node, v)``
    frames, scaled to sum 1 per group (uniform when absent). The rank of nodes
    without any way out (only with ``alpha`` = 1) goes to ``dangling``. Groups
    that do not settle within ``max_iter`` rounds are reported in ``converged
    = false`` instead of failing the job.
    Output ``(group..., node, rank, rounds, converged)``.
    """
    def solve(n, src, dst, w, given):
        total = np.bincount(src, w, n)
        p = alpha * w / total[src]
        if alpha < 1:
            loop = np.arange(n)
            src, dst, p = np.concatenate([src, loop]), np.concatenate([dst, loop]), np.concatenate([p, np.full(n, 1.0 - alpha)])
        out = np.bincount(src, p, n) == 0
        x = given["start"]
        for k in range(1, max_iter + 1):
            px = p * x[dst]
            D = np.bincount(src, px, n)
            share = np.divide(x, D, out=np.zeros(n), where=D > 0)
            new = d * np.bincount(dst, px * share[src], n) + (1 - d) * given["personal"]
            if out.any():
                new = new + d * x[out].sum() * given["dangling"]
            err = np.abs(new - x).sum()
            x = new
            if err < n * tol:
                return x, k, True
        return x, max_iter, False

    return _per_graph(edges, nodes, _g(group), solve, {"start": start, "personal": personalization, "dangling": dangling})


def page_rank(edges: DataFrame, nodes: DataFrame, group="group", d: float = 0.85,
              tol: float = 1e-12) -> DataFrame:
    """The PageRank that U9 stands in for, per group and to convergence:
    ``x = (1-d) + d * M x`` as K10, with columns divided by their sums; nodes
    without neighbours score ``1-d``. The change shrinks by ``d`` a round; a
    group that still moves after ten times the rounds this takes has
    ``converged = false``. Output as ``div_rank_converged``."""
    def solve(n, src, dst, w, given):
        m = w / np.bincount(src, w, n)[src]
        x = np.ones(n)
        limit = 10 * int(np.ceil(np.log(tol / max(n, 2)) / np.log(d)))
        for k in range(1, limit + 1):
            new = (1 - d) + d * np.bincount(dst, m * x[src], n)
            moved = np.abs(new - x).max()
            x = new
            if moved < tol * max(1.0, np.abs(x).max()):
                return x, k, True
        return x, limit, False

    return _per_graph(edges, nodes, _g(group), solve)


def _ranks(g: np.ndarray, w: np.ndarray, s: np.ndarray, xv: np.ndarray, of: np.ndarray, d: float, x0: float, tol: float) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of many articles at once. Cells ``(w, s, xv)``: word and sentence,
    both numbered over all articles; ``g``: the article of a cell, ``of`` that
    of a word (rising). Every article has its own steps and its own end; those
    that have ended leave the arrays. Returns ranks and what still moves (by
    article; 0 where settled)."""
    size = np.bincount(of)
    n_art, first = len(size), np.append(0, np.cumsum(size)[:-1])
    limit = 10 * np.ceil(np.log(tol / np.maximum(size, 2)) / np.log(d)).astype(int)

    def product(w, s, xv, n):
        n_s = int(s.max(initial=-1)) + 1

        def others(y: np.ndarray) -> np.ndarray:
            """For each word, the sum over its neighbours of weight times y."""
            xy = xv * y[w]
            return np.bincount(w, xv * (np.bincount(s, xy, n_s)[s] - xy), n)
        return others

    others = product(w, s, xv, len(of))
    total = others(np.ones(len(of)))
    inverse = np.divide(1.0, total, out=np.zeros(len(of)), where=total > 0)
    scale = np.sqrt(inverse)
    linked = scale > 0

    def per(v):
        return np.bincount(of, v, n_art)

    def ratio(a, b):
        return np.divide(a, b, out=np.zeros(n_art), where=b > 0)

    # near the solution: conjugate gradients from the ranks without damping
    z = scale * ((1 - d) + d * total * (per(linked) / np.maximum(per(total), 1e-300))[of])
    r = (1 - d) * scale - (z - d * scale * others(scale * z))
    p, rr = r, per(r * r)
    enough = (tol * (1 - d)) ** 2 / np.maximum(np.maximum.reduceat(total, first), 1.0)
    for k in range(int(limit.max()) // 20):
        go = (rr > enough) & (k < limit // 20)
        if not go.any():
            break
        ap = p - d * scale * others(scale * p)
        step = np.where(go, ratio(rr, per(p * ap)), 0.0)[of]
        z, r = z + step * p, r - step * ap
        rr, before = np.where(go, per(r * r), rr), rr
        p = r + ratio(rr, before)[of] * p
    x = np.where(linked, z * np.sqrt(total.clip(min=0.0)), float(x0))
    # plain rounds on the articles that still move
    ranks, moved = x.copy(), np.zeros(n_art)
    arts, words = np.arange(n_art), np.arange(len(of))
    for k in range(int(limit.max())):
        new = (1 - d) + d * others(x * inverse)
        change = np.maximum.reduceat(np.abs(new - x), first)
        x = new
        ranks[words] = x
        moved[arts] = np.where(change < tol * np.maximum(1.0, np.maximum.reduceat(np.abs(x), first)), 0.0, change)
        left = (moved[arts] > 0) & (k + 1 < limit[arts])
        if not left.any():
            break
        if 2 * left.sum() <= len(left) or (k + 1 >= limit[arts]).any():
            stay, cells = left[of], left[g]
            place = np.cumsum(stay) - 1
            w, s, xv, g = place[w[cells]], np.unique(s[cells], return_inverse=True)[1], xv[cells], (np.cumsum(left) - 1)[g[cells]]
            of, x, inverse, words, arts = (np.cumsum(left) - 1)[of[stay]], x[stay], inverse[stay], words[stay], arts[left]
            size = size[left]
            first = np.append(0, np.cumsum(size)[:-1])
            others = product(w, s, xv, len(x))
    return ranks, moved


def text_rank_grouped(xn: DataFrame, group: str = "id", sent: str = "sent",
                      d: float = 0.85, x0: float = 1.0, tol: float = 1e-12,
                      top: int | None = 10) -> DataFrame:
    """K9 + K10 + K11 per article, to convergence.

    Input: the L2-normalised sentence x word table ``(group, sent, word, x)``
    (K7 + K8, computed by Spark). A task takes whole articles, some hundreds at
    a time (``whole_groups``), and its rounds advance these together. Inside a
    group the graph ``X^T X`` without its diagonal is never formed: a product
    with it is ``X^T (X y)`` less the diagonal part, so memory and a round's
    work are linear in the table.

    The ranks solve ``x = (1 - d) + d W D^-1 x``. Scaled by ``D^-1/2`` the system
    is symmetric with eigenvalues in ``[1 - d, 1 + d]``, so conjugate gradients
    come near in a few dozen rounds; plain rounds then end when no rank moves by
    ``tol``; the error then is at most ``tol * d / (1 - d)``. Their change
    shrinks by ``d`` a round, so a group that still moves after ten times the
    rounds this takes from any start is an error.
    Output ``(group, pos, word, rank)`` with rank rounded to 6 digits, the
    ``top`` best per article (all when ``top`` is None).
    """
    gtype = dict(xn.dtypes)[group]

    def solve(t: pa.Table) -> pa.RecordBatch:
        g, ids = group_numbers(t)
        code, spelled = numbers(t.column("word"))
        key, w = np.unique(g * len(spelled) + code, return_inverse=True)
        s = numbers(t.column(sent))[0]
        s = np.unique(g * (s.max() + 1) + s, return_inverse=True)[1]
        of, word = key // len(spelled), key % len(spelled)
        x, moved = _ranks(g, w, s, t.column("x").to_numpy().astype(float), of, d, x0, tol)
        if moved.any():
            at = int(np.argmax(moved))
            raise RuntimeError(f"ranks of group {ids[at].as_py()!r} still move by {moved[at]}")
        # equal ranks that differ in their last bits are rounded alike
        rank = np.floor(np.round(x, 9) * 1e6 + 0.5) / 1e6
        place = np.empty(len(spelled), np.int64)
        place[np.argsort(spelled.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(spelled))
        order = np.lexsort((place[word], -rank, of))
        pos = np.arange(len(order)) - np.searchsorted(of, of)
        keep = slice(None) if top is None else pos < top
        order = order[keep]
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(of[order])), pa.array(pos[keep], pa.int32()), spelled.take(pa.array(word[order])), pa.array(rank[order])],
            names=[group, "pos", "word", "rank"])

    return whole_groups(xn, group, [sent, "word", "x"], "word", solve, f"{group} {gtype}, pos int, word string, rank double")
