"""Related-article clustering: P3-P18.

Groups are ``(date, mix_id)``: one combo of one day. Every step is a join,
window or aggregation keyed by the group. Texts are read once: groups hold ids,
and meet the terms of an article by its id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions.text import word_tokens
from presswork.operators import vectors as V
from presswork.operators.components import components
from presswork.session import cut_lineage

G = ["date", "mix_id"]


def pos_tokens(df: DataFrame, col: str = "content", out: str = "tokens") -> DataFrame:
    """Word tokens with no stop or length filter (analyser hook: K6)."""
    return df.withColumn(out, word_tokens(col))


def min_tokens(df: DataFrame, n: int = 40, tokens: str = "tokens") -> DataFrame:
    """P5: drop documents with fewer than ``n`` tokens."""
    return df.filter(F.size(tokens) >= n)


def tfidf_weights(docs: DataFrame, counts: DataFrame, group: Sequence[str], doc: str = "n",
                  article: Sequence[str] = ("date", "id")) -> DataFrame:
    """P6, P8, P9 for every group: ``(group..., doc, term, w)``. ``docs``:
    ``(group..., doc, article..., ntok)``; ``counts``: P7's ``(article...,
    term, tf)``, made once for all groups that an article is in."""
    g = list(group)
    keys = list(dict.fromkeys([*g, doc, *article]))
    tf = docs.select(*keys).join(counts, list(article)).select(*g, doc, "term", "tf")
    return V.tfidf(tf, V.vocabulary(tf, g, V.vocab_bound(docs, g), 3), docs, g, doc)


def drop_near_duplicates(docs: DataFrame, weights: DataFrame, group: Sequence[str] = tuple(G),
                         doc: str = "n", tau: float = 0.98) -> DataFrame:
    """Per row ``i`` the set ``S_i = {j : sim(i, j) > tau}`` (with ``i``);
    every member of ``S_i`` above its minimum is dropped (two-hop, stronger
    than a greedy pass)."""
    pairs = V.cosine_pairs(weights, group, doc, tau, strict=True)
    gone = two_hop_drops(pairs, group).withColumnRenamed("node", doc)
    return docs.join(gone, [*group, doc], "left_anti")


def two_hop_drops(pairs: DataFrame, group: Sequence[str]) -> DataFrame:
    """P11's rule on similar pairs ``(group..., a, b)``, ``a < b``: the
    ``(group..., node)`` that go."""
    g = list(group)
    near = V.mirror_pairs(pairs.select(*g, "a", "b"))
    own = near.select(*g, "a", F.col("a").alias("b")).distinct()
    s = near.unionByName(own)
    first = s.groupBy(*g, "a").agg(F.min("b").alias("m"))
    return s.join(first, [*g, "a"]).filter("b > m").select(*g, F.col("b").alias("node")).distinct()


def dbscan(docs: DataFrame, weights: DataFrame, group: Sequence[str] = tuple(G), doc: str = "n",
           eps: float = 0.5, min_pts: int = 4) -> DataFrame:
    """Density clustering on cosine distance (neighbour: ``1 - sim <= eps``).
    Output ``(group..., doc, label)``."""
    pairs = V.cosine_pairs(weights, group, doc, round(1.0 - eps, 6))
    return density_labels(docs, pairs, group, doc, min_pts)


def density_labels(docs: DataFrame, pairs: DataFrame, group: Sequence[str] = tuple(G), doc: str = "n",
                   min_pts: int = 4) -> DataFrame:
    """P12's rule on neighbours ``(group..., a, b)``, ``a < b``.

    Core = at least ``min_pts`` neighbours including itself. Core points that
    are neighbours are in one cluster (``components``); clusters are numbered
    by their smallest core point; a border point takes the smallest label among
    its core neighbours; others -1.
    """
    g = list(group)
    near = cut_lineage(V.mirror_pairs(pairs.select(*g, "a", "b")))
    # a point without neighbours is core only where it is enough by itself
    many = near.groupBy(*g, "a").agg(F.count(F.lit(1)).alias("deg"))
    core = cut_lineage(docs.select(*g, F.col(doc).alias("a")).join(many, [*g, "a"], "left")
                       .filter(F.coalesce("deg", F.lit(0)) + 1 >= min_pts).select(*g, "a"))
    links = (near.filter("a < b").join(core, [*g, "a"], "left_semi")
             .join(core.withColumnRenamed("a", "b"), [*g, "b"], "left_semi"))
    met = components(links, g).withColumnRenamed("node", "a")
    label = (F.dense_rank().over(Window.partitionBy(*g).orderBy("c")) - 1).cast("int")
    labels = cut_lineage(core.join(met, [*g, "a"], "left").select(*g, "a", F.coalesce("component", "a").alias("c"))
                         .select(*g, "a", label.alias("label")))
    border = (near.join(labels.select(*g, F.col("a").alias("b"), "label"), [*g, "b"])
              .groupBy(*g, "a").agg(F.min("label").alias("beside")))
    return (docs.select(*g, F.col(doc).alias("a")).join(labels, [*g, "a"], "left").join(border, [*g, "a"], "left")
            .select(*g, F.col("a").alias(doc), F.coalesce("label", "beside", F.lit(-1)).cast("int").alias("label")))


def cluster_report(labels: DataFrame, group: Sequence[str] = tuple(G)) -> DataFrame:
    """Per group: clusters, noise (-1), label-0 count and total."""
    return labels.groupBy(*group).agg(
        F.count_distinct(F.when(F.col("label") >= 0, F.col("label"))).alias("clusters"),
        F.sum(F.when(F.col("label") == -1, 1).otherwise(0)).alias("noise"),
        F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("label0"),
        F.count(F.lit(1)).alias("total"))


def candidate_clusters(labels: DataFrame, group: Sequence[str] = tuple(G), min_size: int = 4,
                       parity: bool = False) -> DataFrame:
    """Clusters with label >= 1 and at least ``min_size`` articles
    (label 0 counts as noise). ``parity``: also skip the last label when a
    group has no -1 row, as the source does."""
    g = list(group)
    sizes = labels.groupBy(*g, "label").agg(F.count(F.lit(1)).alias("size"))
    out = sizes.filter((F.col("label") >= 1) & (F.col("size") >= min_size))
    if parity:
        w = Window.partitionBy(*g)
        meta = sizes.withColumn("has_noise", F.max((F.col("label") == -1).cast("int")).over(w)) \
                    .withColumn("last", F.max("label").over(w)).select(*g, "label", "has_noise", "last")
        out = out.join(meta, [*g, "label"]).filter(
            ~((F.col("has_noise") == 0) & (F.col("label") == F.col("last")))).drop("has_noise", "last")
    return out


def cluster_terms(docs: DataFrame, counts: DataFrame, labels: DataFrame, cands: DataFrame, group: Sequence[str] = tuple(G),
                  doc: str = "n", n: int = 20) -> DataFrame:
    """Top ``n`` terms of each candidate cluster by mean TF-IDF, refitted
    inside the cluster. Output ``(group..., label, term, score)``."""
    g = list(group)
    cd = cut_lineage(docs.join(labels, [*g, doc]).join(cands.select(*g, "label"), [*g, "label"], "left_semi"))
    w = tfidf_weights(cd, counts, [*g, "label"], doc)
    nd = cd.groupBy(*g, "label").agg(F.count(F.lit(1)).alias("nd"))
    sc = (w.groupBy(*g, "label", "term").agg(F.sum("w").alias("s")).join(nd, [*g, "label"])
          .select(*g, "label", "term", F.round(F.col("s") / F.col("nd"), 6).alias("score")))
    rk = Window.partitionBy(*g, "label").orderBy(F.desc("score"), F.asc("term"))
    return sc.withColumn("_r", F.row_number().over(rk)).filter(F.col("_r") <= n).drop("_r")


def coverage(terms: DataFrame, words: DataFrame, group: Sequence[str] = tuple(G)) -> DataFrame:
    """Query words found as substrings of the joined term text.
    ``words``: ``(group..., qwords array)``."""
    g = list(group)
    txt = terms.groupBy(*g, "label").agg(
        F.array_join(F.array_sort(F.collect_list("term")), " ").alias("text"))
    j = txt.join(words, g)
    return j.select(*g, "label", F.size(F.filter("qwords", lambda x: F.col("text").contains(x))).alias("hits"),
                    F.size("qwords").alias("nwords"))


def pick_cluster(cov: DataFrame, cands: DataFrame, group: Sequence[str] = tuple(G)) -> DataFrame:
    """Full coverage first, else exactly one word missing; larger size
    wins; ties by lowest label; none -> the combo fails (no row)."""
    g = list(group)
    j = cov.join(cands, [*g, "label"])
    j = j.withColumn("tier", F.when(F.col("hits") == F.col("nwords"), 0)
                     .when(F.col("hits") == F.col("nwords") - 1, 1))
    w = Window.partitionBy(*g).orderBy("tier", F.desc("size"), "label")
    return (j.filter(F.col("tier").isNotNull()).withColumn("_r", F.row_number().over(w))
            .filter("_r = 1").drop("_r"))
