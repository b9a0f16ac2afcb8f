"""Extractive summaries: U1-U16.

Groups are ``(date, keyword)`` (single-keyword path) or ``(date, combo)``.
Sentence rows come from Spark (split, filter, tokens); the pairwise sentence
graph is a self equi-join on shared tokens; the order-dependent redundancy
rule is decided in rounds over the pairs that overlap, all groups together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions.text import split_sentences, word_tokens
from presswork.session import co_partition_on_group, cut_lineage, group_partitions


def combo_of(key) -> F.Column:
    """The combo of a ``<combo>_<n>`` key (text before the first '_')."""
    return F.substring_index(F.col(key) if isinstance(key, str) else key, "_", 1)


def cap_articles(df: DataFrame, group: Sequence[str], order: Sequence, n: int = 20) -> DataFrame:
    """At most ``n`` articles per group, in key order."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def sentence_rows(df: DataFrame, keys: Sequence[str], text: str = "content",
                  max_len: int = 190) -> DataFrame:
    """U3 + U4: sentences (``.!?`` not between digits), empty or longer than
    ``max_len`` dropped. Output ``(keys..., spos, sentence)``."""
    s = df.select(*keys, F.posexplode_outer(split_sentences(text)).alias("spos", "sentence"))
    return s.filter(F.col("sentence").isNotNull() & (F.length("sentence") > 0)
                    & (F.length("sentence") <= max_len))


def sentence_tokens(df: DataFrame) -> DataFrame:
    """Noun tokens of each sentence (word tokens; analyser hook as K6)."""
    return df.withColumn("tokens", word_tokens("sentence"))


def drop_redundant(sents: DataFrame, group: Sequence[str], order: Sequence[str],
                   threshold: float = 0.7, denominator: str = "max",
                   stop_at_empty: bool = False) -> DataFrame:
    """Keep a sentence when, against every earlier kept one, shared
    distinct tokens / (max or min of the two list lengths) < ``threshold``.

    Sentences without tokens are dropped (or end the group when
    ``stop_at_empty``, the combo path of the source). The pairs that overlap
    too much come from a join on rare tokens (``overlap_pairs``); rounds then
    decide, all groups at once, what the sequential rule would (``decide``).
    Columns: group, order, sentence, tokens.
    """
    if denominator not in ("max", "min"):
        raise ValueError("denominator is 'max' or 'min'")
    g = list(group)
    walk = Window.partitionBy(*g).orderBy(*order)
    s = sents.select(*g, *order, "sentence", "tokens").withColumn("_len", F.size(F.coalesce("tokens", F.array())))
    if stop_at_empty:
        ended = F.max((F.col("_len") == 0).cast("int")).over(walk.rowsBetween(Window.unboundedPreceding, 0))
        s = s.withColumn("_ended", ended).filter("_ended = 0").drop("_ended")
    s = s.filter("_len > 0").withColumn("_i", F.row_number().over(walk))
    s = cut_lineage(s.withColumn("_set", F.array_sort(F.array_distinct("tokens"))))
    # equal lists that overlap each other enough: all but the first go, whatever
    # becomes of the first, so they need no pairs
    near_self = F.size("_set") >= threshold * F.col("_len")
    s = s.withColumn("_copy", near_self & (F.row_number().over(Window.partitionBy(*g, "_set", "_len").orderBy("_i")) > 1))
    s = s.filter(~F.col("_copy")).drop("_copy")
    gone = decide(overlap_pairs(s, g, threshold, denominator), g)
    return s.join(gone.withColumnRenamed("node", "_i"), [*g, "_i"], "left_anti").select(*g, *order, "sentence", "tokens")


def overlap_pairs(s: DataFrame, g: Sequence[str], threshold: float, denominator: str) -> DataFrame:
    """Pairs ``(group..., a, b)``, ``a < b``, of rows ``(group..., _i, _set, _len)``
    whose sets share ``threshold`` of the larger (``max``) or smaller length.

    A row whose length sets the denominator needs ``ceil(threshold * len)`` of
    its own tokens in the other set, so one of its ``size - need + 1`` rarest is
    shared; with ``max`` that holds for both rows of a pair. Only these
    prefixes are joined, frequent words rarely among them; the pairs met are
    then counted in full."""
    g = list(g)
    need = F.ceil(threshold * F.col("_len") - 1e-9)
    words = s.select(*g, "_i", "_len", (F.size("_set") - need + 1).alias("_p"), F.explode("_set").alias("tok"))
    df = words.groupBy(*g, "tok").agg(F.count(F.lit(1)).alias("df"))
    by_rarity = Window.partitionBy(*g, "_i").orderBy("df", "tok")
    words = words.join(df, [*g, "tok"]).withColumn("_r", F.row_number().over(by_rarity))
    rare = words.filter("_r <= _p")
    left = rare.select(*g, "tok", F.col("_i").alias("x"), F.col("_len").alias("lx"))
    right = (rare if denominator == "max" else words).select(*g, "tok", F.col("_i").alias("y"), F.col("_len").alias("ly"))
    side = (F.col("x") < F.col("y")) if denominator == "max" else (F.col("x") != F.col("y")) & (F.col("lx") <= F.col("ly"))
    met = (left.join(right, [*g, "tok"]).filter(side)
           .select(*g, F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    one = s.select(*g, F.col("_i").alias("a"), F.col("_set").alias("_sa"), F.col("_len").alias("_la"))
    two = s.select(*g, F.col("_i").alias("b"), F.col("_set").alias("_sb"), F.col("_len").alias("_lb"))
    both = met.join(one, [*g, "a"]).join(two, [*g, "b"])
    den = F.greatest("_la", "_lb") if denominator == "max" else F.least("_la", "_lb")
    return both.filter(F.size(F.array_intersect("_sa", "_sb")) / den >= threshold).select(*g, "a", "b")


def decide(pairs: DataFrame, g: Sequence[str]) -> DataFrame:
    """``(group..., node)`` of the nodes that the rule "keep a node unless an
    earlier kept one is paired with it" drops, given pairs ``a < b``.

    A round keeps every node that has no earlier undecided neighbour and drops
    the later neighbours of these; the pairs of dropped nodes no longer count.
    Rounds end when no pair is left (at most as many as the longest chain)."""
    g = list(g)
    gone, left = None, cut_lineage(pairs)
    while not left.isEmpty():
        first = left.select(*g, "a").distinct().join(left.select(*g, F.col("b").alias("a")).distinct(), [*g, "a"], "left_anti")
        out = cut_lineage(left.join(first, [*g, "a"]).select(*g, F.col("b").alias("node")).distinct())
        gone = out if gone is None else gone.unionByName(out)
        left = cut_lineage(left.join(out.withColumnRenamed("node", "b"), [*g, "b"], "left_anti")
                           .join(out.withColumnRenamed("node", "a"), [*g, "a"], "left_anti").select(*g, "a", "b"))
    return gone if gone is not None else left.select(*g, F.col("a").alias("node"))


def sentence_graph(sents: DataFrame, group: Sequence[str], node: str = "node") -> DataFrame:
    """U8: ``|A n B| / ((ln(|A|+1)+1) + (ln(|B|+1)+1))`` on distinct token sets,
    via a self equi-join on (group, token) of the half ``src < dst``, mirrored
    after the count; zero diagonal. Sentences are partitioned by their group
    once (U2 bounds it); the join, the count and what is grouped next by the
    group follow there, so pairs are never shuffled.
    Output ``(group..., src, dst, w)`` for pairs sharing a token."""
    g, spark = list(group), sents.sparkSession
    co_partition_on_group(spark)
    d = sents.select(*g, node, F.array_distinct("tokens").alias("t")).repartition(group_partitions(spark), *g)
    ex = d.select(*g, node, F.size("t").alias("size"), F.explode("t").alias("tok"))
    a = ex.select(*g, F.col(node).alias("src"), F.col("size").alias("sa"), "tok")
    b = ex.select(*g, F.col(node).alias("dst"), F.col("size").alias("sb"), "tok")
    j = a.join(b, [*g, "tok"]).filter(F.col("src") < F.col("dst"))
    weight = F.col("inter") / (F.log(F.col("sa") + 1) + 1 + (F.log(F.col("sb") + 1) + 1))
    half = (j.groupBy(*g, "src", "dst").agg(F.count(F.lit(1)).alias("inter"), F.first("sa").alias("sa"), F.first("sb").alias("sb"))
            .select(*g, "src", "dst", weight.alias("w")))
    ends = F.array(F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
                   F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return half.select(*g, F.inline(ends), "w").select(*g, "src", "dst", "w")


def summary_in_order(scores: DataFrame, sents: DataFrame, group: Sequence[str], n: int = 5,
                     node: str = "node", score: str = "score") -> DataFrame:
    """Top ``n`` sentences by score (ties: later position first, as a
    stable ascending sort takes the last ones), printed in original order,
    each followed by ``^^^``."""
    g = list(group)
    j = scores.join(sents.select(*g, node, "sentence"), [*g, node])
    w = Window.partitionBy(*g).orderBy(F.desc(F.round(score, 6)), F.desc(node))
    top = j.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    return top.groupBy(*g).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(node, "sentence"))),
        lambda s: F.concat(s["sentence"], F.lit("^^^"))), "").alias("summary"))


def summary_by_score(scores: DataFrame, sents: DataFrame, group: Sequence[str], n: int = 4,
                     node: str = "node", score: str = "rank") -> DataFrame:
    """Top ``n`` sentences by score in score order (ties: node order)."""
    g = list(group)
    j = scores.join(sents.select(*g, node, "sentence"), [*g, node])
    w = Window.partitionBy(*g).orderBy(F.desc(F.round(score, 6)), F.asc(node))
    top = j.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    return top.groupBy(*g).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_r", "sentence"))),
        lambda s: F.concat(s["sentence"], F.lit("^^^"))), "").alias("summary"))
