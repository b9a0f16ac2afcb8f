"""Sparse long-form vectors: counts, norms, co-occurrence graphs, TF-IDF.

K7-K9, P6-P10, U8. Every matrix of the reference is a ``(group, row, term,
value)`` DataFrame; products are equi-joins on the shared index followed by a
grouped sum, so only non-zero cells ever exist.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions.text import WORD_RE
from presswork.operators.groups import group_numbers, numbers, whole_groups
from presswork.session import cut_lineage


def sentence_counts(tokens: DataFrame, group: str = "id", sent: str = "sent",
                    tokens_col: str = "tokens") -> DataFrame:
    """K7: sentence x word counts. Lower-case, words of 2+ word characters."""
    # the _outer generator: see sentence_rows; its null rows fail the word test
    return (tokens.select(group, sent, F.explode_outer(tokens_col).alias("word"))
            .select(group, sent, F.lower("word").alias("word"))
            .filter(F.col("word").rlike(f"^{WORD_RE}$") & (F.length("word") >= 2))
            .groupBy(group, sent, "word").agg(F.count(F.lit(1)).alias("c")))


def l2_by(df: DataFrame, keys: Sequence[str], value: str = "c", out: str = "x") -> DataFrame:
    """K8: divide ``value`` by the L2 norm of its ``keys`` slice."""
    w = Window.partitionBy(*keys)
    return df.withColumn(out, F.col(value) / F.sqrt(F.sum(F.col(value) * F.col(value)).over(w)))


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """``x`` to ``digits`` digits as Spark's ``round`` has it (half up on the
    shortest decimal). Only what comes within a millionth of a half, or is so
    large that a product could be off by that, goes through decimals."""
    y = np.abs(x) * 10.0**digits
    out = np.copysign(np.floor(y + 0.5) / 10.0**digits, x) + 0.0  # no negative zero
    near = ~((np.abs(y - np.floor(y) - 0.5) > 1e-6) & (y < 1e9))
    if near.any():
        values, at = np.unique(x[near], return_inverse=True)
        unit = Decimal(1).scaleb(-digits)
        exact = [float(Decimal(repr(v)).quantize(unit, ROUND_HALF_UP)) if abs(v) < 1e15 else v for v in values.tolist()]
        out[near] = np.array(exact)[at] + 0.0
    return out


def word_graph(counts: DataFrame, group: str = "id", sent: str = "sent", pairs: int = 500_000, digits: int | None = None) -> DataFrame:
    """K8 + K9: cosine of words over the sentences of one group (X^T X).

    Output ``(group, src, dst, w)`` including the diagonal, without the null
    group; ``w`` to ``digits`` digits if given. A task takes whole groups, some hundreds at a time, and sums the
    pairs of about ``pairs`` sentence x word x word cells at once, so its
    memory is bounded by the square of an article's distinct words, whatever
    the number of articles; pairs are neither sorted nor shuffled by Spark.
    """
    x = l2_by(counts.filter(F.col(group).isNotNull() & F.col(sent).isNotNull()), [group, "word"])

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        g, ids = group_numbers(t)
        code, spelled = numbers(t.column("word"))
        s = numbers(t.column(sent))[0]
        s = g * (s.max() + 1) + s
        order = np.argsort(s, kind="stable")  # groups rise, so sentences stay within them, and words in order within these
        g, code, s, xv = g[order], code[order], s[order], t.column("x").to_numpy().astype(float)[order]
        new = np.append(True, (s[1:] != s[:-1]) | (code[1:] != code[:-1]))
        if not new.all():  # a word listed twice for a sentence
            g, code, s, xv = g[new], code[new], s[new], np.add.reduceat(xv, np.flatnonzero(new))
        start = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        size = np.diff(np.append(start, len(s)))
        from_, many = np.repeat(start, size), np.repeat(size, size)  # of each cell: its sentence
        cells = np.bincount(g, many, len(ids)).cumsum()
        node, at = np.unique(g * len(spelled) + code, return_inverse=True)
        times = np.bincount(at, minlength=len(node))
        once = (times == 1)[at]  # words of one sentence: so are their pairs
        # the other words, numbered within their group: ``n`` of them, the first is ``first``
        often = np.flatnonzero(times > 1)
        first = np.searchsorted(node[often] // len(spelled), np.arange(len(ids) + 1))
        n, number = np.diff(first), np.cumsum(times > 1) - 1
        lo = 0
        while lo < len(ids):
            hi = max(int(np.searchsorted(cells, (cells[lo - 1] if lo else 0) + pairs, "right")), lo + 1)
            r0, r1 = np.searchsorted(g, [lo, hi])
            m = many[r0:r1]
            a = np.repeat(np.arange(r0, r1), m)
            b = np.repeat(from_[r0:r1] - np.append(0, np.cumsum(m)[:-1]), m) + np.arange(len(a))
            single = once[a] | once[b]
            # pairs that may come again, in one of their two orders: one key a pair
            twice = np.flatnonzero(~single)
            twice = twice[at[a[twice]] <= at[b[twice]]]
            a2, b2 = a[twice], b[twice]
            base = np.append(0, np.cumsum(n[lo:hi] ** 2))
            g2 = g[a2]
            key = base[g2 - lo] + (number[at[a2]] - first[g2]) * n[g2] + number[at[b2]] - first[g2]
            if base[-1] <= 4 * len(key):  # few empty cells: a sum by cell
                w, seen = np.bincount(key, xv[a2] * xv[b2], base[-1]), np.bincount(key, minlength=base[-1]) > 0
                key = np.flatnonzero(seen)
                w = w[key]
            else:
                key, inverse = np.unique(key, return_inverse=True)
                w = np.bincount(inverse, xv[a2] * xv[b2], len(key))
            art = np.searchsorted(base, key, "right") - 1
            rest, n2 = key - base[art], np.maximum(n[lo + art], 1)
            src, dst = (node[often[first[lo + art] + k]] % len(spelled) for k in (rest // n2, rest % n2))
            other = src != dst
            a, b = a[single], b[single]
            yield from edges(ids, spelled, g[a], code[a], code[b], xv[a] * xv[b])
            yield from edges(ids, spelled, np.append(art, art[other]) + lo, np.append(src, dst[other]), np.append(dst, src[other]), np.append(w, w[other]))
            lo = hi

    def edges(ids: pa.Array, spelled: pa.Array, of: np.ndarray, src: np.ndarray, dst: np.ndarray, w: np.ndarray) -> Iterator[pa.RecordBatch]:
        w = w if digits is None else rounded(w, digits)
        for i in range(0, len(w), 100_000):
            j = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(of[j])), spelled.take(pa.array(src[j])), spelled.take(pa.array(dst[j])), pa.array(w[j])],
                                             names=[group, "src", "dst", "w"])

    return whole_groups(x, group, [sent, "word", "x"], "word", solve, f"{group} {dict(counts.dtypes)[group]}, src string, dst string, w double")


# ----------------------------------------------------------------------------
# TF-IDF family

def vocab_bound(docs: DataFrame, group: Sequence[str], ntok="ntok") -> DataFrame:
    """Floor of the mean token count per group."""
    return docs.groupBy(*group).agg(F.floor(F.avg(ntok)).cast("int").alias("bound"))


def term_stream(docs: DataFrame, keys: Sequence[str], tokens: str = "tokens",
                stop: Sequence[str] | None = None, n_max: int = 3) -> DataFrame:
    """Lower-case tokens of 2+ word chars, stop words out, then 1..n_max-grams.

    Output one row per (keys..., term) occurrence.
    """
    low = F.transform(F.col(tokens), lambda t: F.lower(t))
    kept = F.filter(low, lambda t: t.rlike(f"^{WORD_RE}$") & (F.length(t) >= 2))
    if stop:
        arr = F.array(*[F.lit(w) for w in sorted(set(stop))])
        kept = F.filter(kept, lambda t: ~F.array_contains(arr, t))
    # one row per word; the following words come by position, not by slicing
    # the whole token array for every start
    words = (docs.select(*keys, F.posexplode_outer(kept).alias("_pos", "_w"))
             .filter(F.col("_w").isNotNull()))
    at = Window.partitionBy(*keys).orderBy("_pos")
    for k in range(1, n_max):
        words = words.withColumn(f"_w{k}", F.lead("_w", k).over(at))
    grams = [F.col("_w")]
    for k in range(1, n_max):
        grams.append(F.concat_ws(" ", "_w", *[f"_w{j}" for j in range(1, k + 1)]))
        grams[k] = F.when(F.col(f"_w{k}").isNotNull(), grams[k])
    return (words.select(*keys, F.explode(F.array(*grams)).alias("term"))
            .filter(F.col("term").isNotNull()))


def term_counts(articles: DataFrame, keys: Sequence[str], tokens: str = "tokens",
                stop: Sequence[str] | None = None, least: int = 2, within: Sequence[str] = ("date",)) -> DataFrame:
    """P7 once per article: ``(keys..., term, tf)`` of terms that ``least``
    articles of the same ``within`` hold. Groups are drawn from one day and
    hold an article at most twice, so a term of P8's three documents is in two
    articles of the day; the others (most n-grams) are left out here, once,
    and not in every group."""
    tf = term_stream(articles, keys, tokens, stop).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))
    often = tf.groupBy(*within, "term").agg(F.count(F.lit(1)).alias("_in")).filter(F.col("_in") >= least).drop("_in")
    return tf.join(often, [*within, "term"], "left_semi").select(*keys, "term", "tf")


def vocabulary(tf: DataFrame, group: Sequence[str], bound: DataFrame, min_df: int = 3) -> DataFrame:
    """Terms with document frequency >= ``min_df``, then the ``bound`` most
    frequent by corpus count (ties: term ascending). ``tf``: one row per
    (group, document, term)."""
    stats = tf.groupBy(*group, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tc"))
    w = Window.partitionBy(*group).orderBy(F.desc("tc"), F.asc("term"))
    return (stats.filter(F.col("df") >= min_df)
            .withColumn("_r", F.row_number().over(w))
            .join(bound, list(group))
            .filter(F.col("_r") <= F.col("bound"))
            .select(*group, "term", "df"))


def tfidf(tf: DataFrame, vocab: DataFrame, docs: DataFrame, group: Sequence[str],
          doc: str) -> DataFrame:
    """``tf * (ln((1+n)/(1+df)) + 1)``, L2-normalised per document.

    ``n`` = documents of the group (all of them, also those without a kept
    term). Output ``(group..., doc, term, w)``.
    """
    n = docs.groupBy(*group).agg(F.count(F.lit(1)).alias("_ndocs"))
    raw = (tf.join(vocab, [*group, "term"]).join(n, list(group))
           .withColumn("v", F.col("tf") * (F.log((1 + F.col("_ndocs")) / (1 + F.col("df"))) + 1)))
    w = Window.partitionBy(*group, doc)
    return raw.select(*group, doc, "term",
                      (F.col("v") / F.sqrt(F.sum(F.col("v") * F.col("v")).over(w))).alias("w"))


def similar_candidates(ranked: DataFrame, group: Sequence[str], doc: str, min_sim: float) -> DataFrame:
    """Pairs ``(group..., a, b)``, ``a < b``, of unit vectors that may reach
    ``min_sim``; ``ranked``: ``(group..., doc, rk, w)`` with terms numbered by
    rarity.

    A vector's prefix ends where the norm of what follows is under ``min_sim``.
    The rarest term that two vectors share starts all that they share, so if
    it lay behind the prefix of one of them, their product would be less than
    that norm: vectors that reach ``min_sim`` share a term of both prefixes."""
    g = list(group)
    walk = Window.partitionBy(*g, doc).orderBy("rk")
    square = F.col("w") * F.col("w")
    ahead = F.sum(square).over(Window.partitionBy(*g, doc)) - (F.sum(square).over(walk.rowsBetween(Window.unboundedPreceding, 0)) - square)
    rare = ranked.withColumn("_ahead", ahead).filter(F.col("_ahead") >= (min_sim - 1e-6) ** 2).select(*g, doc, "rk")
    a, b = rare.withColumnRenamed(doc, "a"), rare.withColumnRenamed(doc, "b")
    return a.join(b, [*g, "rk"]).filter(F.col("a") < F.col("b")).select(*g, "a", "b").distinct()


def cosine_pairs(weights: DataFrame, group: Sequence[str], doc: str, min_sim: float,
                 strict: bool = False, block: int = 128) -> DataFrame:
    """P10: ``(group..., a, b, sim)`` for ``a < b`` with ``round(sim, 6) >=
    min_sim`` (``>`` when ``strict``) by a prefix-filtered join.

    Terms are taken in order of rarity and only prefixes are joined (see
    ``similar_candidates``); the candidates are then computed in full. For that
    they meet their vectors by blocks of ``block`` documents: a task holds two
    blocks at a time, whatever the size of the group.
    """
    import pandas as pd

    g = list(group)
    kinds = dict(weights.dtypes)
    stats = weights.groupBy(*g, "term").agg(F.count(F.lit(1)).alias("df"))
    # a group's terms are bounded by P8's vocabulary
    rank = stats.select(*g, "term", F.row_number().over(Window.partitionBy(*g).orderBy("df", "term")).alias("rk"))
    ranked = cut_lineage(weights.join(rank, [*g, "term"]).select(*g, doc, "rk", "w"))
    found = similar_candidates(ranked, g, doc, min_sim)
    where = (ranked.select(*g, doc).distinct()
             .withColumn("_block", F.floor((F.row_number().over(Window.partitionBy(*g).orderBy(doc)) - 1) / block).cast("int")))
    found = (found.join(where.select(*g, F.col(doc).alias("a"), F.col("_block").alias("_ba")), [*g, "a"])
             .join(where.select(*g, F.col(doc).alias("b"), F.col("_block").alias("_bb")), [*g, "b"]))
    found = cut_lineage(found.select(*g, "_ba", "_bb", "a", "b"))
    vectors = (ranked.groupBy(*g, doc).agg(F.collect_list("rk").alias("rks"), F.collect_list("w").alias("ws"))
               .join(where, [*g, doc]))
    needs = found.select(*g, "_ba", "_bb").distinct()
    sides = vectors.join(needs.withColumn("_block", F.col("_ba")), [*g, "_block"]).unionByName(
        vectors.join(needs.filter("_ba <> _bb").withColumn("_block", F.col("_bb")), [*g, "_block"]))
    schema = ", ".join([f"{c} {kinds[c]}" for c in g] + [f"a {kinds[doc]}", f"b {kinds[doc]}", "sim double"])

    def run(key, pairs: pd.DataFrame, vecs: pd.DataFrame) -> pd.DataFrame:
        at = pd.Series(np.arange(len(vecs)), index=vecs[doc].to_numpy())
        row = np.repeat(np.arange(len(vecs)), vecs["rks"].map(len))
        terms, col = np.unique(np.concatenate([np.zeros(0, np.int64), *vecs["rks"]]), return_inverse=True)
        W = np.zeros((len(vecs), len(terms)))
        W[row, col] = np.concatenate([np.zeros(0), *vecs["ws"]])
        i, j = at[pairs["a"]].to_numpy(), at[pairs["b"]].to_numpy()
        sim = np.round((W @ W.T)[i, j], 6)
        keep = sim > min_sim if strict else sim >= min_sim
        out = pd.DataFrame({"a": pairs["a"].to_numpy()[keep], "b": pairs["b"].to_numpy()[keep], "sim": sim[keep]})
        for k, c in enumerate(g):
            out.insert(k, c, key[k])
        return out

    by = [*g, "_ba", "_bb"]

    def renewed(df: DataFrame, *cols: str) -> DataFrame:
        """Fresh attribute ids: both sides come from one table."""
        return df.select(*[F.col(c).alias(c) for c in (*by, *cols)])

    return renewed(found, "a", "b").groupBy(*by).cogroup(renewed(sides, doc, "rks", "ws").groupBy(*by)).applyInPandas(run, schema)


def mirror_pairs(pairs: DataFrame) -> DataFrame:
    """Both orientations of half pairs ``a < b``."""
    cols = [c for c in pairs.columns if c not in ("a", "b")]
    ends = F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.select(*cols, F.inline(ends)).select(*pairs.columns)
