"""Quality classifier: Bradley-Terry pairwise ranking over surface features.

A text is a vector of surface features (symbol, case, repetition, list and
length measures, counted over its whole bytes). From labelled texts preference
pairs (better, worse) are drawn; the weights minimise the logistic loss of
``w . (f(better) - f(worse))``, the Bradley-Terry likelihood of the pairs. The
raw score ``w . f`` ranks texts; the threshold is the quantile of the labelled
scores at the share of worse labels, and the reported score is a logistic
curve of the raw score that passes ``cut`` at that quantile.

Defined results: null and empty texts have the feature vector of an empty
text and get a score like any other; repeated rows get equal scores; null
labels and labels without a document teach nothing; a repeated label row
counts once (the smallest). Without both classes every score is the share of
better labels (0.5 without labels). Every labelled text enters the fit, its
pairs, the threshold and the curve: the rows lie in blocks chosen by a hash of
the id, pairs are drawn within a block, and each step of the fit is one pass
that sums 16 x 16 numbers over the blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm import bytesops as B
from presswork.llm.common import cut_lineage

#: Names of the features, in the order of the vector.
FEATURES = ("words", "word_bytes", "symbols", "bars", "marks", "upper", "digits", "stops", "distinct",
            "top_word", "same_next", "pairs_again", "wide", "short", "lines", "mid_symbols")


@dataclass(frozen=True)
class Settings:
    block: int = 6000      # labelled texts of the larger class in a block of pairs
    least: int = 64        # of the smaller class in a block: fewer than this are put into several
    pairs_each: int = 6    # preference pairs per labelled text
    cut: float = 0.7
    l2: float = 1e-3


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    threshold: float
    slope: float
    offset: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale).clip(-8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.raw(x) - self.threshold) + self.offset
        return 1 / (1 + np.exp(-z.clip(-700, 700)))


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


_BAR, _MARK, _STOP = _table("|"), _table("!?"), _table(".,;:")
_SYMBOL = np.array([32 < b < 127 and not chr(b).isalnum() for b in range(256)]) & ~_BAR & ~_MARK & ~_STOP & ~_table("'\"()-")
_UPPER, _LOWER_ = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("abcdefghijklmnopqrstuvwxyz")
_DIGIT, _LINE = _table("0123456789"), _table("\n")


def _runs(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many distinct keys, and how often its commonest one is there."""
    at = B.run_starts(B.sort_within(keys.copy(), first), first)
    size = np.diff(np.append(at, len(keys)))
    cut = np.searchsorted(at, first)
    n, top = np.diff(cut), np.zeros(len(first) - 1)
    if len(at):
        top[n > 0] = np.maximum.reduceat(size, cut[:-1][n > 0])
    return n.astype(float), top


def features(col: pa.Array) -> np.ndarray:
    data, offs = B.text_buffers(col)
    out = np.empty((len(col), len(FEATURES)))
    for a, b, part, o in B.chunks(data, offs):
        n = b - a

        def count(mask):
            total = np.concatenate([[0], np.cumsum(mask)])
            return (total[o[1:]] - total[o[:-1]]).astype(float)

        w = B.words(part, o, lower=True)
        doc, nw = w.doc, w.counts.astype(float)
        size = np.maximum(np.diff(o), 1.0)
        some = np.maximum(nw, 1.0)
        length = (w.end - w.start).astype(float)
        distinct, top = _runs(w.hash, w.first)
        at, d2 = B.window_starts(w.first, 2)
        same = np.bincount(d2, w.hash[at] == w.hash[at + 1], n) if len(at) else np.zeros(n)
        pairs, _ = _runs(B.window_hashes(w.hash, 2)[at], np.concatenate([[0], np.cumsum(np.maximum(w.counts - 1, 0))]))
        letters = np.maximum(count(_LOWER_[part]) + count(_UPPER[part]), 1.0)
        symbol = _SYMBOL[part] | _MARK[part]
        ends = np.bincount(doc, symbol[w.end - 1], n) if len(doc) else np.zeros(n)
        f = np.column_stack([
            np.log1p(nw), np.bincount(doc, length, n) / some, np.log1p(50 * count(_SYMBOL[part]) / size),
            np.log1p(50 * count(_BAR[part]) / size), np.log1p(50 * count(_MARK[part]) / size), count(_UPPER[part]) / letters,
            count(_DIGIT[part]) / size, np.log1p(10 * count(_STOP[part]) / some), distinct / some ** 0.8, top / some, np.log1p(20 * same / some),
            1 - pairs / np.maximum(nw - 1, 1.0), np.bincount(doc, length > 20, n) / some, np.bincount(doc, length < 3, n) / some,
            np.log1p(100 * count(_LINE[part]) / size), np.log1p(20 * ends / some)])
        f[nw == 0, 1:] = 0.0
        out[a:b] = f
    return out


def feature_table(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, x array<double>)`` for each row of ``docs``: one pass over the texts."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        for b in batches:
            x = features(b.column(1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), flat], names=["doc_id", "x"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, x array<double>")


def _blocks(have: DataFrame, share: dict[int, int], s: Settings) -> DataFrame:
    """``(block, doc_id, y, x, own)``: the labelled rows in blocks by a hash of
    the id. Where the smaller class is too small for all blocks its rows are
    copied into as many as it takes; ``own`` is true for one of the copies."""
    n = -(-max(share.values()) // s.block)
    few = min(share, key=lambda c: (share[c], c))
    copies = min(n, -(-n * s.least // share[few])) if n > 1 else 1
    h = F.xxhash64("doc_id")
    at = F.when(F.col("y") == few, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    return (have.select("doc_id", "y", "x", h.alias("_h"), F.explode(at).alias("_c"))
            .select(F.pmod(F.col("_h") + F.col("_c") * F.lit(max(n // copies, 1)), F.lit(n)).cast("int").alias("block"),
                    "doc_id", "y", "x", (F.col("_c") == 0).alias("own"), "_h"))


def _packed(rows: DataFrame) -> DataFrame:
    """One row a block: its texts by class in the order of their hash, as flat
    lists ``low``, ``high`` (all that it holds) and ``own0``, ``own1``."""
    def listed(c, own):
        cond = (F.col("y") == c) & F.col("own") if own else F.col("y") == c
        got = F.array_sort(F.collect_list(F.when(cond, F.struct("_h", "doc_id", "x"))))
        return F.flatten(F.transform(got, lambda r: r["x"]))

    return rows.groupBy("block").agg(listed(0, False).alias("low"), listed(1, False).alias("high"), listed(0, True).alias("own0"), listed(1, True).alias("own1"))


def _summed(packed: DataFrame, value, *columns: str) -> np.ndarray:
    """Sum over the blocks of ``value(block, arrays of its columns)``, a flat
    array; a task sends one, added up in the order of the tasks."""
    def run(batches):
        total = None
        for b in batches:
            for i in range(b.num_rows):
                rows = [b.column(j + 1)[i].values.to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)) for j in range(len(columns))]
                v = value(b.column(0)[i].as_py(), *rows)
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(total)], pa.int32()), pa.array(total))], names=["v"])

    got = packed.select("block", *columns).mapInArrow(run, "v array<double>").collect()
    return np.sum([r["v"] for r in got], axis=0)


def _pairs(block: int, low: np.ndarray, high: np.ndarray, s: Settings) -> np.ndarray:
    """Differences of the block's preference pairs, the same in every pass."""
    if not len(low) or not len(high):
        return np.zeros((0, len(FEATURES)))
    m = s.pairs_each * max(len(low), len(high))
    rng = np.random.default_rng(17 if block == 0 else [17, block])
    return high[np.arange(m) % len(high)] - low[rng.integers(0, len(low), m)]


def _middle(raw: DataFrame, k: int, n: int) -> float:
    """Half-way between the ``k``-th and the next of ``n`` values ``raw``: a
    bracket by quantiles of bounded error, then the values inside, counted."""
    err = 1e-4
    lo, hi = raw.approxQuantile("raw", [max(k / n - 2 * err - 1 / n, 0.0), min(k / n + 2 * err + 2 / n, 1.0)], err)
    below = raw.where(F.col("raw") < lo).count()
    inside = raw.where(F.col("raw").between(lo, hi)).groupBy("raw").count().orderBy("raw").collect()
    upto = below + np.cumsum([r["count"] for r in inside])
    values = [r["raw"] for r in inside]
    a, b = int(np.searchsorted(upto, k)), int(np.searchsorted(upto, k + 1))
    return float((values[a] + values[b]) / 2)


def fit(table: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", label: str = "quality") -> Model:
    """Learns from all labelled rows of a feature table; the driver gets sums."""
    one = (labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("y"))
           .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.min("y").alias("y")))
    have = cut_lineage(table.join(one, "doc_id").dropDuplicates(["doc_id"]))
    share = {r["y"]: r["n"] for r in have.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    k = len(FEATURES)
    if not share.get(0) or not share.get(1):
        p = share.get(1, 0) / max(sum(share.values()), 1) if share else 0.5
        p = min(max(p, 1e-6), 1 - 1e-6)
        return Model(np.zeros(k), np.zeros(k), np.ones(k), 0.0, 1.0, float(np.log(p / (1 - p))))
    packed = cut_lineage(_packed(_blocks(have, share, s)))
    n = share[0] + share[1]
    mean = _summed(packed, lambda _, a, b: a.sum(0) + b.sum(0), "own0", "own1") / n
    scale = np.sqrt(_summed(packed, lambda _, a, b: ((a - mean) ** 2).sum(0) + ((b - mean) ** 2).sum(0), "own0", "own1") / n) + 1e-9

    def scaled(x):
        return ((x - mean) / scale).clip(-8, 8)

    w = np.zeros(k)
    for _ in range(40):  # Newton steps of the Bradley-Terry likelihood
        def part(block, low, high, w=w):
            diff = _pairs(block, scaled(low), scaled(high), s)
            p = 1 / (1 + np.exp(-(diff @ w).clip(-40, 40)))
            return np.concatenate([[len(diff)], diff.T @ (p - 1), ((diff * (p * (1 - p))[:, None]).T @ diff).ravel()])

        got = _summed(packed, part, "low", "high")
        m = got[0]
        step = np.linalg.solve(got[k + 1:].reshape(k, k) / m + s.l2 * np.eye(k), got[1:k + 1] / m + s.l2 * w)
        w = w - step * min(1.0, 5.0 / (np.linalg.norm(step) + 1e-12))
        if np.abs(step).max() < 1e-9:
            break

    def raws(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(scaled(b.column(0).flatten().to_numpy().reshape(-1, k)) @ w)], names=["raw"])

    threshold = _middle(cut_lineage(have.select("x").mapInArrow(raws, "raw double")), share[0], n)
    offset, slope = float(np.log(s.cut / (1 - s.cut))) + 1e-9, 1.0
    for _ in range(60):  # slope of the reporting curve
        def curve(_, low, high, slope=slope):
            out = np.zeros(2)
            for y, x in ((0, low), (1, high)):
                t = scaled(x) @ w - threshold
                p = 1 / (1 + np.exp(-(slope * t + offset).clip(-40, 40)))
                out += [((p - y) * t).sum(), (p * (1 - p) * t * t).sum()]
            return out

        first, second = _summed(packed, curve, "own0", "own1") / n
        g, h = first + 1e-3 * slope, second + 1e-3
        before = slope
        slope = max(slope - g / h, 1e-3) if abs(g / h) < 2 else slope - np.sign(g) * min(1.0, slope / 2)
        if abs(slope - before) < 1e-13 * max(1.0, abs(slope)):
            break
    return Model(w, mean, scale, threshold, float(slope), offset)


def score_table(table: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` from a feature table."""
    kind = dict(table.dtypes)["doc_id"]

    def run(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    return table.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double")


def rank_quality(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), text: str = "text", id_col: str = "doc_id",
                 teach=None) -> DataFrame:
    """``(doc_id, score)`` per row of ``docs``; ``teach``: condition on ``doc_id``
    that says which rows may teach. The texts are read once: their features
    (16 numbers a row) are written to the checkpoint folder and used twice."""
    table = cut_lineage(feature_table(docs, text, id_col))
    model = fit(table if teach is None else table.where(teach), labels, s, id_col)
    return score_table(table, model)
