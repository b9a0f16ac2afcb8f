"""Toxicity: character n-gram linear classifier with naive Bayes scaled features.

Each text is the set of its character n-grams (``min_n`` to ``max_n`` bytes of
UTF-8, A-Z lower-cased, every white-space byte read as a space), hashed into
``2**bits`` slots. With document counts p (toxic) and q (clean) of a slot, its
log-count ratio is ``r = log((p+1)/(P+2)) - log((q+1)/(Q+2))``; the features of
a text are ``r`` for each slot that it has, and a logistic regression is
fitted on them. Slots whose counts do not differ significantly between the
classes (likelihood ratio statistic below ``min_g``) have no weight; all others have.

Defined results: a null or empty text has no features and gets the score of
the intercept; repeated rows get equal scores; labels that are null or whose
document is absent teach nothing; without both classes in the labels every
score is the share of toxic labels (0.5 without labels). Scores use only the
text. Repeated label rows of a document count once (toxic if any says so);
of repeated rows of a labelled id the greatest text teaches, once.

The fit uses at most ``max_rows`` labelled texts per class (chosen by a hash
of the id, so that the choice does not depend on the order of rows). In the
logistic loss each stands for its share of its class's labelled texts, so the
intercept is that of all labels; the ratios r are of shares within a class,
which the choice does not move. Scoring covers every row and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm import bytesops as B
from presswork.llm.common import cut_lineage


@dataclass(frozen=True)
class Settings:
    min_n: int = 3
    max_n: int = 6
    bits: int = 22
    max_rows: int = 5000       # labelled texts per class used for the fit
    min_g: float = 15.0        # least likelihood ratio statistic of a slot's counts
    l2: float = 1.0


@dataclass(frozen=True)
class Model:
    settings: Settings
    slots: np.ndarray    # int64, sorted
    weights: np.ndarray  # weight times log-count ratio
    bias: float


_CHARS = np.arange(256, dtype=np.uint32)
_CHARS[:] = B.LOWER
_CHARS[list(B.SPACE_BYTES)] = 0x20
_MUL = np.uint32(0x01000193)


def _slots(data: np.ndarray, s: Settings) -> Iterator[tuple[int, np.ndarray]]:
    """For each n: the slot of the n-gram at each byte (they may cross texts)."""
    x = (_CHARS[data] + np.uint32(1)) * np.uint32(0x9E3779B1)
    h = np.zeros(len(data), np.uint32)
    for n in range(1, s.max_n + 1):
        if len(data) < n:
            return
        h = h[:len(data) - n + 1] * _MUL
        h += x[n - 1:]
        if n >= s.min_n:
            g = h * np.uint32(0x85EBCA6B + 2 * n)
            g >>= np.uint32(32 - s.bits)
            yield n, g


def slot_sets(col: pa.Array, s: Settings, keep: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per chunk of texts: first and end text, then (text, slot) pairs without
    repeats, ordered by text. ``keep``: mask of the slots wanted."""
    data, offs = B.text_buffers(col)
    for a, b, part, o in B.chunks(data, offs, 1 << 19):
        pairs = []
        for n, g in _slots(part, s):
            at = np.arange(len(g)) if keep is None else np.flatnonzero(keep[g])
            doc = np.searchsorted(o, at, "right") - 1
            inside = at + n <= o[doc + 1]
            pairs.append(np.unique((doc[inside].astype(np.int64) << s.bits) | g[at[inside]]))
        both = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        yield a, b, both >> s.bits, both & ((1 << s.bits) - 1)


def _features(batches, s: Settings, keep: np.ndarray | None):
    for batch in batches:
        for a, b, doc, slot in slot_sets(batch.column(1), s, keep):
            ends = np.searchsorted(doc, np.arange(b - a + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(slot, pa.int32()))],
                names=["toxic", "slots"])


def training_rows(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), text: str = "text",
                  id_col: str = "doc_id", label: str = "toxic") -> tuple[DataFrame, dict[int, int]]:
    """At most ``max_rows`` labelled texts of each class, ``(toxic, text)``, and
    how many labelled ids each class has in all."""
    one = (labels.select(F.col(id_col).alias("k"), F.col(label).cast("int").alias("toxic"))
           .where(F.col("k").isNotNull() & F.col("toxic").isin(0, 1))
           .groupBy("k").agg(F.max("toxic").alias("toxic")))
    # one row per labelled id that has a document, then a bounded choice by hash
    have = docs.select(F.col(id_col).alias("k")).where("k is not null").distinct()
    one = cut_lineage(one.join(have, "k", "left_semi"))
    size = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pick = None
    for c in (0, 1):
        part = one.where(F.col("toxic") == c).orderBy(F.xxhash64("k"), "k").limit(s.max_rows)
        pick = part if pick is None else pick.unionByName(part)
    # bounded by 2 * max_rows rows of two small columns; one text for each id
    return (docs.select(F.col(id_col).alias("k"), F.col(text).alias("text"))
            .join(F.broadcast(pick), "k").groupBy("k", "toxic").agg(F.max("text").alias("text")).select("toxic", "text")), size


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), text: str = "text",
        id_col: str = "doc_id", label: str = "toxic") -> Model:
    none = np.zeros(0, np.int64)
    texts, labelled = training_rows(docs, labels, s, text, id_col, label)
    sets = cut_lineage(texts.mapInArrow(lambda it: _features(it, s, None), "toxic int, slots array<int>"))
    size = {r["toxic"]: r["n"] for r in sets.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_tox, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_tox or not n_clean:
        share = n_tox / (n_tox + n_clean) if n_tox + n_clean else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(s, none, np.zeros(0), float(np.log(share / (1 - share))))
    counts = (sets.select("toxic", F.explode("slots").alias("slot")).groupBy("slot")
              .agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("q")))
    p, q = F.col("p") + 1.0, F.col("q") + 1.0
    ratio = F.log(p / (n_tox + 2.0)) - F.log(q / (n_clean + 2.0))
    both = (p + q) / (n_tox + n_clean + 4.0)

    def cell(seen, n):  # what the n texts of a class add to the likelihood ratio
        return seen * F.log(seen / (n * both)) + (n - seen) * F.log((n - seen) / (n * (1 - both)))

    g = 2 * (cell(p, n_tox + 2.0) + cell(q, n_clean + 2.0))
    chosen = (counts.select("slot", ratio.alias("r"), g.alias("g")).where(F.col("g") >= s.min_g)
              .drop("g").toArrow().sort_by("slot"))  # bounded by the slots of 2 * max_rows texts and by 2**bits
    slots, r = chosen.column("slot").to_numpy().astype(np.int64), chosen.column("r").to_numpy().astype(float)
    design = sets.mapInArrow(lambda it: _selected(it, slots), "toxic int, places array<int>")
    got = design.toArrow()  # at most 2 * max_rows rows
    y = got.column("toxic").to_numpy().astype(float)
    lists = got.column("places").combine_chunks()
    del got
    offs = np.append(0, np.cumsum(lists.value_lengths().to_numpy().astype(np.int64)))
    cols = lists.flatten().to_numpy()
    # a chosen text stands for all of its class: the classes weigh as among the labels
    weight = np.where(y == 1, labelled[1] / n_tox, labelled[0] / n_clean)
    w, bias = _logistic(offs, cols, r, y, weight, s.l2)
    return Model(s, slots, w * r, bias)


def _selected(batches, slots: np.ndarray):
    """Places in ``slots`` of those that each text has."""
    for batch in batches:
        lists = batch.column(1)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        at = np.searchsorted(slots, flat)
        ok = np.append(slots, -1)[at] == flat
        ends = np.searchsorted(doc[ok], np.arange(len(lists) + 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at[ok], pa.int32()))],
            names=["toxic", "places"])


def _logistic(offs, cols, r, y, weight, l2, steps: int = 500):
    """L2 logistic regression on the scaled features, with a weight a row:
    L-BFGS until the loss falls by less than 1e-7 of itself. ``cols`` of a row:
    ``cols[offs[i]:offs[i + 1]]``, taken in blocks of whole rows."""
    n, k = len(y), len(r)
    toxic = float(weight @ y)
    bias = float(np.log((toxic + 1) / (weight.sum() - toxic + 1)))
    if not k:
        return np.zeros(k), bias
    cuts = np.unique(np.append(np.searchsorted(offs, np.arange(0, offs[-1] + 1, 1 << 19)).clip(max=n), [0, n]))
    blocks = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))

    def forward(u):
        z, ru = np.empty(n), r * u[:k]
        for a, b in blocks:
            upto = np.append(0.0, np.cumsum(ru[cols[offs[a]:offs[b]]]))[offs[a:b + 1] - offs[a]]
            z[a:b] = np.diff(upto)
        return z + u[k]

    def gradient(z, u):
        err = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.zeros(k + 1)
        for a, b in blocks:
            g[:k] += np.bincount(cols[offs[a]:offs[b]], np.repeat(err[a:b], np.diff(offs[a:b + 1])), k)
        g[:k] = g[:k] * r + l2 * u[:k]
        g[k] = err.sum()
        return g

    def loss(z, u):
        return float(weight @ (np.logaddexp(0, z) - y * z)) + l2 / 2 * float(u[:k] @ u[:k])

    u = np.append(np.zeros(k), bias)
    z = forward(u)
    g, now, past = gradient(z, u), loss(z, u), []
    for _ in range(steps):
        d, used = -g, []
        for s, c in reversed(past):
            used.append(float(s @ d) / float(s @ c))
            d = d - used[-1] * c
        d = d * (float(past[-1][0] @ past[-1][1]) / float(past[-1][1] @ past[-1][1]) if past else 1 / max(float(np.linalg.norm(g)), 1.0))
        for (s, c), x in zip(past, reversed(used), strict=True):
            d = d + (x - float(c @ d) / float(s @ c)) * s
        zd, slope, t = forward(d), float(g @ d), 1.0
        while (then := loss(z + t * zd, u + t * d)) > now + 1e-4 * t * slope and t > 1e-12:
            t /= 2
        if not now - then > 1e-7 * now:
            break
        u, z, now = u + t * d, z + t * zd, then
        new = gradient(z, u)
        if float(d @ (new - g)) > 0:
            past = [*past[-7:], (t * d, new - g)]
        g = new
    return u[:k], float(u[k])


def score_column(col: pa.Array, m: Model, table: np.ndarray, keep: np.ndarray) -> np.ndarray:
    out = np.empty(len(col))
    for a, b, doc, slot in slot_sets(col, m.settings, keep):
        out[a:b] = np.bincount(doc, table[slot], b - a) + m.bias
    return 1 / (1 + np.exp(-np.clip(out, -700, 700)))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out`` (an existing one of that name is replaced)."""
    carry = [c for c in docs.columns if c != out]
    kinds = dict(docs.drop(out).dtypes) if out in docs.columns else dict(docs.dtypes)
    at = carry.index(text)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carry) + f", `{out}` double"

    def run(batches):
        table = np.zeros(1 << model.settings.bits)
        table[model.slots] = model.weights
        keep = np.zeros(1 << model.settings.bits, bool)
        keep[model.slots] = True
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score_column(b.column(at), model, table, keep))], names=[*carry, out])

    return docs.select(*[F.col(f"`{c}`") for c in carry]).mapInArrow(run, schema)
