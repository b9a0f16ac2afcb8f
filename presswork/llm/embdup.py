"""Embedding near-dedup with randomised-rotation binary codes.

A unit vector o of d components is rotated into ``D >= d`` dimensions by a
random matrix with orthonormal columns and coded by the signs of the result.
With ``f = <code, o>`` stored beside the code, ``<code, q> / f`` estimates
``<o, q>`` without bias, and its error is below ``eps * sqrt(1 - f^2) / (f *
sqrt(D - 1))`` except with a probability that falls as ``exp(-eps^2 / 2)``.
Pairs whose estimate plus this bound stays below the threshold are discarded;
all others are recomputed in double precision, and only these decide.

Pairs to estimate come from ``tables`` of ``bits`` code bits each: vectors of
a label that agree in all bits of a table meet there, and a pair is handled in
the first table that it shares. ``bits`` follows the number of vectors so that
buckets stay small, and ``tables`` follows ``bits`` so that a pair at the
threshold is missed with a probability of ``miss`` at any size.

Equal vectors of a label are one class with a weight, so copies do not meet in
pairs. Buckets over ``block`` rows are split into blocks by a hash, and pairs
of blocks are separate groups, so no task takes a whole hot bucket. A group
returns link counts and a spanning forest, never its pairs.

Defined results: a vector that is null, empty, zero, or holds null or
non-finite components, and a vector without label or id, links with nothing;
vectors of different length never link; repeated rows of one id and vector
are one vector; empty tables give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import cut_lineage, spread
from presswork.llm.components import connected


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.98
    miss: float = 2e-4     # chance that a pair at the threshold meets in no table
    per_bucket: int = 50   # vectors in a bucket, if all labels were one
    least_dim: int = 256   # dimensions of the rotated space, at least
    eps: float = 4.0       # width of the confidence bound
    block: int = 1024
    seed: int = 7

    def layout(self, n: int) -> tuple[int, int, int]:
        """Bits, tables and code dimensions for n vectors."""
        bits = max(4, math.ceil(math.log2(max(n, 1) / self.per_bucket + 1)))
        agree = (1 - math.acos(self.threshold) / math.pi) ** bits
        tables = math.ceil(math.log(self.miss) / math.log(1 - agree))
        return bits, tables, -(-max(self.least_dim, bits * tables) // 64) * 64


_rotations: dict[tuple[int, int, int], np.ndarray] = {}


def rotation(seed: int, dim: int, d: int) -> np.ndarray:
    """dim x d, orthonormal columns."""
    if (seed, dim, d) not in _rotations:
        _rotations[seed, dim, d] = np.linalg.qr(np.random.default_rng((seed, dim, d)).standard_normal((dim, d)))[0]
    return _rotations[seed, dim, d]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(x: np.ndarray, seed: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign codes and the stored factors of unit vectors."""
    y = x @ rotation(seed, max(dim, x.shape[1]), x.shape[1]).T
    return np.packbits(y > 0, axis=1), np.abs(y).sum(axis=1) / math.sqrt(y.shape[1])


_ROWS = "label_key long, rep long, weight long, t int, bucket long, vec binary, code binary, factor double"


def _coded(batches, s: Settings, bits: int, tables: int, dim: int):
    """A row for each vector and table."""
    place = np.arange(tables * bits).reshape(tables, bits)
    power = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        lists = batch.column(3)
        size = lists.value_lengths().to_numpy()
        flat = lists.flatten().to_numpy()
        first = np.concatenate([[0], np.cumsum(size)])
        for d in np.unique(size).tolist():
            mine = np.flatnonzero(size == d)
            x = _unit(flat[first[mine][:, None] + np.arange(d)])
            code, factor = encode(x, s.seed, dim)
            sign = np.unpackbits(code, axis=1)[:, :tables * bits]
            vecs = [v.tobytes() for v in flat[first[mine][:, None] + np.arange(d)].astype(np.float64)]
            codes = [c.tobytes() for c in code]
            base = [batch.column(c).take(pa.array(mine)) for c in (0, 1, 2)]
            for t in range(tables):
                key = (sign[:, place[t]].astype(np.int64) * power).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*base, pa.array(np.full(len(mine), t), pa.int32()), pa.array(key), pa.array(vecs, pa.binary()), pa.array(codes, pa.binary()), pa.array(factor)],
                    names=[c.split(" ")[0] for c in _ROWS.split(", ")])


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each index's component over the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


class _Group:
    """The rows of one group, in the two sides of a pair of blocks."""

    def __init__(self, table: pa.RecordBatch):
        col = {n: table.column(n) for n in table.schema.names}
        self.rep, self.weight, self.t = (col[c].to_numpy() for c in ("rep", "weight", "t"))
        self.label, self.bucket = col["label_key"].to_numpy(), col["bucket"].to_numpy()
        self.block, self.left, self.right = (col[c].to_numpy() for c in ("own", "left", "right"))
        self.factor = col["factor"].to_numpy()
        self.vec = [np.frombuffer(x.as_buffer()) for x in col["vec"]]
        self.code = np.stack([np.frombuffer(x.as_buffer(), np.uint8) for x in col["code"]])


def _linked(g: _Group, at: np.ndarray, s: Settings, bits: int, tables: int):
    """Links among the rows ``at`` of one group."""
    n = len(at)
    sign = np.unpackbits(g.code[at], axis=1)
    keys = (sign[:, :tables * bits].reshape(n, tables, bits) * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)
    x = _unit(np.stack([g.vec[i] for i in at]))
    dim = sign.shape[1]
    turned = x @ rotation(s.seed, dim, x.shape[1]).T
    code = (sign.astype(np.float32) * 2 - 1) / np.float32(math.sqrt(dim))
    f = g.factor[at]
    bound = s.eps * np.sqrt(np.maximum(1 - f * f, 0)) / (f * math.sqrt(max(dim - 1, 1)))
    t = g.t[at]
    for k in range(0, n, 256):  # rows against all later rows
        rows = np.arange(k, min(k + 256, n))
        cols = np.arange(k, n)
        ok = (cols[None, :] > rows[:, None]) & (g.block[at[rows]][:, None] != g.block[at[cols]][None, :]) if g.left[at[0]] != g.right[at[0]] \
            else cols[None, :] > rows[:, None]
        ok &= (t[rows][:, None] == t[cols]) & (g.label[at[rows]][:, None] == g.label[at[cols]]) & (g.bucket[at[rows]][:, None] == g.bucket[at[cols]])
        for e in range(int(t.max())):  # handled in an earlier table
            ok &= (keys[rows, e][:, None] != keys[cols, e]) | (e >= t[rows][:, None])
        estimate = (code[rows].astype(np.float64) @ turned[cols].T) / f[rows][:, None]
        a, b = np.nonzero(ok & (estimate + bound[rows][:, None] >= s.threshold))
        a, b = rows[a], cols[b]
        exact = np.einsum("ij,ij->i", x[a], x[b])
        keep = exact >= s.threshold
        yield a[keep], b[keep]


def _links(batches, s: Settings, bits: int, tables: int):
    """Of each group (rows in order of ``grp``): (node, root, n) rows."""
    held: list[pa.RecordBatch] = []

    def done(table: pa.RecordBatch, grp: np.ndarray):
        g = _Group(table)
        node, root, count = [], [], []
        cut = np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1], [True]]))
        for p, q in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            dims = np.array([len(g.vec[i]) for i in range(p, q)])
            for d in np.unique(dims).tolist():
                at = np.arange(p, q)[dims == d]
                if len(at) < 2:
                    continue
                pairs = list(_linked(g, at, s, bits, tables))
                a, b = (np.concatenate([x[i] for x in pairs]) for i in (0, 1))
                if not len(a):
                    continue
                n = np.bincount(a, g.weight[at[b]], len(at)) + np.bincount(b, g.weight[at[a]], len(at))
                least = _forest(len(at), a, b)
                used = np.flatnonzero(n)
                node.append(g.rep[at[used]])
                root.append(g.rep[at[least[used]]])
                count.append(n[used].astype(np.int64))
        if node:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (node, root, count)], names=["node", "root", "n"])

    def joined():
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        grp = batch.column(0).to_numpy()
        if held and grp[0] != last:
            table = joined()
            yield from done(table, table.column(0).to_numpy())
            held = []
        # the batch's last group may go on in the next batch
        tail = int(np.searchsorted(grp, grp[-1]))
        last = int(grp[-1])
        if tail:
            held.append(batch.slice(0, tail))
            table = joined()
            yield from done(table, table.column(0).to_numpy())
            held = []
        held.append(batch.slice(tail))
    if held:
        table = joined()
        yield from done(table, table.column(0).to_numpy())


def near_duplicates(vectors: DataFrame, s: Settings = Settings(), id_col: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id)`` of every row of ``vectors``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec"), F.col(label).alias("label"))
    sound = (F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("vec") > 0)
             & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vec", lambda x: x != 0))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    key = [F.xxhash64("label").alias("label_key"), F.xxhash64("vec", "label").alias("h1"), F.xxhash64(F.lit(1), "vec", F.size("vec")).alias("h2")]
    good = rows.where("sound").select("vec_id", "vec", "label", *key)
    # classes of equal vectors; rows of a hot class are counted before they meet
    classes = (good.groupBy("label_key", "h1", "h2", "vec_id").agg(F.first("vec").alias("vec"))
               .groupBy("label_key", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("vec").alias("vec")))
    classes = cut_lineage(classes)
    bits, tables, dim = s.layout(classes.count())
    coded = classes.select("label_key", "rep", "weight", "vec").mapInArrow(lambda it: _coded(it, s, bits, tables, dim), _ROWS)
    cell = ["label_key", "t", "bucket"]
    large = (classes.select("label_key", "rep", "weight", "vec").mapInArrow(lambda it: _coded(it, s, bits, tables, dim), _ROWS)
             .groupBy(*cell).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > s.block)
             .select(*cell, F.ceil(F.col("size") / s.block).cast("int").alias("blocks")))
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = (coded.join(large, cell, "left").withColumn("blocks", blocks)
             .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")))
    dealt = dealt.withColumn("grp", F.xxhash64(*cell, "left", "right"))
    names = ["grp", "label_key", "rep", "weight", "t", "bucket", "vec", "code", "factor", "own", "left", "right"]
    dealt = dealt.select(*names).repartition(spread(spark), "grp").sortWithinPartitions("grp")
    found = cut_lineage(dealt.mapInArrow(lambda it: _links(it, s, bits, tables), "node long, root long, n long"))
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    comp = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_class = (classes.select("label_key", "h1", "h2", "rep", "weight")
                 .join(links.withColumnRenamed("node", "rep"), "rep", "left")
                 .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                 .select("label_key", "h1", "h2", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "rep").alias("component_id")))
    out = good.select("vec_id", "label_key", "h1", "h2").join(per_class, ["label_key", "h1", "h2"]).select("vec_id", "n_links", "component_id")
    rest = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest)
