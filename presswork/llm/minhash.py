"""MinHash near-duplicates with tensored banding and exact verification.

A document is the set of its distinct word shingles. Two small collections of
bands (``bands`` bands of ``rows`` minhashes each) give a document
``bands * bands`` table keys, one for each pair of a band of the first and a
band of the second collection; so ``2 * bands * rows`` minhashes do what
``2 * bands * bands * rows`` would do singly. Two documents of similarity s
share a key with probability ``(1 - (1 - s**rows)**bands)**2``: 0.9997 at 0.85
with the default 10 bands of 3 rows, and 0.99999 at 0.9.

Documents with equal sets are one class, so copies never meet in pairs.
Within a bucket each class is first verified against the bucket's smallest
one; components of these links leave few classes of a bucket apart, and only
pairs of a bucket that are still in different components and that none of
three exact bounds excludes are verified in a second round: the sizes, the
distances to the common leader (the Jaccard distance is a metric), and the
parity maps of the sets, whose differing bits bound the symmetric difference
from below. The bounds stand in the join itself, so a large group of copies
that are not quite near enough does not meet in pairs. Every candidate
pair is thus either linked through others already or compared on full sets.
Where rows of one id differ in text, the greatest text stands for the id in
comparisons.

Defined results: null or wordless texts have an empty set and link with
nothing; a text with fewer words than a shingle is one shingle of them all;
rows with null ids are left out of the links and are their own (null)
component; repeated rows of one id are one document each with equal results;
empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.llm import bytesops as B
from presswork.llm.common import cut_lineage
from presswork.llm.components import connected


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80     # linked from 100 * intersection >= percent * union
    bands: int = 10
    rows: int = 3
    seed: int = 71


def shingle_sets(col: pa.Array, k: int):
    """Per chunk: first and end text, distinct shingle hashes ordered by text
    and hash, and their offsets."""
    data, offs = B.text_buffers(col)
    for a, b, part, o in B.chunks(data, offs):
        w = B.words(part, o, lower=True)
        at, _ = B.window_starts(w.first, k)
        size = np.maximum(w.counts - k + 1, np.minimum(w.counts, 1))
        first = np.concatenate([[0], np.cumsum(size)])
        h = np.empty(first[-1], B.U64)
        long = w.counts >= k
        h[B.ranges(first[:-1][long], size[long])] = B.window_hashes(w.hash, k)[at]
        for n in range(1, k):  # shorter texts: all their words
            short = np.flatnonzero(w.counts == n)
            if len(short):
                h[first[:-1][short]] = B.window_hashes(w.hash, n)[w.first[:-1][short]]
        at = B.run_starts(B.sort_within(h, first), first)
        yield a, b, h[at], np.searchsorted(at, first)


def _signatures(h: np.ndarray, offs: np.ndarray, s: Settings) -> np.ndarray:
    """Hashes of the bands of each non-empty set: texts x (2 * bands)."""
    rng = np.random.default_rng(s.seed)
    mul = rng.integers(1, 1 << 63, 2 * s.bands * s.rows, dtype=np.uint64) | B.U64(1)
    add = rng.integers(0, 1 << 63, 2 * s.bands * s.rows, dtype=np.uint64)
    some = np.flatnonzero(np.diff(offs) > 0)
    out = np.zeros((len(offs) - 1, 2 * s.bands), B.U64)
    if len(some):
        for j in range(2 * s.bands * s.rows):
            x = h * mul[j] + add[j]
            x ^= x >> B.U64(32)
            x *= B.U64(0x9E3779B97F4A7C15)
            band = out[some, j // s.rows] * B.U64(0xD6E8FEB86659FD93) + np.minimum.reduceat(x, offs[:-1][some])
            out[some, j // s.rows] = B.mix64(band)
    return out


def signatures(docs: DataFrame, s: Settings, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n, f1, f2, bands array<long>)``: set size, 128-bit fingerprint
    of the set, band hashes."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        for batch in batches:
            for a, b, h, offs in shingle_sets(batch.column(1), s.shingle):
                total = [np.concatenate([np.zeros(1, B.U64), np.cumsum(x, dtype=B.U64)]) for x in (h, B.mix64(h ^ B.U64(0xA5A5A5A5A5A5A5A5)))]
                f1, f2 = (pa.array((t[offs[1:]] - t[offs[:-1]]).view(np.int64)) for t in total)
                sig = _signatures(h, offs, s)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * sig.shape[1], pa.int32()), pa.array(sig.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(offs), pa.int64()), f1, f2, lists],
                                                 names=["doc_id", "n", "f1", "f2", "bands"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n long, f1 long, f2 long, bands array<long>")


#: Bits of the parity map of a set.
_MARKS = 1024


def _sets(docs: DataFrame, s: Settings) -> DataFrame:
    """``(rep, shingles binary, marks array<long>)``: sorted 64-bit hashes and,
    for each of ``_MARKS`` bits, the parity of how many shingles fall on it. A
    bit that differs between two sets stands for a shingle that only one has,
    so the differing bits never exceed the symmetric difference."""
    kind = dict(docs.dtypes)["rep"]

    def run(batches):
        for batch in batches:
            for a, b, h, offs in shingle_sets(batch.column(1), s.shingle):
                raw = h.tobytes()
                sets = [raw[8 * x:8 * y] for x, y in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
                n = b - a
                on = np.bincount(np.repeat(np.arange(n), np.diff(offs)) * _MARKS + (h % B.U64(_MARKS)).astype(np.int64), minlength=n * _MARKS) & 1
                marks = np.packbits(on.astype(np.uint8)).view(np.int64)
                marks = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * (_MARKS // 64), pa.int32()), pa.array(marks))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, n), pa.array(sets, pa.binary()), marks], names=["rep", "shingles", "marks"])

    return docs.select("rep", "text").mapInArrow(run, f"rep {kind}, shingles binary, marks array<long>")


def _shared(batches):
    """Sizes of the intersections of the sorted sets ``x`` and ``y``."""
    for batch in batches:
        n = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(z.as_buffer(), B.U64) for z in (x, y))
            at = np.searchsorted(x, y)
            n.append(int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) and len(y) else 0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                                          *(pa.array([len(z.as_buffer()) // 8 for z in batch.column(c)], pa.int64()) for c in (2, 3))],
                                         names=["a", "b", "shared", "na", "nb"])


def compared(pairs: DataFrame, sets: DataFrame, kind: str) -> DataFrame:
    """``(a, b, shared, na, nb)`` of the pairs: a join of each side with its set."""
    got = (pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b")
           .join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a").select("a", "b", "x", "y"))
    return got.mapInArrow(_shared, f"a {kind}, b {kind}, shared long, na long, nb long")


def near_duplicates(docs: DataFrame, s: Settings = Settings(), text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n_shingles, class_id, component_id)`` of every row: class_id is
    the smallest id with the same set, component_id the smallest id reachable
    by links."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    sig = cut_lineage(signatures(docs, s))
    # classes of equal sets; partial aggregation leaves a row a class and task
    classes = (sig.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2")
               .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))
    keys = F.flatten(F.transform(F.slice("bands", 1, s.bands), lambda x, i: F.transform(
        F.slice("bands", s.bands + 1, s.bands), lambda y, j: F.xxhash64(x, y, i, j))))
    table = classes.select("rep", "n", F.explode(keys).alias("key"))
    # the set of a bucket's classes, as a 128-bit hash: buckets with equal sets
    # are one, and most of the tables of a pair of copies are equal
    own = Window.partitionBy("key")
    wide = (table.withColumn("size", F.count(F.lit(1)).over(own))
            .withColumn("s1", F.bit_xor(F.xxhash64(F.col("rep"), F.lit(1))).over(own))
            .withColumn("s2", F.bit_xor(F.xxhash64(F.col("rep"), F.lit(2))).over(own))
            .withColumn("leader", F.min(F.struct("rep", "n")).over(own)).where("size > 1"))
    buckets = cut_lineage(wide.select("s1", "s2", "rep", "n", F.col("leader.rep").alias("a"), F.col("leader.n").alias("na")).distinct())

    def sizes_fit(x, y):
        return 100 * F.least(x, y) >= s.percent * F.greatest(x, y)

    linked = 100 * F.col("shared") >= s.percent * (F.col("na") + F.col("nb") - F.col("shared"))
    involved = buckets.select("rep").distinct()
    # one text for each id; the join's order by id serves the aggregation too
    texts = docs.join(involved, docs["doc_id"] == involved["rep"], "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))
    sets = cut_lineage(_sets(texts.withColumnRenamed("doc_id", "rep"), s))
    first = (buckets.where((F.col("rep") != F.col("a")) & sizes_fit(F.col("n"), F.col("na")))
             .select("a", F.col("rep").alias("b")).distinct())
    done = cut_lineage(compared(first, sets, kind))
    links = done.where(linked).select("a", "b")
    comp = connected(links)
    # second round: pairs of a bucket that are still apart
    label = comp.select(F.col("node").alias("rep"), F.col("component"))
    far = 1 - F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))
    to_leader = done.select("a", F.col("b").alias("rep"), far.alias("far"))
    bucket = Window.partitionBy("s1", "s2")
    open_ = (buckets.join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
             .join(to_leader, ["a", "rep"], "left").where("rep <> a")
             .withColumn("apart", F.min("component").over(bucket) != F.max("component").over(bucket)).where("apart")
             .withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("s1", "s2", "component")))
             .withColumn("main", F.max(F.struct("same", "component")).over(bucket)["component"] == F.col("component"))
             .join(sets.select("rep", "marks"), "rep"))
    # used twice below: written once, so that the plan of the pairs is small
    open_ = cut_lineage(open_.select("s1", "s2", "rep", "n", "component", "far", "main", "marks"))
    x, y = (open_.select("s1", "s2", *(F.col(c).alias(f"{c}{k}") for c in ("rep", "n", "component", "far", "main", "marks"))) for k in "xy")
    # one side of a pair is outside the bucket's largest component
    y = y.where("not mainy")
    bound = 1 - s.percent / 100 + 1e-9
    differ = F.aggregate(F.zip_with("marksx", "marksy", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, d: n + d)
    second = (x.join(y, ["s1", "s2"]).where((F.col("componentx") != F.col("componenty")) & (F.col("mainx") | (F.col("repx") < F.col("repy")))
                                            & sizes_fit(F.col("nx"), F.col("ny"))
                                            & (differ * (100 + s.percent) <= (F.col("nx") + F.col("ny")) * (100 - s.percent))
                                            & (F.col("farx").isNull() | F.col("fary").isNull() | (F.abs(F.col("farx") - F.col("fary")) <= bound)))
              .select(F.least("repx", "repy").alias("a"), F.greatest("repx", "repy").alias("b")).distinct())
    more = cut_lineage(compared(cut_lineage(second), sets, kind).where(linked).select("a", "b"))
    if not more.isEmpty():
        comp = connected(links.unionByName(more))
    label = comp.select(F.col("node").alias("class_id"), F.col("component"))
    # class of each row by its fingerprint; hot classes are split by the join
    out = (sig.select("doc_id", "n", "f1", "f2").join(classes.select("n", "f1", "f2", F.col("rep").alias("class_id")), ["n", "f1", "f2"], "left")
           .join(label, "class_id", "left"))
    none = F.col("doc_id").isNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(none, None).otherwise(F.coalesce("class_id", "doc_id")).alias("class_id"),
                      F.when(none, None).otherwise(F.coalesce("component", "class_id", "doc_id")).alias("component_id"))
