"""Language-model scoring with a probabilistic suffix tree over words.

Training counts every word and every run of up to ``depth + 1`` tokens. A
context of up to ``depth`` words can be a state when it is seen ``least_count``
times; its next symbols that are seen ``least_next`` times are stored. It is
kept when these diverge from what its parent (the context without its first
word) predicts: the log-likelihood ratio of the stored symbols and one cell for
all others must exceed ``log(count)`` a stored symbol, plus ``strength``. A
stored symbol's probability is its count less ``discount``; what is left of a
state's probability goes to all other symbols in proportion to the parent's
distribution (the next shorter suffix, kept or not: one that is not kept is its
own parent's distribution). The root is the add-one distribution over the V
training words and one unknown word, so every state's distribution sums to one.
These counts are fixed, so states grow with the corpus.

A text is scored token by token, each in the state of the longest kept suffix
of the words before it; the end of the text is a token too. The log
probability of a token is that of the root, plus for each suffix of its context
the state's log factor for what is not stored, plus, where the symbol is stored,
the difference that storing makes. So every word, pair and triple of words has
one number, and the score of a text is the sum over its own.

States, symbols and counts stay in tables partitioned by hash. Texts send their
words, pairs and triples, packed by destination, to where the numbers are, and
get back partial sums. Those that make up ``cache`` of all tokens (at most
``1 / cache`` of each length) are broadcast and need not be sent. Neither need
what a sieve shows to be no context, symbol or entry: a bit for each remainder
of a hash, 32 bits an entry up to ``2 ** sieve`` bits, so that tables beyond
fill it and it keeps less away. Both spare traffic only and change no result.

What is shuffled at once is bounded by passes: of contexts with their next
symbols a ``share`` of the pairs (by hash) is counted at a time, and the texts
are scored a ``slice`` at a time. Each pass is written, then its shuffle files
go, as do tables of the learning that nothing reads any more.

Defined results: a null or empty text is its end alone; repeated rows are
scored (and taught) each for itself; rows with a null id are scored but never
taught; without training tokens every token is unknown (N = V = 0). An empty
table gives no rows.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm import bytesops as B
from presswork.llm.common import cut_lineage, spread, text_bytes
from presswork.session import checkpoint_dir, small_batches

#: The end of a text, as a word hash.
END = B.U64(0x7E57E4D0E4D7E57E)
_GOLD = B.U64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    depth: int = 2
    least_count: int = 16     # of a context
    least_next: int = 4       # of a next symbol that is stored
    discount: float = 0.5
    strength: float = 4.0     # nats
    cache: float = 1e-6       # share of the tokens; says only what is broadcast
    sieve: int = 25           # log2 of its most bits; spares traffic only
    shares: int = 2           # passes that count a length of contexts
    slices: int = 3           # passes that score the texts


@dataclass
class Model:
    settings: Settings
    tokens: int               # N
    words: int                # V
    table: DataFrame          # a packed row per destination: all words' counts, and the runs whose extra is not 0
    sieve: np.ndarray         # of these runs
    states: list[DataFrame]   # per length (context, c, rest): kept contexts
    hash: np.ndarray          # those that are broadcast, sorted
    count: np.ndarray
    extra: np.ndarray

    @property
    def log_total(self) -> float:
        return math.log10(self.tokens + self.words + 1)


def _find(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each x in the sorted table, or -1."""
    if not len(table):
        return np.full(len(x), -1)
    at = np.searchsorted(table, x).clip(max=len(table) - 1)
    return np.where(table[at] == x, at, -1)


def _sieve(table: DataFrame, most: int) -> np.ndarray:
    """The bits that the column ``hash`` sets; its high bits say which. There are
    32 bits a row, ``2 ** most`` at most. At most a row of 64 bits each comes to
    the driver, as Arrow columns."""
    bits = min(max((32 * table.count()).bit_length(), 12), most)
    slot = F.shiftrightunsigned("hash", 64 - bits)
    got = (table.select(F.shiftright(slot, 6).alias("at"), F.expr(f"1L << cast(shiftrightunsigned(hash, {64 - bits}) & 63 as int)").alias("bit"))
           .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return out.view(B.U64)


def _may_be(sieve: np.ndarray, x: np.ndarray) -> np.ndarray:
    """False where x is surely not in the table of the sieve."""
    slot = x >> B.U64(64 - 6 - (len(sieve).bit_length() - 1))
    return (sieve[slot >> B.U64(6)] >> (slot & B.U64(63))) & B.U64(1) != 0


def _follow(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return B.mix64(context * _GOLD + symbol)


class Tokens:
    """Words and ends of a chunk: hash, text, and how many tokens of the text precede."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        w = B.words(data, offs, lower=True)
        n = len(offs) - 1
        self.first = w.first + np.arange(n + 1)
        self.hash = np.empty(len(w.hash) + n, B.U64)
        ends = np.zeros(len(self.hash), bool)
        ends[self.first[1:] - 1] = True
        self.hash[ends], self.hash[~ends] = END, w.hash
        self.doc = np.repeat(np.arange(n), np.diff(self.first))
        self.place = np.arange(len(self.hash)) - self.first[self.doc]

    def grams(self, most: int) -> list[np.ndarray]:
        """For k = 1 .. most the hash of the k tokens that end at each token, 0
        where the text has fewer: the k - 1 tokens before it, followed by the
        k - 1 that end at it."""
        out = [self.hash]
        for k in range(2, most + 1):
            g = np.zeros(len(self.hash), B.U64)
            g[1:] = _follow(out[-1][:-1], out[-1][1:])
            g[self.place < k - 1] = 0
            out.append(g)
        return out


def _taught(batches):
    """Tokens of chunks of the texts that may teach."""
    for batch in batches:
        batch = batch.filter(batch.column(1))
        data, offs = B.text_buffers(batch.column(2))
        for _, _, part, o in B.chunks(data, offs, B.SMALL_CHUNK_BYTES):
            yield Tokens(part, o)


# --- counts, packed by destination ---------------------------------------

_COUNTS = "part int, hashes binary, counts binary"


def _place(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h & B.U64(0x7FFFFFFF)) % B.U64(parts)).astype(np.int64)


def _merge(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h, n = h[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[at], np.add.reduceat(n, at) if len(at) else n


def _packed(h: np.ndarray, n: np.ndarray, parts: int, names: tuple[str, str] = ("hashes", "counts")) -> pa.RecordBatch:
    part = _place(h, parts)
    order = np.argsort(part, kind="stable")
    part, h, n = part[order], h[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    ends = np.append(first, len(part))

    def binary(x):
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((ends * x.dtype.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])

    return pa.RecordBatch.from_arrays([pa.array(part[first], pa.int32()), binary(h), binary(n)], names=["part", *names])


def _counted(items, parts: int, most: int = 3_000_000):
    """Counts of hashes, added up in the task before they are sent."""
    hashes, counts, size = [], [], 0
    for h in items:
        h, n = np.unique(h, return_counts=True)
        hashes.append(h)
        counts.append(n)
        size += len(h)
        if size > most:
            h, n = _merge(np.concatenate(hashes), np.concatenate(counts))
            hashes, counts, size = [h], [n], len(h)
            if size > most // 2:
                yield _packed(h, n, parts)
                hashes, counts, size = [], [], 0
    if size:
        yield _packed(*_merge(np.concatenate(hashes), np.concatenate(counts)), parts)


def _whole(group: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in group.column(name))])


def _summed(group: pa.Table) -> pa.Table:
    """One row per destination: its hashes and their counts."""
    h, n = _merge(_whole(group, "hashes", B.U64), _whole(group, "counts", np.int64))
    return pa.table([pa.array([group.column("part")[0].as_py()], pa.int32()), pa.array([h.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())],
                    names=["part", "hashes", "counts"])


def _totals(batches):
    for batch in batches:
        for x in batch.column(2):
            n = np.frombuffer(x.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int(n.sum())]), pa.array([len(n)])], names=["tokens", "words"])


def _large(batches, least: int):
    """Rows of the words seen at least ``least`` times."""
    for batch in batches:
        for a, b in zip(batch.column(1), batch.column(2), strict=True):
            h, n = np.frombuffer(a.as_buffer(), B.U64), np.frombuffer(b.as_buffer(), np.int64)
            keep = n >= least
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(n[keep])], names=["hash", "n"])


# --- runs of tokens: a context and its next symbol ------------------------

_CELLS = "part int, contexts binary, sizes binary, suffixes binary, counts binary"
_STORED = "context long, suffix long, key long, n long"


def _merge_cells(c: np.ndarray, s: np.ndarray, n: np.ndarray):
    """Equal (context, suffix) added up; in order of their hash."""
    key = _follow(c, s)
    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return c[order[at]], s[order[at]], np.add.reduceat(n[order], at) if len(at) else n, key[at]


def _packed_cells(c: np.ndarray, s: np.ndarray, n: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row per destination; each context is written once in it. A context is
    dealt over 16 destinations, as one word may come before a third of all."""
    part = _place(B.mix64(c + (s & B.U64(15)) * _GOLD), parts)
    order = np.argsort((part.astype(B.U64) << B.U64(40)) | (B.mix64(c) >> B.U64(24)))  # equal contexts of a destination side by side
    part, c, s, n = part[order], c[order], s[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (part[1:] != part[:-1])]))
    sizes, head, of = np.diff(np.append(new, len(c))).astype(np.uint32), c[new], part[new]
    dest = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    ends = np.append(dest, len(of))
    cuts = np.append(new, len(c))[ends]

    def binary(x, cut):
        return pa.Array.from_buffers(pa.binary(), len(dest), [None, pa.py_buffer((cut * x.dtype.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])

    return pa.RecordBatch.from_arrays([pa.array(of[dest], pa.int32()), binary(head, ends), binary(sizes, ends), binary(s, cuts), binary(n.astype(np.uint32), cuts)],
                                      names=[x.split(" ")[0] for x in _CELLS.split(", ")])


def _cells(batches, k: int, parts: int, contexts: np.ndarray, suffixes: np.ndarray, share: int = 0, shares: int = 1, most: int = 500_000):
    """Contexts of k words with the suffix that their next symbol makes, added
    up in the task before they are sent; none that the sieves keep away, and
    only those of one share of all such pairs."""
    held, size = [], 0
    for t in _taught(batches):
        gram = t.grams(k)[-1]
        at = np.flatnonzero(t.place >= k)
        if shares > 1:
            at = at[((gram[at - 1] ^ gram[at]) >> B.U64(32)) % B.U64(shares) == share]
        at = at[_may_be(suffixes, gram[at])]
        at = at[_may_be(contexts, gram[at - 1])]
        held.append((gram[at - 1], gram[at], np.ones(len(at), np.int64)))
        size += len(at)
        if size > most:
            c, s, n, _ = _merge_cells(*map(np.concatenate, zip(*held, strict=True)))
            held, size = [(c, s, n)], len(c)
            if size > most // 2:
                yield _packed_cells(c, s, n, parts)
                held, size = [], 0
    if size:
        yield _packed_cells(*_merge_cells(*map(np.concatenate, zip(*held, strict=True)))[:3], parts)


def _stored(group: pa.Table, least: int) -> pa.Table:
    """The cells of a destination that are seen often enough."""
    c = np.repeat(_whole(group, "contexts", B.U64), _whole(group, "sizes", np.uint32))
    c, s, n, key = _merge_cells(c, _whole(group, "suffixes", B.U64), _whole(group, "counts", np.uint32).astype(np.int64))
    keep = n >= least
    return pa.table([pa.array(x[keep].view(np.int64)) for x in (c, s, key, n)], names=[x.split(" ")[0] for x in _STORED.split(", ")])


# --- learning -------------------------------------------------------------

def _written(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """A table in the checkpoint folder; its path is added to ``made``."""
    at = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    if made is not None:
        made.append(at)
    return df.sparkSession.read.parquet(at)


def _deleted(spark: SparkSession, made: list[str]) -> None:
    """Tables of ``_written`` that nothing reads any more."""
    for at in made:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    made.clear()


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for x in tables[1:]:
        out = out.unionByName(x)
    return out


def _level(cells: DataFrame, shorter: DataFrame, s: Settings, made: list[str]) -> tuple[DataFrame, DataFrame]:
    """One length of contexts. ``shorter``: (hash, n, logp) of the stored runs
    one token shorter. Returns (hash, n, logp, extra) of the stored cells, logp
    being that of the last token after the others, and the kept contexts with
    their count and log factor."""
    context = shorter.where(F.col("n") >= s.least_count).select(F.col("hash").alias("context"), F.col("n").alias("c"))
    parent = shorter.select(F.col("hash").alias("suffix"), F.col("logp").alias("up"))
    cells = cells.join(parent, "suffix")
    stats = (cells.join(context, "context")
             .groupBy("context", "c").agg(F.count("*").alias("cells"), F.sum("n").alias("seen"), F.sum(F.col("n") - s.discount).alias("own"),
                                          F.sum(F.pow(F.lit(10.0), "up")).alias("above"),
                                          F.sum(F.col("n") * (F.log(F.col("n") / F.col("c")) - F.col("up") * math.log(10))).alias("ratio")))
    left, above = F.col("c") - F.col("seen"), F.greatest(1 - F.col("above"), F.lit(1e-12))
    ratio = F.col("ratio") + F.when(left > 0, left * F.log(left / (F.col("c") * above))).otherwise(0.0)
    kept = (stats.where(ratio > F.col("cells") * F.log("c") + s.strength)
            .select("context", "c", F.log10(F.greatest(1 - F.col("own") / F.col("c"), F.lit(1e-12)) / above).alias("rest")))
    kept = _written(kept, "suffix-states")
    own = F.log10((F.col("n") - s.discount) / F.col("c"))
    got = cells.join(kept, "context", "left").select(
        F.col("key").alias("hash"), "n", F.coalesce(own, F.col("up")).alias("logp"), F.coalesce(own - F.col("rest") - F.col("up"), F.lit(0.0)).alias("extra"))
    return _written(got, "suffix-symbols", made), kept


_RUNS = "part int, runs binary, extras binary"
_TABLE = "of int, hashes binary, counts binary, runs binary, extras binary"


def _packed_runs(batches, parts: int):
    """Entries whose extra is not 0 by destination."""
    for batch in batches:
        if batch.num_rows:
            yield _packed(batch.column(0).to_numpy().view(B.U64), batch.column(1).to_numpy(), parts, ("runs", "extras"))


def _row(counts: pa.Table, runs: pa.Table) -> pa.Table:
    """What a destination looks up, in order of the hashes."""
    part = (counts if counts.num_rows else runs).column("part")[0].as_py()
    run, extra = _whole(runs, "runs", B.U64), _whole(runs, "extras", np.float64)
    order = np.argsort(run)
    binary = [_whole(counts, "hashes", B.U64), _whole(counts, "counts", np.int64), run[order], extra[order]]
    return pa.table([pa.array([part], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in binary)], names=[x.split(" ")[0] for x in _TABLE.split(", ")])


def learn(docs: DataFrame, s: Settings, parts: int) -> Model:
    """The model of the rows (doc_id, teach, text) that teach."""
    spark = docs.sparkSession
    counts = cut_lineage(docs.mapInArrow(lambda it: _counted((t.hash for t in _taught(it)), parts), _COUNTS).groupBy("part").applyInArrow(_summed, _COUNTS))
    size = counts.mapInArrow(_totals, "tokens long, words long").agg(F.sum("tokens"), F.sum("words")).first()
    total, distinct = int(size[0] or 0), int(size[1] or 0)
    words = counts.mapInArrow(lambda it: _large(it, s.least_next), "hash long, n long")
    level = words.withColumn("logp", F.log10((F.col("n") + 1) / F.lit(float(total + distinct + 1)))).withColumn("extra", F.lit(0.0))
    found, states, symbols = [level], [], []
    for k in range(1, s.depth + 1):
        contexts, suffixes = (_sieve(level.where(F.col("n") >= n), s.sieve) for n in (s.least_count, s.least_next))
        cells, made, sieves = [], [], spark.sparkContext.broadcast((contexts, suffixes))
        for share in range(s.shares):
            some = (docs.mapInArrow(lambda it, k=k, a=sieves, share=share: _cells(it, k, parts, *a.value, share, s.shares), _CELLS)
                    .groupBy("part").applyInArrow(lambda g: _stored(g, s.least_next), _STORED))
            cells.append(_written(some, "suffix-cells", made))
        sieves.destroy()
        level, kept = _level(_union(cells), level, s, symbols)
        _deleted(spark, made)
        found.append(level)
        states.append(kept)
    every = [x.select("hash", "n", "extra") for x in found] + [x.select(F.col("context").alias("hash"), F.lit(0).cast("long").alias("n"), F.col("rest").alias("extra")) for x in states]
    entries = _written(_union(every).groupBy("hash").agg(F.max("n").alias("n"), F.sum("extra").alias("extra")), "suffix-entries", symbols)
    # at most 1 / cache of each length
    near = entries.where(F.col("n") >= max(s.cache * total, s.least_next)).toArrow()
    h = near.column("hash").to_numpy().astype(np.int64).view(B.U64)
    order = np.argsort(h)
    runs = entries.where("extra <> 0")  # runs of tokens that change no score need no row
    sieve = _sieve(runs, s.sieve)
    packed = runs.select("hash", "extra").mapInArrow(lambda it: _packed_runs(it, parts), _RUNS)
    table = _written(counts.groupBy("part").cogroup(packed.groupBy("part")).applyInArrow(_row, _TABLE), "suffix-table")
    _deleted(spark, symbols)
    return Model(s, total, distinct, table, sieve, states, h[order], near.column("n").to_numpy().astype(np.int64)[order], near.column("extra").to_numpy().astype(np.float64)[order])


# --- scoring --------------------------------------------------------------

_STATIC = np.dtype([("row", np.int64), ("doc", np.int64), ("null", np.int64), ("tokens", np.int64), ("known", np.int64), ("base", np.float64), ("extra", np.float64)])
_SENT = "part int, ids binary, sizes binary, hashes binary, static binary"
#: Partial sums of a text: known tokens, the base score and what the score differs from it.
_SUM = np.dtype([("row", np.int64), ("known", np.int64), ("base", np.float64), ("extra", np.float64)])
_PARTIAL = "part int, sums binary, static binary"
_TOTAL = "doc_id long, n_tokens long, n_known long, base_score double, score double"


@dataclass
class _Near:
    """What is broadcast of a model."""

    depth: int
    log_total: float
    sieve: np.ndarray
    hash: np.ndarray
    count: np.ndarray
    extra: np.ndarray


def _scored(batches, m: _Near, parts: int):
    """Sums over the runs of tokens that are known here (a static row per
    text), and the other runs of each text by destination."""
    log_word = np.log10(m.count + 1.0)
    row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
    kinds = [c.split(" ")[0] for c in _SENT.split(", ")]
    for batch in batches:
        ids = batch.column(0)
        null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        data, offs = B.text_buffers(batch.column(2))
        for a, b, part, o in B.chunks(data, offs, B.SMALL_CHUNK_BYTES):
            t, n = Tokens(part, o), b - a
            rows = row + np.arange(n)
            row += n
            tokens = np.diff(t.first)
            static = np.zeros(n, _STATIC)
            static["row"], static["doc"], static["null"], static["tokens"] = rows, ids[a:b], null[a:b], tokens
            static["base"] = -tokens * m.log_total
            far, far_doc = [], []
            for k, gram in enumerate(t.grams(m.depth + 1)):
                on = np.flatnonzero(t.place >= k)
                gram, doc = gram[on], t.doc[on]
                at = _find(m.hash, gram)
                here = at >= 0
                if k == 0:
                    static["known"] = np.bincount(doc, here, n)
                    static["base"] += np.bincount(doc[here], log_word[at[here]], n)
                static["extra"] += np.bincount(doc[here], m.extra[at[here]], n)
                away = ~here if k == 0 else ~here & _may_be(m.sieve, gram)  # words have counts too
                far.append(gram[away])
                far_doc.append(doc[away])
            yield pa.RecordBatch.from_arrays([pa.array([int(rows[0]) // 7 % parts], pa.int32()), *[pa.array([b""], pa.binary())] * 3, pa.array([static.tobytes()], pa.binary())], names=kinds)
            h, doc = np.concatenate(far), np.concatenate(far_doc)
            if not len(h):
                continue
            place = _place(h, parts)
            order = np.argsort(place * n + doc)
            h, doc, place = h[order], doc[order], place[order]
            entry = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])]))
            sizes = np.diff(np.append(entry, len(h))).astype(np.uint32)
            dest = np.flatnonzero(np.concatenate([[True], place[entry][1:] != place[entry][:-1]]))
            ends = np.append(dest, len(entry))
            cuts = np.append(entry, len(h))[ends]

            def binary(x, cut):
                return pa.Array.from_buffers(pa.binary(), len(dest), [None, pa.py_buffer((cut * x.dtype.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])

            yield pa.RecordBatch.from_arrays([pa.array(place[entry][dest], pa.int32()), binary(rows[doc[entry]], ends), binary(sizes, ends), binary(h, cuts), pa.array([b""] * len(dest), pa.binary())], names=kinds)


def _looked_up(sent: pa.Table, table: pa.Table, parts: int) -> pa.Table:
    """Partial sums of a destination: runs of tokens meet their numbers. They go
    on packed by destination of their texts, so rows do not multiply."""
    word, n = _whole(table, "hashes", B.U64), _whole(table, "counts", np.int64)
    run, extra = _whole(table, "runs", B.U64), _whole(table, "extras", np.float64)
    h = _whole(sent, "hashes", B.U64)
    at = _find(word, h)
    c = np.where(at >= 0, n[at] if len(n) else 0, 0)
    at = _find(run, h)
    more = np.where(at >= 0, extra[at] if len(run) else 0.0, 0.0)
    rows, sizes = _whole(sent, "ids", np.int64), _whole(sent, "sizes", np.uint32).astype(np.int64)
    each = np.repeat(np.arange(len(rows)), sizes)
    sums = np.zeros(len(rows), _SUM)
    sums["row"], sums["known"] = rows, np.bincount(each, c > 0, len(rows))
    sums["base"] = np.bincount(each, np.log10(c + 1.0), len(rows))
    sums["extra"] = np.bincount(each, more, len(rows))
    sums = sums[(sums["known"] > 0) | (sums["extra"] != 0)]
    static = _whole(sent, "static", _STATIC)
    out = []
    for name, x in (("sums", sums), ("static", static)):
        place = _place(x["row"].astype(B.U64), parts)
        order = np.argsort(place, kind="stable")
        place, x = place[order], x[order]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
        ends = np.append(first, len(x)) * x.dtype.itemsize
        packed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x).view(np.uint8))])
        none = pa.array([b""] * len(first), pa.binary())
        out.append(pa.table([pa.array(place[first], pa.int32()), packed if name == "sums" else none, none if name == "sums" else packed], names=["part", "sums", "static"]))
    return pa.concat_tables(out)


def _added(group: pa.Table) -> pa.Table:
    """A row per text."""
    static, sums = _whole(group, "static", _STATIC), _whole(group, "sums", _SUM)
    static = static[np.argsort(static["row"])]
    at = np.searchsorted(static["row"], sums["row"])
    n = len(static)
    base = static["base"] + np.bincount(at, sums["base"], n)
    extra = static["extra"] + np.bincount(at, sums["extra"], n)
    known = static["known"] + np.bincount(at, sums["known"], n).astype(np.int64)
    return pa.table([pa.array(static["doc"], mask=static["null"] != 0), pa.array(static["tokens"]), pa.array(known), pa.array(base), pa.array(base + extra)],
                    names=[c.split(" ")[0] for c in _TOTAL.split(", ")])


def score_texts(docs: DataFrame, teach, s: Settings = Settings(), text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every
    row; ``teach``: condition on ``doc_id`` of the rows that are learned from."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", F.coalesce(teach, F.lit(False)).alias("teach"), "text")
    small_batches(docs.sparkSession)
    parts = max(spread(docs.sparkSession), min(text_bytes(docs) // (8 << 20), 1 << 16))
    model = learn(rows, s, parts)
    near = docs.sparkSession.sparkContext.broadcast(_Near(s.depth, model.log_total, model.sieve, model.hash, model.count, model.extra))

    def scored(some: DataFrame) -> DataFrame:
        sent = some.mapInArrow(lambda it: _scored(it, near.value, parts), _SENT)
        partial = sent.groupBy("part").cogroup(model.table.groupBy("of")).applyInArrow(lambda a, b: _looked_up(a, b, parts), _PARTIAL)
        return partial.groupBy("part").applyInArrow(_added, _TOTAL)

    of = F.pmod(F.xxhash64("doc_id", "text"), F.lit(s.slices))
    got = _union([_written(scored(rows.where(of == i)), "suffix-scores") for i in range(s.slices)])
    near.destroy()
    return got.select("doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
