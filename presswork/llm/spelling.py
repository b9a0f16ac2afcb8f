"""Spelling variants: one-edit neighbours found over a reduced alphabet.

Letters are hashed to a few symbols, so that many words share one reduced
word. The full one-edit neighbourhood of every reduced word (itself, each
deletion, replacement and insertion of a symbol) is generated and joined with
the reduced vocabulary: words one edit apart have reduced words that are equal
or one edit apart, so no pair is missed. The pairs of original words that meet
are then verified by edit distance. A reduced word is a polynomial key modulo
2**64, whose neighbours' keys follow from its prefix and suffix sums; keys that
meet by chance are sorted out by the verification like any other false pair.

A word's form is its near word of largest count (ties: smallest in code-point
order) where that count is at least ``ratio`` times its own; its root is the
end of the chain of forms. Counts grow by ``ratio`` along a chain, so a few
rounds of pointer jumping reach every root.

Defined results: null texts have no words; a null id counts as an empty one in
the hash of a run; rows repeated under one id count each; letters outside the
pattern separate words; an empty table gives no words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.bytesops import U64, text_buffers
from presswork.llm.common import cut_lineage, spread

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Settings:
    #: Letters of words, lower-cased; runs of them are words.
    letters: str = "a-zÀ-ÿ"
    least_length: int = 7
    least_count: int = 2
    ratio: int = 10
    #: Symbols that the letters are hashed to.
    symbols: int = 4
    #: One run in ``drop_of`` (by its hash) loses a letter first; None: none does.
    drop_of: int | None = None


def symbol_of(letters: np.ndarray, s: Settings) -> np.ndarray:
    """Symbols 1..s.symbols of code points."""
    seen, at = np.unique(letters, return_inverse=True)
    table = np.array([zlib.crc32(str(int(x)).encode()) % s.symbols + 1 for x in seen], np.int64)
    return table[at] if len(seen) else np.zeros(0, np.int64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.ones(n + 2, U64)
    up[1:] = U64(_BASE)
    up = np.multiply.accumulate(up)
    return up, U64(pow(_BASE, -1, 1 << 64))


def reduced(words: pa.Array, s: Settings) -> list[np.ndarray]:
    """Symbols of each word."""
    raw, offs = text_buffers(words)
    first = (raw & 0xC0) != 0x80  # bytes that start a code point
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    ends = np.concatenate([[0], np.cumsum(first)])[offs]
    sym = symbol_of(points, s)
    return [sym[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def keys(sym: np.ndarray) -> np.ndarray:
    """Keys of the rows of a matrix of symbols (one length)."""
    up, _ = _powers(sym.shape[1])
    return (sym.astype(U64) * up[:sym.shape[1]]).sum(axis=1, dtype=U64)


def neighbours(sym: np.ndarray, symbols: int) -> np.ndarray:
    """Keys of the full one-edit neighbourhood of each row (its own key first)."""
    m, n = sym.shape
    up, inverse = _powers(n)
    x = sym.astype(U64)
    term = x * up[:n]
    prefix = np.zeros((m, n + 1), U64)
    np.cumsum(term, axis=1, out=prefix[:, 1:])
    own = prefix[:, -1:]
    suffix = own - prefix  # symbols from i on
    out = [own]
    if n > 1:
        out.append(prefix[:, :n] + suffix[:, 1:] * inverse)
    for c in range(1, symbols + 1):
        out.append(own + (U64(c) - x) * up[:n])
        out.append(prefix + U64(c) * up[:n + 1] + suffix * U64(_BASE))
    return np.concatenate(out, axis=1)


def _by_length(words: pa.Array, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of the words of each length and their symbols as a matrix."""
    syms = reduced(words, s)
    length = np.array([len(x) for x in syms], np.int64)
    for n in np.unique(length).tolist():
        at = np.flatnonzero(length == n)
        yield at, np.stack([syms[i] for i in at.tolist()])


def run_of(text: Column, s: Settings) -> Column:
    """The maximal runs of letters of a text that can give words, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"[{s.letters}]{{{s.least_length},}}"), 0)


def occurrences(docs: DataFrame, s: Settings, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One ``word`` a counted run of a text."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(run_of(F.col(text), s)).alias("run"))
    if s.drop_of:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        runs = runs.withColumn("h", h)
        at = (F.col("h") % F.length("run")).cast("int")
        runs = runs.select(F.when(F.col("h") % s.drop_of == 0, F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))).otherwise(F.col("run")).alias("word"))
    else:
        runs = runs.select(F.col("run").alias("word"))
    return runs.where(F.length("word") >= s.least_length)


def vocabulary(docs: DataFrame, s: Settings, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n, key)``: words with enough occurrences, with the keys of their reduced words."""
    counts = occurrences(docs, s, id_col, text).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= s.least_count)

    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = np.zeros(b.num_rows, U64)
            for at, sym in _by_length(b.column("word"), s):
                key[at] = keys(sym)
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("n"), pa.array(key.view(np.int64))], names=["word", "n", "key"])

    return counts.mapInArrow(attach, "word string, n long, key long")


def neighbourhoods(words: DataFrame, s: Settings) -> DataFrame:
    """``(near_key, key)`` for the neighbourhood of each distinct reduced word,
    given one word of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mine = b.column("key").to_numpy()
            for at, sym in _by_length(b.column("word"), s):
                size = max(1, 400_000 // (2 * sym.shape[1] * s.symbols))
                for a in range(0, len(at), size):
                    near = neighbours(sym[a:a + size], s.symbols).view(np.int64)
                    near.sort(axis=1)
                    new = np.ones(near.shape, bool)
                    new[:, 1:] = near[:, 1:] != near[:, :-1]
                    row = np.repeat(mine[at[a:a + size]], new.sum(axis=1))
                    yield pa.RecordBatch.from_arrays([pa.array(near[new]), pa.array(row)], names=["near_key", "key"])

    return words.mapInArrow(run, "near_key long, key long")


def near_pairs(vocab: DataFrame, s: Settings) -> DataFrame:
    """``(word, n, near, near_n)`` of all words exactly one edit apart, both ways."""
    one = vocab.groupBy("key").agg(F.min("word").alias("word"))
    around = neighbourhoods(one, s)
    b = vocab.select(F.col("key").alias("near_key"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = around.join(b, "near_key").select("key", "near", "near_n")
    pairs = vocab.join(met, "key").where(F.levenshtein("word", "near", 1) == 1)
    # by an edit on two ways, or by chance, keys can meet twice
    return pairs.select("word", "n", "near", "near_n").distinct()


def variants(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the vocabulary."""
    spark = docs.sparkSession
    vocab = cut_lineage(vocabulary(docs, s, id_col, text).repartition(spread(spark), "key"))
    # most occurrences first, then the smallest word
    best = (near_pairs(vocab, s).groupBy("word", "n")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("b")))
    best = best.select("word", "n_near", F.when(-F.col("b.less") >= s.ratio * F.col("n"), F.col("b.near")).alias("form"),
                       F.when(-F.col("b.less") >= s.ratio * F.col("n"), -F.col("b.less")).alias("form_n"))
    got = cut_lineage(vocab.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n"))
    roots = _roots(got.where("form is not null").select("word", F.col("form").alias("root")))
    return got.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """``(word, root)``: the end of each word's chain of ``root`` links."""
    now = links
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = cut_lineage(now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if not now.where("moved").limit(1).count():
            return now.drop("moved")
        now = now.drop("moved")
