"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased. Seeds of a benchmark item
are all its runs of ``n`` and of ``n - 1`` words that at most ``common`` of the
corpus's documents hold (or ``least_common`` documents, if that is more; a
count over all documents). Where a stretch of ``stretch`` words has no n-gram
below that bound that any document holds, all n-grams that start in it are
seeds. A document passage that holds a seed of an item is joined to it
and a window around the seed's diagonal is aligned with the whole item by
Smith-Waterman (match 2, mismatch -1, gap -1 a word). The score is the
alignment's part of a full match; pairs at ``threshold`` or more are returned,
and, whatever their score, pairs that share ``passage`` words in a row.

The items of one pass are broadcast; a pass takes at most ``pass_words`` words
of items, and a larger benchmark goes in several passes over the documents.

Defined results: null or empty texts and items match nothing; an item shorter
than the n-gram is its own seed; an item that is there twice under one id and
text counts once; repeated documents are each reported; null ids are carried;
empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm import bytesops as B


@dataclass(frozen=True)
class Settings:
    n: int = 3                 # words of a seed; runs of n - 1 are seeds too
    stretch: int = 4           # item words that have a seed, however frequent
    common: float = 0.01       # part of the documents that a seed may be in
    least_common: int = 100    # documents that a seed may be in, however few there are
    threshold: float = 0.5
    passage: int = 13          # words in a row that are reported below the threshold too
    slack: float = 0.25        # window beyond the item's length, as a part of it, on each side
    pass_words: int = 2_000_000


_FILTER_BITS = 22


class Items:
    """Word hashes of the items of one pass and lookup tables of their n-grams."""

    def __init__(self, ids: list, texts: list[str], s: Settings):
        data, offs = B.text_buffers(pc.utf8_lower(pa.array(texts, pa.string())))
        w = B.words(data, offs, B.PLAIN_SEPARATOR)
        self.ids, self.hash, self.first, self.s = ids, w.hash, w.first, s
        length = np.diff(w.first)
        size = np.minimum(length, s.n)  # words of the item's longer seeds
        self.vocabulary, self.word = np.unique(w.hash, return_inverse=True)
        grams, item, at, span = [], [], [], []
        for k in range(1, s.n + 1):
            pos, doc = B.window_starts(w.first, k)
            mine = (size[doc] == k) | ((size[doc] == s.n) & (k == s.n - 1))
            grams.append(B.window_hashes(w.hash, k)[pos[mine]])
            item.append(doc[mine])
            at.append(pos[mine] - w.first[doc[mine]])
            span.append(np.full(int(mine.sum()), k))
        self.gram = np.concatenate(grams)
        self.item, self.at, self.span = (np.concatenate(x) for x in (item, at, span))
        self.whole = self.span == size[self.item]
        self._index()

    def _index(self) -> None:
        self._take(np.lexsort((self.at, self.item, self.gram)))
        self.keys, self.key_start = np.unique(self.gram, return_index=True)
        self.key_size = np.diff(np.append(self.key_start, len(self.gram)))
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self.keys >> B.U64(64 - _FILTER_BITS)] = True
        self.sizes = np.unique(self.span).tolist()

    def _take(self, x: np.ndarray) -> None:
        self.gram, self.item, self.at, self.span, self.whole = self.gram[x], self.item[x], self.at[x], self.span[x], self.whole[x]

    def keep_seeds(self, counts: np.ndarray, docs: int) -> None:
        """Keeps the n-grams that are seeds; those that no document has find nothing."""
        n = counts[np.searchsorted(self.keys, self.gram)]
        rare = (n > 0) & (n <= max(self.s.common * docs, self.s.least_common))
        _, stretch = np.unique(self.item * (1 << 32) + self.at // self.s.stretch, return_inverse=True)
        has = np.bincount(stretch, rare & self.whole) > 0
        self._take(rare | ((n > 0) & self.whole & ~has[stretch]))
        self._index()

    def hits(self, w: B.Words) -> tuple[np.ndarray, np.ndarray]:
        """Word positions of the chunk where an n-gram of the items starts, and its key."""
        out, keys = [], []
        for k in self.sizes:
            h = B.window_hashes(w.hash, k)
            at = np.flatnonzero(self.seen[h >> B.U64(64 - _FILTER_BITS)])
            key = np.searchsorted(self.keys, h[at]).clip(max=len(self.keys) - 1)
            ok = self.keys[key] == h[at]
            at, key = at[ok], key[ok]
            inside = at + k <= w.first[np.searchsorted(w.first, at, "right")]
            out.append(at[inside])
            keys.append(key[inside])
        none = np.zeros(0, np.int64)
        return (np.concatenate(out), np.concatenate(keys)) if out else (none, none)


def smith_waterman(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score and its (exclusive) end column for each row of
    ``windows``; 0 marks a column without a word."""
    rows, cols = windows.shape
    column = np.arange(1, cols + 1, dtype=np.int32)
    last = np.zeros((rows, cols + 1), np.int32)
    best, end = np.zeros(rows, np.int32), np.zeros(rows, np.int64)
    blank = windows == 0
    for x in item:
        step = np.where(windows == x, 2, -1)
        step[blank] = -4
        now = np.maximum(np.maximum(last[:, :-1] + step, last[:, 1:] - 1), 0)
        now = np.maximum.accumulate(now + column, axis=1) - column  # gaps along the row
        last[:, 1:] = now
        at = now.argmax(axis=1)
        top = now[np.arange(rows), at]
        better = top > best
        best[better], end[better] = top[better], at[better] + 1
    return best, end


def _common(words: np.ndarray, code: np.ndarray, local: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words that an item and each window have in common, repeats counted: no
    alignment matches more. ``local``: -1 for each word, as it is left."""
    each, times = np.unique(words, return_counts=True)
    local[each] = np.arange(len(each))
    out = np.zeros(len(first), np.int64)
    upto = np.cumsum(end - first) + np.arange(1, len(first) + 1) * len(each)
    a = 0
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + (1 << 20), "right")))
        size = end[a:b] - first[a:b]
        at = local[code[B.ranges(first[a:b], size)]]
        cell = np.repeat(np.arange(b - a) * len(each), size)[at >= 0] + at[at >= 0]
        seen = np.bincount(cell, minlength=(b - a) * len(each)).reshape(b - a, len(each))
        out[a:b] = np.minimum(seen, times).sum(axis=1)
        a = b
    local[each] = -1
    return out


def _align(items: Items, w: B.Words, pos: np.ndarray, key: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
    """Text, item, score, first and end word of the best alignment of each pair
    that reaches the threshold or holds a passage."""
    s = items.s
    size = items.key_size[key]
    entry = B.ranges(items.key_start[key], size)
    at = np.repeat(pos, size)
    doc = np.searchsorted(w.first, at, "right") - 1
    item = items.item[entry]
    diagonal = at - items.at[entry]
    order = np.lexsort((diagonal, doc, item))
    item, doc, diagonal = item[order], doc[order], diagonal[order]
    length = np.diff(items.first)
    # a window per run of near diagonals: a run starts anew beyond the slack
    slack = np.ceil(s.slack * length).astype(np.int64)[item] + s.n
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (diagonal[1:] - diagonal[:-1] > slack[1:])
    run = np.flatnonzero(new)
    stop = np.append(run[1:], len(item)) - 1
    first = np.maximum(diagonal[run] - slack[run], w.first[doc[run]])
    end = np.minimum(diagonal[stop] + length[item[run]] + slack[run], w.first[doc[run] + 1])
    item, doc = item[run], doc[run]
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    code = np.searchsorted(items.vocabulary, w.hash).clip(max=len(items.vocabulary) - 1)
    code[items.vocabulary[code] != w.hash] = len(items.vocabulary)
    local = np.full(len(items.vocabulary) + 1, -1)
    group = np.argsort(item, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], np.diff(item[group]) > 0, [True]]))
    for mine in (group[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)):
        i = int(item[mine[0]])
        words = items.hash[items.first[i]:items.first[i + 1]]
        full = s.threshold * 2 * len(words)
        need = min(full, 2 * s.passage)
        runs = B.window_hashes(words, s.passage)
        mine = mine[2 * _common(items.word[items.first[i]:items.first[i + 1]], code, local, first[mine], end[mine]) >= need]
        mine = mine[np.argsort(end[mine] - first[mine], kind="stable")]
        while len(mine):
            width = int(end[mine[0]] - first[mine[0]])
            count = max(1, (1 << 19) // max(width, 1))
            part = mine[:count]
            part = part[end[part] - first[part] <= max(2 * width, width + 16)]
            mine = mine[len(part):]
            cols = int((end[part] - first[part]).max())
            grid = first[part][:, None] + np.arange(cols)
            windows = np.where(grid < end[part][:, None], w.hash[np.minimum(grid, len(w.hash) - 1)], B.U64(0))
            score, stop_col = smith_waterman(words, windows)
            good = np.flatnonzero(score >= need)
            if not len(good):
                continue
            # the start: the same alignment of both reversed, from the end found
            back = np.where(np.arange(cols) < stop_col[good][:, None], windows[good], B.U64(0))[:, ::-1]
            _, from_end = smith_waterman(words[::-1], back)
            for g, e, b in zip(good.tolist(), stop_col[good].tolist(), from_end.tolist(), strict=True):
                p = part[g]
                if score[g] < full and not np.isin(B.window_hashes(w.hash[first[p]:end[p]], s.passage), runs).any():
                    continue
                found = (float(score[g]) / (2 * len(words)), int(first[p] + cols - b), int(first[p] + e))
                k = (int(doc[p]), i)
                if k not in best or found[0] > best[k][0]:
                    best[k] = found
    for (d, i), (score_, a, z) in sorted(best.items()):
        yield d, i, score_, int(a - w.first[d]), int(z - w.first[d])


def _chunks(batches) -> Iterator[tuple[pa.Array, B.Words]]:
    for batch in batches:
        data, offs = B.text_buffers(pc.utf8_lower(batch.column(1)))
        for a, b, part, o in B.chunks(data, offs):
            yield batch.column(0).slice(a, b - a), B.words(part, o, B.PLAIN_SEPARATOR)


def _count(batches, items: Items):
    """Documents of the task that have each n-gram of the items; under -1 all."""
    total, docs = np.zeros(len(items.keys), np.int64), 0
    for _, w in _chunks(batches):
        docs += len(w.first) - 1
        pos, key = items.hits(w)
        if len(pos):
            doc = np.searchsorted(w.first, pos, "right") - 1
            pair = np.unique(doc * len(items.keys) + key)
            total += np.bincount(pair % len(items.keys), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], docs))], names=["gram", "n"])


def _match(batches, items: Items, kind: pa.DataType):
    for ids, w in _chunks(batches):
        pos, key = items.hits(w)
        rows = list(_align(items, w, pos, key)) if len(pos) else []
        if rows:
            doc, item, score, a, z = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(doc)), pa.array([items.ids[i] for i in item], kind), pa.array(score), pa.array(a, pa.int64()), pa.array(z, pa.int64())],
                names=["doc_id", "item_id", "score", "first_word", "end_word"])


def contaminated(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings(), text: str = "text", id_col: str = "doc_id",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, item_id, score, first_word, end_word)``: the best alignment of
    each document and item that reaches the threshold or holds a passage."""
    from pyspark.sql.pandas.types import to_arrow_type

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).where("text is not null").distinct()
    kind, item_kind = dict(texts.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    arrow = to_arrow_type(items.schema["item_id"].dataType)
    schema = f"doc_id {kind}, item_id {item_kind}, score double, first_word long, end_word long"
    words = items.select(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] or 0
    passes, out = max(1, -(-int(words) // s.pass_words)), None
    for i in range(passes):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == i).orderBy("item_id", "text").collect()
        index = Items([r["item_id"] for r in mine], [r["text"] for r in mine], s)
        counts = np.zeros(len(index.keys), np.int64)
        if len(index.keys):
            got = (texts.mapInArrow(lambda it, index=index: _count(it, index), "gram long, n long")
                   .groupBy("gram").agg(F.sum("n").alias("n")).toArrow())  # at most one row per n-gram of the pass, and one
            gram, n = got.column("gram").to_numpy(), got.column("n").to_numpy()
            counts[gram[gram >= 0]] = n[gram >= 0]
            index.keep_seeds(counts, int(n[gram < 0].sum()))
        part = texts.mapInArrow(lambda it, index=index: _match(it, index, arrow) if len(index.keys) else iter(()), schema)
        out = part if out is None else out.unionByName(part)
    return out
