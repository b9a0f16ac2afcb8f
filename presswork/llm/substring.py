"""Substring dedup with fixed-block anchors.

Reference blocks are the non-overlapping runs of ``block`` words that start at
multiples of ``block`` in each document; probes are all rolling runs of that
length. Every window of ``window`` words holds one whole block when ``window
>= 2 * block - 1``, so a repeat of a window shows as a probe that meets a
block of another document. Anchored probes and blocks are extended to the
windows around them; a window is a repeat when its full fingerprint also
starts in a document with a smaller id. Runs of such windows are the maximal
exact repeats, and their words are removed (the smallest id keeps its own).

Steps, all balanced by fingerprint or id:

1. Probes: each task sorts the fingerprints of its documents by destination
   and sends packed rows (for a destination, the documents of a few MB of text
   and their distinct fingerprints, 4 bytes each, of which one bit marks blocks). A destination finds those that stand in a
   smaller document's block, and the blocks so met; the answer is a list of
   fingerprints per document. Only what a destination holds is compared, so
   4 bytes beside the destination's own bits are enough for a filter that
   loses nothing; chance hits end in step 2. Answers are packed by destination
   of their documents again, so rows do not multiply with destinations.
2. Windows: documents meet their answers by id; windows around anchored
   places are sent as 12-byte fingerprints, and those that start in a smaller
   document are answered in the same way.
3. Documents meet the answers by id and are cut.

A fingerprint counts once per document, so runs of one word or copied
documents put at most one entry a document in a destination.

Defined results: null, empty and short texts keep all their words; rows that
share an id are one document, whose windows are those of all its rows; rows
with null ids are never cut and cut nothing; empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm import bytesops as B
from presswork.llm.common import spread, text_bytes


@dataclass(frozen=True)
class Settings:
    window: int = 50
    block: int = 25

    def __post_init__(self):
        if self.window < 2 * self.block - 1:
            raise ValueError("a window must hold a whole block: window >= 2 * block - 1")


def _place(h: np.ndarray, parts: int) -> np.ndarray:
    """Destination of a fingerprint, from its upper half."""
    return ((h >> B.U64(32)) % B.U64(parts)).astype(np.int64)


def _groups(*sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of equal keys, and the run of each entry."""
    new = np.ones(len(sorted_keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return np.flatnonzero(new), np.cumsum(new) - 1


def _rows(part: np.ndarray, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """A packed row for each destination: ids, how many values each has, and
    the values. Ordered by (part, id)."""
    entry, _ = _groups(part, ids)
    size = np.diff(np.append(entry, len(part))).astype(np.uint32)
    first, _ = _groups(part[entry])
    ends = np.append(first, len(entry))
    at = np.append(entry, len(part))[ends]

    def packed(x: np.ndarray, cuts: np.ndarray) -> pa.Array:
        raw = pa.py_buffer(np.ascontiguousarray(x).view(np.uint8))
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((cuts * x.dtype.itemsize).astype(np.int32)), raw])

    return pa.RecordBatch.from_arrays(
        [pa.array(part[entry][first], pa.int32()), packed(ids[entry], ends), packed(size, ends), packed(values, at)],
        names=["part", "ids", "sizes", "fingerprints"])


_PACKED = "part int, ids binary, sizes binary, fingerprints binary"


def _unpacked(group: pa.Table, kind) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a destination with the id of each."""
    def whole(name, dtype):
        return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(x.as_buffer(), dtype) for x in group.column(name))])

    return whole("fingerprints", kind), np.repeat(whole("ids", np.int64), whole("sizes", np.uint32).astype(np.int64))


def _answers(doc: np.ndarray, values: np.ndarray, parts: int) -> pa.Table:
    """The values packed by destination of their documents."""
    dest = _place(B.mix64(doc.astype(np.uint64)), parts)
    order = np.lexsort((doc, dest))
    got = [_rows(dest[order], doc[order], values[order])] if len(doc) else []
    return pa.Table.from_batches(got, _PACKED_ARROW)


_PACKED_ARROW = pa.schema([("part", pa.int32()), ("ids", pa.binary()), ("sizes", pa.binary()), ("fingerprints", pa.binary())])


_ANSWER = "doc_id long, answer binary"


def _by_document(group: pa.Table, kind) -> pa.Table:
    """A row per document with all its answers."""
    values, doc = _unpacked(group, kind)
    order = np.argsort(doc, kind="stable")
    doc, values = doc[order], values[order]
    row, _ = _groups(doc)
    ends = np.append(row, len(doc)) * values.dtype.itemsize
    packed = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())
    return pa.table([pa.array(doc[row], pa.int64()), packed], names=["doc_id", "answer"])


# --- step 1: anchors ------------------------------------------------------

def _probes(batches, s: Settings, parts: int):
    """Distinct probe fingerprints of each document, its blocks first."""
    for batch in batches:
        data, offs = B.text_buffers(batch.column(1))
        ids = batch.column(0).to_numpy()
        for a, b, piece, o in B.chunks(data, offs):
            w = B.words(piece, o)
            at, doc = B.window_starts(w.first, s.block)
            if not len(at):
                continue
            h = B.window_hashes(w.hash, s.block)[at]
            block = (at - w.first[doc]) % s.block == 0
            # the lowest bit says whether the fingerprint is a block of the document
            h = (h & ~B.U64(1)) | block
            first = np.concatenate([[0], np.cumsum(np.maximum(w.counts - s.block + 1, 0))])
            B.sort_within(h, first)
            keep = np.append(B.run_starts(h >> B.U64(1), first)[1:], len(h)) - 1  # the last of a run: with the bit, if any has it
            part = _place(h[keep], parts)
            order = np.argsort(part, kind="stable")
            keep = keep[order]
            yield _rows(part[order], ids[a:b][doc[keep]], (h[keep] & B.U64(0xFFFFFFFF)).astype(np.uint32))


def _anchored(group: pa.Table, parts: int) -> pa.Table:
    """Which fingerprints of a destination are anchored, per document: probes
    that are a smaller document's block, and blocks that a larger one probes."""
    low, doc = _unpacked(group, np.uint32)
    order = np.argsort(low, kind="stable")
    low, doc = low[order], doc[order]
    block = (low & np.uint32(1)).astype(bool)
    low >>= np.uint32(1)
    start, each = _groups(low)
    if len(start):
        least = np.minimum.reduceat(np.where(block, doc, np.iinfo(np.int64).max), start)
        most = np.maximum.reduceat(doc, start)
        keep = (doc > least[each]) | (block & (doc < most[each]))
        doc, low = doc[keep], low[keep]
    return _answers(doc, low, parts)


# --- step 2: windows ------------------------------------------------------

def _lists(col: pa.Array) -> list[np.ndarray]:
    """The bytes of each document's answer; none where there is none."""
    raw, offs = B.text_buffers(col.cast(pa.large_binary()))
    return [raw[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]


def _keys(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    return B.mix64(h + (doc.astype(np.uint64) + B.U64(1)) * B.U64(0x9E3779B97F4A7C15))


def _among(doc: np.ndarray, h: np.ndarray, answers: list[np.ndarray], dtype) -> np.ndarray:
    """Whether each fingerprint is in the answers of its document."""
    size = np.array([len(x) // np.dtype(dtype).itemsize for x in answers], np.int64)
    if not size.sum():
        return np.zeros(len(h), bool)
    have = np.concatenate(answers).view(dtype).astype(np.uint64)
    return np.isin(_keys(doc, h), _keys(np.repeat(np.arange(len(size)), size), have))


def _candidates(w: B.Words, answers: list[np.ndarray], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a chunk that hold an anchored place: word position and text."""
    at, doc = B.window_starts(w.first, s.block)
    win, of = B.window_starts(w.first, s.window)
    if not len(win):
        return win, of
    h = (B.window_hashes(w.hash, s.block)[at] & B.U64(0xFFFFFFFF)) >> B.U64(1)
    hit = _among(doc, h, answers, np.uint32)
    before = np.zeros(len(w.hash) + 2, np.int64)
    before[at[hit] + 1] = 1
    before = np.cumsum(before)  # anchored places before each word
    keep = before[win + s.window - s.block + 1] > before[win]
    return win[keep], of[keep]


#: A window's full fingerprint: 96 bits.
_FULL = np.dtype([("h", np.uint64), ("g", np.uint32)])


def _windows(batches, s: Settings, parts: int):
    """Distinct fingerprints of the candidate windows of each document."""
    for batch in batches:
        data, offs = B.text_buffers(batch.column("text"))
        ids = batch.column("doc_id").to_numpy()
        answers = _lists(batch.column("answer"))
        for a, b, piece, o in B.chunks(data, offs):
            w = B.words(piece, o)
            win, doc = _candidates(w, answers[a:b], s)
            if not len(win):
                continue
            h = B.window_hashes(w.hash, s.window)[win]
            g = B.window_hashes(w.hash, s.window, 0x5851F42D4C957F2D)[win]
            doc = ids[a:b][doc]
            part = _place(h, parts)
            order = np.lexsort((h, doc, part))
            part, doc, h, g = part[order], doc[order], h[order], g[order]
            start, _ = _groups(part, doc, h, g)
            both = np.empty(len(start), _FULL)
            both["h"], both["g"] = h[start], g[start] >> B.U64(32)
            yield _rows(part[start], doc[start], both)


def _repeated(group: pa.Table, parts: int) -> pa.Table:
    """Windows of a destination that also start in a smaller document."""
    both, doc = _unpacked(group, _FULL)
    h, g = both["h"], both["g"]
    order = np.lexsort((g, h))
    h, g, doc = h[order], g[order], doc[order]
    start, each = _groups(h, g)
    if len(start):
        keep = doc > np.minimum.reduceat(doc, start)[each]
        doc, h = doc[keep], h[keep]
    return _answers(doc, h, parts)


# --- step 3: cut ----------------------------------------------------------

def _cut(batches, s: Settings, carry: list[str]):
    for batch in batches:
        data, offs = B.text_buffers(batch.column("text"))
        answers = _lists(batch.column("answer"))
        for a, b, piece, o in B.chunks(data, offs):
            w = B.words(piece, o)
            n = b - a
            win, doc = B.window_starts(w.first, s.window)
            if len(win) and any(map(len, answers[a:b])):
                bad = _among(doc, B.window_hashes(w.hash, s.window)[win], answers[a:b], np.uint64)
                gone = B.covered(len(w.hash), win[bad], win[bad] + s.window)
            else:
                gone = np.zeros(len(w.hash), bool)
            of = w.doc
            # spans of removed words, in words of their text
            edge = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
            first = gone & (edge | ~np.concatenate([[False], gone[:-1]])) if len(of) else gone
            last = gone & (np.concatenate([edge[1:], [True]]) | ~np.concatenate([gone[1:], [False]])) if len(of) else gone
            start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
            spans = pa.StructArray.from_arrays([pa.array(start - w.first[of[start]]), pa.array(end - w.first[of[start]])], ["start", "end"])
            spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(of[start], np.arange(n + 1)), pa.int32()), spans)
            # kept words with one space after each but the last of a text
            keep = np.flatnonzero(~gone)
            inside = B.covered(len(piece) + 1, w.start[keep], w.end[keep])
            joined = keep[:-1][of[keep[1:]] == of[keep[:-1]]] if len(keep) else keep
            out = np.append(piece, np.uint8(0))
            inside[w.end[joined]] = True
            out[w.end[joined]] = 0x20
            size = np.concatenate([[0], np.cumsum(inside)])[o]
            text = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(size.astype(np.int32)), pa.py_buffer(out[inside])])
            cols = [batch.column(c).slice(a, n) for c in carry]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(w.counts), pa.array(np.bincount(of, gone, n).astype(np.int64) if len(of) else np.zeros(n, np.int64)), spans, text],
                names=[*carry, "n_words", "n_removed", "removed", "kept"])


def remove_repeats(docs: DataFrame, s: Settings = Settings(), text: str = "text", id_col: str = "doc_id", parts: int | None = None) -> DataFrame:
    """Every row of ``docs`` (its other columns too) with n_words, n_removed,
    removed (spans of word places) and kept (the kept words joined by a space).
    Columns of ``docs`` with these names are replaced."""
    spark, new = docs.sparkSession, ("n_words", "n_removed", "removed", "kept")
    carry = [id_col, text, *(c for c in docs.columns if c not in (id_col, text, *new))]
    names = ["doc_id", "text", *(f"c{i}" for i in range(len(carry) - 2))]
    kinds = dict(docs.dtypes)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       *(F.col(f"`{c}`").alias(n) for c, n in zip(carry[2:], names[2:], strict=True)))
    known = rows.where("doc_id is not null")
    # a destination holds the probes of about 8 MB of stored input
    parts = parts or max(spread(spark), min(text_bytes(docs) // (8 << 20), 1 << 16))

    def answered(packed: DataFrame, merge, kind) -> DataFrame:
        got = packed.groupBy("part").applyInArrow(lambda t: merge(t, parts), _PACKED)
        return got.groupBy("part").applyInArrow(lambda t: _by_document(t, kind), _ANSWER)

    anchors = answered(known.select("doc_id", "text").mapInArrow(lambda it: _probes(it, s, parts), _PACKED), _anchored, np.uint32)
    # both joins read the same columns, so that the texts are shuffled once
    met = known.join(anchors, "doc_id").select(*names, "answer")
    repeats = answered(met.mapInArrow(lambda it: _windows(it, s, parts), _PACKED), _repeated, np.uint64)
    none = F.lit(b"")
    last = known.join(repeats, "doc_id", "left").select(*names, F.coalesce("answer", none).alias("answer"))
    # in this order the optimiser leaves both reads of the texts alike, and their shuffle is used twice
    last = rows.where("doc_id is null").withColumn("answer", none).unionByName(last)
    kind = {"doc_id": "long", "text": kinds[text], **{n: kinds[c] for c, n in zip(carry[2:], names[2:], strict=True)}}
    schema = ", ".join(f"{n} {kind[n]}" for n in names) + ", n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept string"
    out = last.mapInArrow(lambda it: _cut(it, s, names), schema)
    return out.select(*(F.col(n).alias(c) for c, n in zip(carry, names, strict=True)), *new)
