"""Best-two-fit packing of tokenised documents into fixed-length sequences.

A document is its token ids and a closing id 0. Documents longer than a
sequence are cut into pieces of exactly that length; the last piece may be
shorter. Pieces are packed block by block: a bin opens with the longest
unpacked piece, is filled greedily with the longest piece that fits, and then
its smallest piece is exchanged for the two unpacked pieces that fill the gap
it leaves most tightly, if they fill more than it did.

Blocks are balanced by row, hold ``block_pieces`` pieces and end in at most a
few bins that are not full, so the number of sequences is within one in
thousands of a single packing while no task sees more than a block.

Defined results: a null or empty text is the single id 0; repeated rows are
packed each for itself; null ids are carried; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm import bytesops as B
from presswork.llm.common import cut_lineage

TOKENIZER = "word_bpe_49k.json"


@dataclass(frozen=True)
class Settings:
    capacity: int = 2048
    block_pieces: int = 16384
    cache_words: int = 600_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself where it is printable, else the next unused one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: Characters whose lower case, letter class and composed form are the same in
#: every Unicode version: printable ASCII and the letters of Latin-1.
_SIMPLE = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
#: Fixed value: the vocabulary's pattern of pieces, for those characters.
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


#: Fixed value: that pattern as the vocabulary file states it.
_SPLIT = json.dumps("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")


class WordTokens:
    """Ids of whole texts from ids of their words.

    The vocabulary drops white space before it merges, so the ids of a text
    are those of its white-space separated words in order. Words of plain
    characters are cut into pieces here and only merged by the tokenizer's
    model; all others go through the whole tokenizer. Words and pieces seen
    before are looked up; the tables start anew beyond ``limit`` words.
    """

    def __init__(self, path: str, limit: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        # the short cut holds for the pattern above only: try it on the vocabulary's own rules
        rules = json.loads(self.tokenizer.to_str())
        self.simple = (rules["pre_tokenizer"] or {}).get("type") == "Sequence" and _SPLIT in json.dumps(rules["pre_tokenizer"]) \
            and [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chars = _byte_chars()
        self._clear()

    def _clear(self):
        self.at: dict[bytes, int] = {}
        self.piece: dict[str, list[int]] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _merged(self, piece: str) -> list[int]:
        if (ids := self.piece.get(piece)) is None:
            raw = piece if piece.isascii() else "".join(self.chars[b] for b in piece.encode())
            ids = self.piece[piece] = [t.id for t in self.tokenizer.model.tokenize(raw)]
        return ids

    def _ids(self, word: bytes) -> list[int]:
        if self.simple:
            if word.isalpha():  # ASCII letters only: one piece
                return self._merged(word.lower().decode())
            if word[:-1].isalpha() and word[-1] in b".,":
                return self._merged(word[:-1].lower().decode()) + self._merged(chr(word[-1]))
        text = word.decode("utf-8", "replace")
        if not self.simple or not _SIMPLE.fullmatch(text) or any(x in text for x in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return [x for p in _PIECE.findall(text.lower()) for x in self._merged(p)]

    def _add(self, words: list[bytes]) -> None:
        got = [self._ids(w) for w in words]
        size = np.fromiter(map(len, got), np.int64, len(got))
        n, total = len(self.at), int(size.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(got) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(got), np.uint32, total)
        self.start[n:n + len(got)], self.size[n:n + len(got)] = self.used + np.cumsum(size) - size, size
        self.used += total
        self.at.update(zip(words, range(n, n + len(words)), strict=True))

    def texts(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk of texts, each with a closing 0, and their offsets."""
        w = B.words(data, offs)
        _, where, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        raw = data.tobytes()
        distinct = [raw[a:b] for a, b in zip(w.start[where].tolist(), w.end[where].tolist(), strict=True)]
        if len(self.at) + len(distinct) > self.limit:
            self._clear()
        if missing := [x for x in distinct if x not in self.at]:
            self._add(missing)
        known = np.fromiter((self.at[x] for x in distinct), np.int64, len(distinct))[inverse]
        size = self.size[known]
        total = np.concatenate([[0], np.cumsum(size)])[w.first]  # ids before each text, without closing ids
        ids = self.flat[B.ranges(self.start[known], size)]
        n = len(offs) - 1
        out = np.zeros(len(ids) + n, np.uint32)
        offsets = total + np.arange(n + 1)
        body = np.ones(len(out), bool)
        body[offsets[1:] - 1] = False
        out[body] = ids
        return out, offsets


def pieces(docs: DataFrame, s: Settings = Settings(), tokenizer: str | None = None, text: str = "text",
           id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and the ids)."""
    path, kind = tokenizer or tokenizer_path(), dict(docs.dtypes)[id_col]

    def run(batches) -> Iterator[pa.RecordBatch]:
        tok = WordTokens(path, s.cache_words)
        for batch in batches:
            data, offs = B.text_buffers(batch.column(1))
            for a, b, part, o in B.chunks(data, offs):
                ids, offsets = tok.texts(part, o)
                total = np.diff(offsets)
                n = -(-total // s.capacity)
                doc = np.repeat(np.arange(b - a), n)
                piece = B.ranges(np.zeros(b - a, np.int64), n)
                start = piece * s.capacity
                length = np.minimum(total[doc] - start, s.capacity)
                at, raw = offsets[doc] + start, ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * x:4 * (x + y)]) for x, y in zip(at.tolist(), length.tolist(), strict=True)]
                cols = [batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(length)])
                    cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


class _Pool:
    """Unpacked pieces by length; the lengths present are bits of one integer."""

    def __init__(self, lengths: np.ndarray):
        order = np.argsort(lengths, kind="stable")[::-1]
        self.left: dict[int, list[int]] = {}
        for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
            self.left.setdefault(n, []).append(i)
        self.bits = sum(1 << n for n in self.left)

    def longest(self, at_most: int) -> int:
        return (self.bits & ((1 << (at_most + 1)) - 1)).bit_length() - 1 if at_most > 0 else -1

    def take(self, n: int) -> int:
        i = self.left[n].pop()
        if not self.left[n]:
            del self.left[n]
            self.bits ^= 1 << n
        return i

    def give(self, n: int, i: int) -> None:
        self.left.setdefault(n, []).append(i)
        self.bits |= 1 << n

    def best_two(self, room: int, more_than: int) -> tuple[int, int] | None:
        best, found, a = more_than, None, self.longest(room)
        while a > 0 and 2 * a > best:
            b = self.longest(min(a, room - a))
            if b == a and len(self.left[a]) < 2:
                b = self.longest(a - 1)
            if b > 0 and a + b > best:
                best, found = a + b, (a, b)
                if best == room:
                    break
            a = self.longest(a - 1)
        return found


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece (all lengths from 1 to ``capacity``)."""
    pool, bins, offset, k = _Pool(lengths), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    while pool.bits:
        inside: list[tuple[int, int]] = []
        gap = capacity

        def fill():
            nonlocal gap
            while (n := pool.longest(gap)) > 0:
                inside.append((n, pool.take(n)))
                gap -= n

        fill()
        if gap and pool.bits:
            n, i = min(inside)
            if two := pool.best_two(gap + n, n):
                inside.remove((n, i))
                inside += [(x, pool.take(x)) for x in two]
                gap += n - sum(two)
                pool.give(n, i)
                fill()
        place = 0
        for n, i in inside:
            bins[i], offset[i] = k, place
            place += n
        k += 1
    return bins, offset


def pack(table: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Adds sequence_id and offset to the pieces of ``table`` (written once to
    the checkpoint folder: a few numbers per piece)."""
    table = cut_lineage(table)
    blocks = max(1, -(-table.count() // s.block_pieces))
    kind = dict(table.dtypes)["doc_id"]
    # the row number of the written table deals equal or null ids out evenly
    dealt = table.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        bins, offset = best_two_fit(group.column("length").to_numpy(), s.capacity)
        block = group.column("block")[0].as_py()
        return group.select(cols).append_column("sequence_id", pa.array(bins + (block << 32))).append_column("offset", pa.array(offset))

    return dealt.groupBy("block").applyInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, s: Settings = Settings(), tokenizer: str | None = None, text: str = "text",
                   id_col: str = "doc_id") -> DataFrame:
    return pack(pieces(docs, s, tokenizer, text, id_col), s)
