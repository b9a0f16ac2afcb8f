"""License scan by diagonal voting.

Every text is cut into words and every rolling window of ``k`` words is joined
with the places of the same words in license templates (a fixed table, checked
to be small, so it is broadcast). A hit at word ``d`` of the text and word
``t`` of the template votes for the diagonal ``d - t``: the place where the
template would start. Votes are summed by (document, template, diagonal).

* A *phrase* stands where its diagonal has all its windows.
* Of a *notice*, neighbouring diagonals (up to ``slack`` words apart, as words
  added or lost shift the rest) are merged to one span. A span is verified by
  the share of the template's windows that it holds; a window counts only if
  its words are equal to the template's, word for word, which the join checks
  beside their hash. From ``least`` on it gives the notice's label.

A document's score is the largest share that any of its spans reaches (1 where
a phrase stands), 0 without hits.

Defined results: null and empty texts have no words and no labels (empty
strings), score 0; rows repeated under one id are judged each by their own
text; null ids are carried; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.llm.bytesops import LOWER as LOWER_BYTES
from presswork.llm.bytesops import PLAIN_SEPARATOR, chunks, text_buffers, window_hashes, window_starts, word_spans, words
from presswork.llm.common import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that give a label wherever they stand (label, words).
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: Openings of public license notices (label, text).
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                 "compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("gpl", "licensed under the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("public-domain", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "all rights reserved"),
)


@dataclass(frozen=True)
class Settings:
    k: int = 3
    #: Words by which merged diagonals may lie apart.
    slack: int = 3
    #: Share of a notice's windows that a span must hold.
    least: float = 0.6
    phrases: tuple[tuple[str, str], ...] = PHRASES
    notices: tuple[tuple[str, str], ...] = NOTICES
    #: Windows of all templates together; more are refused, as they are broadcast.
    max_windows: int = 1_000_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORDS), 0)


def templates(spark: SparkSession, s: Settings) -> DataFrame:
    """``(template, label, phrase, windows, t, hash, gram)``, a row for every window."""
    given = [(*x, True) for x in s.phrases] + [(*x, False) for x in s.notices]
    data, offs = text_buffers(pa.array([text for _, text, _ in given], pa.string()))
    w = words(data, offs, PLAIN_SEPARATOR, lower=True)
    if not given or w.counts.min() < s.k:
        raise ValueError(f"templates must have {s.k} words at least")
    if int(w.counts.sum()) > s.max_windows:
        raise ValueError(f"more than {s.max_windows} template windows")
    start, of = window_starts(w.first, s.k)
    h = window_hashes(w.hash, s.k).view(np.int64)
    body = LOWER_BYTES[data]
    rows = []
    for at, i in zip(start.tolist(), of.tolist(), strict=True):
        gram = " ".join(body[w.start[j]:w.end[j]].tobytes().decode() for j in range(at, at + s.k))
        rows.append((i, given[i][0], given[i][2], int(w.counts[i]) - s.k + 1, at - int(w.first[i]), int(h[at]), gram))
    return spark.createDataFrame(rows, "template int, label string, phrase boolean, windows int, t int, hash long, gram string")


def windows(texts: DataFrame, k: int) -> DataFrame:
    """``(doc, digest, text binary, hashes, starts, ends)``: the windows of each
    text that has any, with the bytes that they span."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffers(b.column("text"))
            for first, end, body, places in chunks(data, offs):
                w = words(body, places, PLAIN_SEPARATOR, lower=True)
                at, _ = window_starts(w.first, k)
                n = np.maximum(w.counts - k + 1, 0)
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                base = np.repeat(places[:-1], n)
                part = b.slice(first, end - first)

                def lists(x: np.ndarray, kind: pa.DataType, ends=ends) -> pa.Array:
                    return pa.ListArray.from_arrays(pa.array(ends), pa.array(x, kind))

                out = pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("digest"), part.column("text").cast(pa.binary()), lists(window_hashes(w.hash, k)[at].view(np.int64), pa.int64()),
                     lists(w.start[at] - base, pa.int32()), lists(w.end[at + k - 1] - base, pa.int32())],
                    names=["doc", "digest", "text", "hashes", "starts", "ends"])
                yield out.filter(pa.array(n > 0))

    kind = dict(texts.dtypes)["doc"]
    return texts.mapInArrow(run, f"doc {kind}, digest long, text binary, hashes array<long>, starts array<int>, ends array<int>")


def counted(texts: DataFrame) -> DataFrame:
    """``(doc, digest, n_words)`` of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffers(b.column("text"))
            n = [np.diff(np.searchsorted(word_spans(body, places, PLAIN_SEPARATOR)[0], places)) for _, _, body, places in chunks(data, offs)]
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("digest"), pa.array(np.concatenate([np.zeros(0, np.int64), *n]), pa.int64())],
                                             names=["doc", "digest", "n_words"])

    kind = dict(texts.dtypes)["doc"]
    return texts.mapInArrow(run, f"doc {kind}, digest long, n_words long")


def hits(texts: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """``(doc, digest, template, diagonal, t)``: each window of a text that is one of a template."""
    # the generator and the join run in one stage, so a text is only read where
    # a window's hash meets a template's
    each = windows(texts, k).select("doc", "digest", "text", "starts", "ends", F.posexplode("hashes").alias("d", "hash"))
    start = F.get("starts", F.col("d"))
    span = F.substr("text", start + 1, F.get("ends", F.col("d")) - start).cast("string")
    found = F.array_join(words_of(span), " ")
    # equal, said by two bounds: an equality would become a join key, made of every window
    met = each.join(F.broadcast(table), "hash").where((found >= F.col("gram")) & (found <= F.col("gram")))
    return met.select("doc", "digest", "template", "label", "phrase", "windows", (F.col("d") - F.col("t")).alias("diagonal"), "t")


def diagonals(found: DataFrame) -> DataFrame:
    """Votes by diagonal: the template's windows on it (at most as many as the template has)."""
    return (found.groupBy("doc", "digest", "template", "label", "phrase", "windows", "diagonal")
            .agg(F.collect_set("t").alias("ts")).withColumn("votes", F.size("ts")))


def spans(diagonal: DataFrame, s: Settings) -> DataFrame:
    """Merged neighbouring diagonals of notices: ``(doc, digest, template,
    label, span, first, share)``."""
    of = ["doc", "digest", "template", "label", "windows"]
    walk = Window.partitionBy("doc", "digest", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(walk) > s.slack, F.lit(True))
    marked = diagonal.withColumn("new", new.cast("int")).withColumn("span", F.sum("new").over(walk.rowsBetween(Window.unboundedPreceding, 0)))
    each = marked.select(*of, "span", "diagonal", F.explode("ts").alias("t"))
    got = each.groupBy(*of, "span").agg(F.count_distinct("t").alias("held"), F.min(F.col("diagonal") + F.col("t")).alias("first"))
    return got.select("doc", "digest", "template", "label", "span", "first", (F.col("held") / F.col("windows")).alias("share"))


def scan(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a row of ``docs``: ``(id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans)``; ``spans`` are the verified notices
    ``(label, first, share)``."""
    spark = docs.sparkSession
    # a row's texts are told apart by their digest where ids repeat
    texts = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("digest"), F.coalesce(text, F.lit("")).alias("text"))
    # one row a diagonal with votes; written once for the two readers below
    votes = cut_lineage(diagonals(hits(texts, templates(spark, s), s.k)))
    phrases = votes.where("phrase").groupBy("doc", "digest").agg(
        F.sum(F.when(F.col("votes") == F.col("windows"), 1).otherwise(0)).alias("n_base"),
        F.min(F.when(F.col("votes") == F.col("windows"), F.col("diagonal"))).alias("first_word"),
        F.max(F.when(F.col("votes") == F.col("windows"), F.col("diagonal"))).alias("last_word"),
        F.collect_set(F.when(F.col("votes") == F.col("windows"), F.col("label"))).alias("base"),
        F.max(F.col("votes") / F.col("windows")).alias("base_share"))
    got = spans(votes.where("not phrase"), s)
    fine = F.col("share") >= s.least
    notices = got.groupBy("doc", "digest").agg(
        F.collect_set(F.when(fine, F.col("label"))).alias("more"), F.max("share").alias("more_share"),
        F.array_sort(F.collect_set(F.when(fine, F.struct("label", "first", "share")))).alias("spans"))
    none = F.array().cast("array<string>")
    each = counted(texts)
    a, b = phrases.alias("a"), notices.alias("b")

    def same(x: str, y: str) -> Column:
        return F.col(f"{x}.doc").eqNullSafe(F.col(f"{y}.doc")) & (F.col(f"{x}.digest") == F.col(f"{y}.digest"))

    out = each.alias("e").join(a, same("e", "a"), "left").join(b, same("e", "b"), "left")
    base, more = F.coalesce("a.base", none), F.coalesce("b.more", none)
    return out.select(
        F.col("e.doc").alias(id_col), "e.n_words", F.coalesce("a.n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("a.first_word").cast("long").alias("first_word"), F.col("a.last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(F.coalesce("a.base_share", F.lit(0.0)), F.coalesce("b.more_share", F.lit(0.0))).alias("score"),
        F.coalesce("b.spans", F.array().cast("array<struct<label:string,first:int,share:double>>")).alias("spans"))
