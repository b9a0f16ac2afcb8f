"""The registered queries against plain versions on the small driver tables."""

from __future__ import annotations

import math
import struct
import zlib
from collections import Counter

import brute
import duckdb
import numpy as np
import pytest

from presswork.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def rows(spark, n, sf=SF):
    name = next(k for k in QUERIES if k.startswith(f"op{n}_"))
    return QUERIES[name](spark, sf).collect()


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.mark.parametrize("n", [9, 10])
def test_sql(spark, n):
    name = next(k for k in QUERIES if k.startswith(f"op{n}_"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{SF}/pages.parquet')")
    rel = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(rel.columns)
    assert Counter(tuple(r) for r in got.select(*rel.columns).collect()) == Counter(rel.fetchall())


def test_op2(spark, docs):
    want = brute.repeats(docs)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows(spark, 2)}
    assert got == want


def test_op3(spark, docs):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok, want = Tokenizer.from_file(P.path("word_bpe_49k.json")), {}
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k:k + 2048]
            want[i, k // 2048] = (k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
    got = rows(spark, 3)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= math.ceil(sum(r.length for r in got) / 2048) + 1


@pytest.mark.parametrize("n,label,fold,cut", [(4, "quality", (4, 2), 0.7), (5, "toxic", (5, 0), 0.5)])
def test_classifiers(spark, n, label, fold, cut):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = rows(spark, n, sf)
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in got)
    assert all(r.held_out == (brute.fold(r.doc_id, fold[0]) == fold[1]) for r in got)
    held = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    right = sum(r.predicted == truth[r.doc_id] for r in held) / len(held)
    assert right > 0.97


def test_op6(spark, docs):
    seen = Counter(w for i, t in docs if brute.fold(i, 7) != 2 for w in [*brute.words(t, True), None])
    total, distinct, text = sum(seen.values()), len(seen), dict(docs)
    base = score = 0.0
    got = rows(spark, 6)
    assert len(got) == len(docs)
    for r in got:
        w = [*brute.words(text[r.doc_id], True), None]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(seen[x] > 0 for x in w), total, brute.fold(r.doc_id, 7) == 2)
        assert r.base_score == pytest.approx(sum(math.log10((seen[x] + 1) / (total + distinct + 1)) for x in w), rel=1e-9)
        if r.held_out:
            base, score = base + r.base_score, score + r.score
    assert score > base


def test_op8(spark, docs):
    want = brute.near(docs, 3, 85)
    got = rows(spark, 8)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and any(not r.kept for r in got)


def test_op1_finds_whole_passages(spark, docs):
    """Every document that holds a whole item, and no document without its words."""
    import re
    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    items = {r.item_id: norm(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    texts = {i: norm(t) for i, t in docs}
    whole = {(i, k) for i, t in texts.items() for k, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id): r.score for r in rows(spark, 1)}
    assert whole and whole <= set(got) and all(got[p] == 1.0 for p in whole)
    for (i, k) in set(got) - whole:
        w = items[k].split()
        assert sum(x in set(texts[i].split()) for x in w) >= 0.5 * len(w)


def test_op7(spark):
    from presswork.llm import embdup
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 64))
    x[100:400] = x[0] + 0.09 * rng.standard_normal((300, 64)) * rng.random((300, 1))
    x[400:420] = x[1]
    x[420:440] = 3 * x[2]
    label = (np.arange(600) % 7 == 0).astype(int)
    table = spark.createDataFrame([(i, [float(v) for v in x[i]], int(label[i])) for i in range(600)], "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(links, False)
    comp = brute.components(range(600), zip(*(a.tolist() for a in np.nonzero(np.triu(links)))))
    for s in (embdup.Settings(), embdup.Settings(block=64)):
        got = {r.vec_id: (r.n_links, r.component_id) for r in embdup.near_duplicates(table, s).collect()}
        assert got == {i: (int(links[i].sum()), comp[i]) for i in range(600)}


def test_pipeline(spark):
    """Each stage against plain rules on its own input."""
    import corpus_pipeline as C
    before = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in C.STAGES:
        after = stage(spark, before, SF)
        a, b = {r.doc_id: r for r in before.collect()}, after.collect()
        pairs = [(i, r.text) for i, r in a.items()]
        if name == "toxicity":
            truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert sum(truth.get(r.doc_id) == 1 for r in b) <= 0.5 * sum(truth.get(i) == 1 for i in a)
            clean = sum(truth.get(i) == 0 for i in a)
            assert sum(truth.get(r.doc_id) == 0 for r in b) >= 0.95 * clean
        elif name == "near_duplicates":
            assert {r.doc_id for r in b} == {i for i, (_, c) in brute.near(pairs, 5, 80).items() if c == i}
        elif name == "substring_dedup":
            want = brute.repeats(pairs)
            assert len(b) == len(a)
            for r in b:
                assert r.text == a[r.doc_id].text if not want[r.doc_id][1] else len(brute.words(r.text)) == want[r.doc_id][0] - want[r.doc_id][1]
        elif name == "decontamination":
            assert 0.9 * len(a) < len(b) <= len(a)
        if name != "packing":
            assert after.columns == before.columns and after.dtypes == before.dtypes
            before = spark.createDataFrame(b, before.schema)
        else:
            assert {r.doc_id for r in b} == set(a)
