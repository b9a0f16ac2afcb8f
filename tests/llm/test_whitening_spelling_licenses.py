"""op11, op12 and op13 against plain versions, and their stated results for odd rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.llm import licenses, spelling, whitening
from presswork.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def query(spark, n, sf=SF):
    return QUERIES[next(k for k in QUERIES if k.startswith(f"op{n}_"))](spark, sf).collect()


def plain_whitening(rows, top=32):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    t = n * x - sums
    c = (t / n).astype(float)
    cov = c.T @ c / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(top, int((values > 1e-12 * values.sum()).sum()))
    return n, [int(sum(y * y for y in r)) for r in t], c @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / np.trace(cov)


def held_against(got, rows, top=32):
    n, deviation, white, explained = plain_whitening(rows, top)
    assert len(got) == white.size
    by = {}
    for r in got:
        by.setdefault(r.component, {})[r.vec_id] = r
    for j in range(white.shape[1]):
        mine = np.array([by[j + 1][i].whitened for i, _ in rows])
        sign = np.sign(mine @ white[:, j])
        assert np.allclose(mine * sign, white[:, j], atol=1e-8)
        one = by[j + 1][rows[0][0]]
        assert one.n == n and one.explained == pytest.approx(explained[j], rel=1e-9) and one.identity_error < 1e-9
        assert [int(by[j + 1][i].deviation) for i, _ in rows] == deviation


def test_op11(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding]
    held_against(query(spark, 11), rows)


def test_whitening_stops_early_and_meets_used_up_spaces(spark):
    rng = np.random.default_rng(2)
    wide = rng.standard_normal((200, 120)) * np.geomspace(50, 1e-3, 120)
    flat = np.zeros((40, 12))
    flat[:, :3] = rng.standard_normal((40, 3)) * 20
    for x, top in ((wide, 4), (flat, 12), (np.vstack([flat, flat]), 2)):
        rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        held_against(whitening.whiten(df, whitening.Settings(top=top)).collect(), rows, top)
    blocks, d, n, sums = whitening.prepare(spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(wide)], "vec_id long, embedding array<double>"), "vec_id", "embedding", whitening.Settings())
    model = whitening.fit(blocks, d, n, sums, whitening.Settings(top=2, tol=1e-12))
    assert model.steps < 100 and model.residual <= 1e-12 * model.alpha[0] * 100
    with pytest.raises(RuntimeError):
        whitening.fit(blocks, d, n, sums, whitening.Settings(top=8, steps=9))


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [3.0, -1.0]), (2, [3.0, -1.0]), (None, [0.5, 0.25]), (4, None), (5, []), (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, -inf]), (9, [1.0]), (10, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "vector", "n", "component", "x")})
    got = whitening.whiten(df).collect()
    assert Counter(r.vec_id for r in got) == {1: 2, 2: 4, None: 2} and {r.n for r in got} == {4}
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id = 1")).count() == 0
    assert whitening.whiten(df.where("vec_id = 2")).count() == 0
    far = [(0, [4.0e9, 0.0]), (1, [-4.0e9, 1.0]), (2, [1.0, 5.0])]
    got = whitening.whiten(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect()
    _, deviation, _, _ = plain_whitening(far)
    assert {(r.vec_id, int(r.deviation)) for r in got} == set(enumerate(deviation)) and max(deviation) > 1 << 63


def plain_spelling(docs, drop_of=31, least=7):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_of and h % drop_of == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    letters = sorted({x for w in n for x in w})
    out = {}
    for w in n:
        some = {w[:i] + w[i + 1:] for i in range(len(w))}
        some |= {w[:i] + x + w[i + 1:] for i in range(len(w)) for x in letters} | {w[:i] + x + w[i:] for i in range(len(w) + 1) for x in letters}
        near = sorted((-n[v], v) for v in some if v in n and v != w)
        form = near[0][1] if near and -near[0][0] >= 10 * n[w] else None
        out[w] = (form, n[w], len(near), n[form] if form else None)
    roots = {}
    for w in out:
        at = w
        while out[at][0]:
            at = out[at][0]
        roots[w] = at
    return {w: (f, roots[w], c, k, g) for w, (f, c, k, g) in out.items()}


def test_op12(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        got = query(spark, 12, sf)
        want = plain_spelling(docs)
        assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(got) == len(want)
    assert sum(v[0] is not None for v in want.values()) > 20 and sum(v[3] > 1 for v in want.values()) > 20


def test_spelling_edges(spark):
    def times(w, k):
        return [w] * k
    text = " ".join(times("abcdefgh", 2500) + times("abcdefgx", 250) + times("abcdefgxy", 25) + times("abcdefxy", 2) + times("Straße", 9) + times("ÉCOLESDÉ", 3) + times("zzzzzzz", 2) + times("zzzzzzzz", 20) + ["once"])
    rows = [(1, text), (2, None), (3, ""), (None, "qwertyu1qwertyu QWERTYU"), (4, "x" * 300 + " " + "x" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("word", "n", "key", "root", "id", "run", "h")})
    for q in (1, 4, 9):
        got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df, spelling.Settings(symbols=q)).collect()}
        assert got == plain_spelling(rows, None)
        assert got["abcdefxy"][1] == "abcdefgh" and got["zzzzzzz"][:2] == ("zzzzzzzz", "zzzzzzzz") and got["qwertyu"][2] == 3 and got["x" * 300][2] == 2
    long = spark.createDataFrame([(1, "xy" * 20_000 + " " + "xy" * 20_000 + " y" + "xy" * 20_000), (2, "y" + "xy" * 20_000)], "doc_id long, text string")
    assert {(len(r.word), r.n, r.n_near) for r in spelling.variants(long).collect()} == {(40_000, 2, 1), (40_001, 2, 1)}
    assert spelling.variants(df.limit(0)).count() == 0 and spelling.variants(df.where("doc_id = 2")).count() == 0


def test_reduced_neighbourhoods():
    rng = np.random.default_rng(4)
    def key(r):
        return int(spelling.keys(np.array([r]))[0]) if len(r) else 0
    for n in (1, 2, 5, 40):
        sym = rng.integers(1, 4, (3, n))
        for row, got in zip(sym, spelling.neighbours(sym, 3)):
            r = row.tolist()
            want = {key(r)} | {key(r[:i] + [c] + r[i + 1:]) for i in range(n) for c in (1, 2, 3)} | {key(r[:i] + [c] + r[i:]) for i in range(n + 1) for c in (1, 2, 3)}
            want |= {key(r[:i] + r[i + 1:]) for i in range(n)} if n > 1 else set()
            assert set(got.tolist()) == want


def plain_licenses(docs, s=licenses.Settings()):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    out = []
    for i, t in docs:
        w = word.findall((t or "").translate(brute.LOWER))
        base, starts, score, more = set(), [], 0.0, set()
        for label, phrase in s.phrases:
            p = phrase.split()
            at = [j for j in range(len(w) - len(p) + 1) if w[j:j + len(p)] == p]
            starts += at
            base |= {label} if at else set()
        for given, phrase in ((s.phrases, True), (s.notices, False)):
            for label, text in given:
                p = word.findall(text.translate(brute.LOWER))
                votes = {}
                for t_ in range(len(p) - s.k + 1):
                    for j in range(len(w) - s.k + 1):
                        if w[j:j + s.k] == p[t_:t_ + s.k]:
                            votes.setdefault(j - t_, set()).add(t_)
                groups, last = [], None
                for d in sorted(votes):
                    if phrase or last is None or d - last > s.slack:
                        groups.append(set())
                    groups[-1] |= votes[d]
                    last = d
                for g in groups:
                    share = len(g) / (len(p) - s.k + 1)
                    score = max(score, share)
                    if not phrase and share >= s.least:
                        more.add(label)
        out.append((i, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), score))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def test_op13(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = query(spark, 13)
    want = plain_licenses(docs)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert sum(r.n_base for r in got) > 0 and any(r.labels and not r.base_labels for r in got)


def test_license_spans(spark):
    mit = licenses.NOTICES[0][1].split()
    rng = np.random.default_rng(9)
    rows = [(1, " ".join(mit)), (2, "noise " * 9 + " ".join(mit[:10] + ["indeed"] + mit[10:20] + mit[21:])), (3, " ".join(mit[:12])),
            (4, "Under  the\tMIT\nlicense, under the mit LICENSE; cc-by-nc cc by nc by nc"), (5, None), (6, ""), (7, "mit license"),
            (8, "under the mit license " * 3000 + "café " * 20_000), (None, "CC BY-NC"), (9, "all rights reserved"), (9, "Apache License - Version 2"), (9, "Apache License - Version 2")]
    rows += [(100 + i, " ".join(w for w in mit if rng.random() > 0.02 * i)) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("doc", "digest", "words", "label", "t", "d", "hash", "spans", "n_base")})
    got = licenses.scan(df).collect()
    plain = sorted((tuple(r)[:8] for r in got), key=key)
    assert plain == sorted(plain_licenses(rows), key=key)
    by = {r.doc_id: r for r in got}
    assert by[2].labels == "mit" and by[2].base_labels == "" and by[2].spans[0].first == 9 and by[2].score > 0.8
    assert by[3].labels == "" and 0 < by[3].score < 0.6 and by[8].n_base == 3000 and by[8].last_word == 4 * 2999
    assert by[None].base_labels == "cc-by-nc" and by[5].score == 0 and by[5].labels == ""
    assert licenses.scan(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        licenses.templates(spark, licenses.Settings(phrases=(("x", "two words"),)))
    with pytest.raises(ValueError):
        licenses.templates(spark, licenses.Settings(max_windows=10))
