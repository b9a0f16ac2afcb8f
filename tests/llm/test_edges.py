"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
columns: every operator and stage gives its stated result."""

from __future__ import annotations

import hashlib
import math
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presswork.llm import bytesops as B
from presswork.llm import components, decontam, embdup, minhash, packing, quality, substring, suffixlm, toxicity, urlrules, warc
from presswork.llm.common import cut_lineage, fold, load
from presswork.session import checkpoint_dir

PASSAGE = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(f"z{i % 977}" for i in range(30_000))
DOCS = [
    (1, "head of one " + PASSAGE + " tail of one", "en", "a", 1),
    (2, "other start " + PASSAGE + " other end", "en", "a", 2),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \t\n ", "en", "a", 3),
    (6, "one", "en", "a", 3),
    (7, LONG, "en", "a", len(LONG)),
    (8, "same text of a copy with seven words", "en", "a", 9),
    (9, "same text of a copy with seven words", "en", "a", 9),
    (9, "same text of a copy with seven words", "en", "a", 9),
    (None, "head of one " + PASSAGE + " tail of one", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns have the names that the operators use themselves."""
    df = spark.createDataFrame(DOCS, SCHEMA)
    extra = {c: F.lit(f"mine {c}") for c in ("score", "kept", "n_words", "part", "answers", "rep", "component_id", "k", "slots", "x", "c0", "block", "gone", "toxicity_score")}
    return df.withColumns(extra)


def empty(df):
    return df.limit(0)


def test_repeats(docs):
    got = {}
    for r in substring.remove_repeats(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(sum(got.values(), [])) == len(DOCS)
    assert (got[1][0].n_words, got[1][0].n_removed) == (66, 0)
    assert (got[2][0].n_removed, got[2][0].kept) == (60, "other start other end") and [tuple(x) for x in got[2][0].removed] == [(2, 62)]
    assert got[2][0].part == "mine part" and got[2][0].kept != "mine kept"
    assert [(got[i][0].n_words, got[i][0].n_removed, got[i][0].kept) for i in (3, 4, 5, 6)] == [(0, 0, ""), (0, 0, ""), (0, 0, ""), (1, 0, "one")]
    assert (got[None][0].n_words, got[None][0].n_removed) == (66, 0)
    # a text's own repeats are not another document's
    assert got[7][0].n_removed == 0 and len(got[9]) == 2
    assert substring.remove_repeats(empty(docs)).count() == 0


def test_repeats_need_a_whole_block():
    with pytest.raises(ValueError):
        substring.Settings(window=40, block=25)


def test_repeats_of_any_length(spark):
    import brute
    rng = np.random.default_rng(5)
    base = [f"v{x}" for x in rng.integers(0, 40, 400)]
    rows = []
    for i in range(120):
        a, n = rng.integers(0, 330), rng.integers(20, 70)
        w = [f"u{x}" for x in rng.integers(0, 9, rng.integers(0, 40))] + base[a:a + n] + ["the"] * int(rng.integers(0, 70)) + base[a + n:a + n + 30]
        rows.append((int(rng.integers(0, 10**12)) if i % 2 else -i, " ".join(w)))
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), parts=5).collect()
    want = brute.repeats(rows)
    assert {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got} == want
    assert sum(r.n_removed for r in got) > 500


def test_near(docs):
    got = {}
    for r in minhash.near_duplicates(docs).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.class_id, r.component_id))
    assert got[3] == [(0, 3, 3)] and got[4] == [(0, 4, 4)] and got[5] == [(0, 5, 5)] and got[6] == [(1, 6, 6)]
    assert got[8] == [(4, 8, 8)] and got[9] == [(4, 8, 8)] * 2
    assert got[None][0][1:] == (None, None) and got[7][0][2] == 7
    assert minhash.near_duplicates(empty(docs)).count() == 0


def test_near_groups_that_are_not_near_enough(spark):
    """A star of copies around one text: some near, some just too far, and
    copies of a far one that only link to each other."""
    import brute
    rng = np.random.default_rng(11)
    base = [f"b{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        w = list(base)
        for at in rng.choice(150, int(rng.integers(1, 14)), replace=False):
            w[at] = f"e{i}x{at}"
        rows.append((i, " ".join(w)))
        if i % 10 == 0:
            w[3] = "again"
            rows.append((1000 + i, " ".join(w)))
    s = minhash.Settings(shingle=3, percent=85, bands=24)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), s).collect()}
    assert got == brute.near(rows, 3, 85)


def test_near_plans_stay_small(spark, monkeypatch):
    """Each plan of the rounds and of the second round's pairs reads few tables:
    the driver keeps, compiles and logs every plan."""
    leaves = []

    def cut(df):
        plan = df._jdf.queryExecution().optimizedPlan()
        leaves.append(plan.collectLeaves().size())
        return cut_lineage(df)

    monkeypatch.setattr(components, "cut_lineage", cut)
    chain = spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")
    assert {tuple(r) for r in components.connected(chain).collect()} == {(i, 0) for i in range(10)}
    # one star: its edges in both directions in the least neighbour and where it is met
    assert max(leaves) <= 8, leaves
    monkeypatch.setattr(minhash, "cut_lineage", cut)
    leaves.clear()
    words = [f"a{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "x"])), (3, " ".join(["y", *words[1:-1], "z"]))]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1}
    assert max(leaves) <= 10, leaves


def test_packing(docs):
    got = packing.pack_documents(docs).collect()
    assert sum(r.doc_id == 9 for r in got) == 2 and [(r.length, r.piece) for r in got if r.doc_id in (3, 4, 5)] == [(1, 0)] * 3
    long = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 7)
    assert all(n == 2048 and a == 2048 * p for p, a, n in long[:-1]) and len(long) > 10
    assert any(r.doc_id is None for r in got) and packing.pack_documents(empty(docs)).count() == 0
    bins, offset = packing.best_two_fit(np.array([6, 5, 5, 4]), 10)
    assert bins.max() == 1
    # the smallest document of a bin gives way to two that fill it
    bins, _ = packing.best_two_fit(np.array([7, 2, 2, 2, 1]), 10)
    assert len(set(bins.tolist())) == 2


def test_words_that_need_the_whole_tokenizer():
    from tokenizers import Tokenizer

    from presswork.llm import bytesops as B
    import pyarrow as pa
    path = packing.tokenizer_path()
    whole, tok = Tokenizer.from_file(path), packing.WordTokens(path, 50)
    texts = ["a'b 'S don't I'LL x1234 \u00c9\u00df \u1e9e <|endoftext|>b \uff10 x\u00b2\u00bd  e\u0301 \u0130x \u00d7\u00aa \u4e2d\u6587", "", "  ", "a<|startoftext|>", "x" * 500] * 2
    ids, offs = tok.texts(*B.text_buffers(pa.array(texts)))
    for i, t in enumerate(texts):
        assert list(ids[offs[i]:offs[i + 1]]) == [*whole.encode(t, add_special_tokens=False).ids, 0]


def labelled(spark):
    return spark.createDataFrame([(1, 1, 1), (1, 0, 0), (2, 0, 0), (8, 1, 0), (None, 1, 1), (7, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")


def test_classifiers(spark, docs):
    for labels in (labelled(spark), empty(labelled(spark)), labelled(spark).where("toxic = 1")):
        model = toxicity.fit(docs, labels)
        got = toxicity.score(docs, model).collect()
        assert len(got) == len(DOCS) and all(0 <= r.score <= 1 for r in got) and got[0].kept == "mine kept"
        got = quality.rank_quality(docs, labels).collect()
        assert len(got) == len(DOCS) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (8, 9)}) == 1 and len({r.score for r in got if r.doc_id in (3, 4)}) == 1
    assert toxicity.score(empty(docs), toxicity.fit(empty(docs), labelled(spark))).count() == 0
    assert quality.rank_quality(empty(docs), labelled(spark)).count() == 0
    assert toxicity.fit(docs, empty(labelled(spark))).bias == 0.0


def toxic_table(spark, n=1500):
    """Texts of 30 common words, about one in ten labelled toxic; most toxic
    texts and a few clean ones have words of their own."""
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.1)
        w = [f"plain{x}" for x in rng.integers(0, 90, 30)]
        for word, chance in (("grolk", 0.5), ("zubbit", 0.4), ("vexnar", 0.3)):
            if rng.random() < (chance if toxic else 0.06):
                w[int(rng.integers(0, 30))] = word
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_with_and_without_the_cap(spark):
    """The cap on labelled rows does not move the scores: as many are over the cut."""
    docs, labels = toxic_table(spark)
    whole, capped = (toxicity.fit(docs, labels, toxicity.Settings(max_rows=n)) for n in (5000, 150))
    a, b = ({r.doc_id: r.score for r in toxicity.score(docs, m).collect()} for m in (whole, capped))
    assert abs(whole.bias - capped.bias) < 0.7
    assert sum((a[i] >= 0.5) != (b[i] >= 0.5) for i in a) <= 0.02 * len(a)
    assert sum(b.values()) == pytest.approx(sum(r.toxic for r in labels.collect()), rel=0.2)


def test_toxicity_learns_once_from_a_repeated_id(spark):
    docs, labels = toxic_table(spark, 300)
    again = docs.unionByName(docs.where("doc_id < 20").crossJoin(spark.range(30)).select("doc_id", "text"))
    texts, size = toxicity.training_rows(again, labels)
    assert texts.count() == 300 == sum(size.values())


def test_toxicity_keeps_every_significant_slot(spark):
    """Many toxic words, each in a few texts: all have weight."""
    rng = np.random.default_rng(6)
    rare = ["".join(chr(97 + int(c)) for c in rng.integers(0, 26, 14)) for _ in range(300)]
    rows = [(i, " ".join(f"plain{x}" for x in rng.integers(0, 90, 9)) + (" " + " ".join(rare[(7 * i + k) % 300] for k in range(11)) if i % 2 else "")) for i in range(1600)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(1600)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert len(model.slots) > 8192
    got = toxicity.score(spark.createDataFrame([(i, " ".join(rare[(i + 29 * k) % 300] for k in range(11))) for i in range(300)], "doc_id long, text string"), model)
    assert min(r.score for r in got.collect()) > 0.5


def test_decontamination(spark, docs):
    item = " ".join(f"w{i}" for i in range(10, 50))
    edited = " ".join(("changed" if i % 7 == 3 else f"W{i},") for i in range(10, 50))
    more = docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(50).cast("long")).withColumn("text", F.lit("before it " + edited + " after it")))
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "words that are nowhere else at all"), (5, "one")], "item_id long, text string")
    got = decontam.contaminated(more, items).collect()
    pairs = {(r.doc_id, r.item_id): r for r in got}
    assert {k for k in pairs if k[1] == 1} == {(1, 1), (2, 1), (50, 1), (None, 1)}
    assert pairs[1, 1].score == 1.0 and (pairs[1, 1].first_word, pairs[1, 1].end_word) == (13, 53)
    assert 0.5 <= pairs[50, 1].score < 1.0 and (6, 5) in pairs and not any(k[1] in (2, 3, 4) for k in pairs)
    assert decontam.contaminated(empty(docs), items).count() == 0 and decontam.contaminated(docs, empty(items)).count() == 0
    # several passes give the same rows
    many = decontam.contaminated(more, items, decontam.Settings(pass_words=20)).collect()
    assert sorted(map(str, many)) == sorted(map(str, got))


def test_decontamination_of_edited_copies(spark):
    """Copies with 10 to 30% of their words changed, beside whole copies of the
    items: every pair that Smith-Waterman finds without seeds, and its score."""
    rng = np.random.default_rng(8)
    known = [f"k{x}" for x in range(400)]
    items = [[known[int(x)] for x in 400 * rng.random(int(n)) ** 2] for n in rng.integers(12, 45, 40)]
    texts = [[known[int(x)] for x in 400 * rng.random(60) ** 2] for _ in range(60)] + [["so", *w, "on"] for w in items[:20]]
    for share in (0.1, 0.2, 0.3):
        for w in items * 3:
            out = []
            for x in w:
                kind = rng.integers(0, 6) if rng.random() < share else 6
                out += [] if kind == 0 else [x, "added"] if kind == 1 else [f"e{rng.integers(0, 99)}"] if kind < 6 else [x]
            lead = [known[int(x)] for x in rng.integers(0, 400, 25)]
            texts.append([*lead, *out, *lead[::-1]])
    number: dict[str, int] = {}
    codes = [np.array([number.setdefault(x, len(number) + 1) for x in w], np.uint64) for w in [*items, *texts]]
    grid = np.zeros((len(texts), max(map(len, texts))), np.uint64)
    for i, w in enumerate(codes[len(items):]):
        grid[i, :len(w)] = w
    want = {}
    for k, w in enumerate(codes[:len(items)]):
        score = decontam.smith_waterman(w, grid)[0] / (2 * len(w))
        want |= {(i, k): float(score[i]) for i in np.flatnonzero(score >= 0.5).tolist()}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(docs, bench).collect()}
    assert len(want) > 350 and got == want
    # all n-grams frequent, or all but absent ones: still found
    got = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(docs, bench, decontam.Settings(common=0.0, least_common=0)).collect()}
    assert len(set(got) & set(want)) > 0.97 * len(want)


def test_decontamination_of_partial_passages(spark):
    item = [f"p{i}" for i in range(59)]
    rows = [(1, ["a"] * 20 + item[5:34] + ["b"] * 20), (2, ["a"] * 3 + item[40:53] + ["b"]), (3, ["a", *item[40:52], "b"]),
            (4, [x for i in range(20) for x in (item[i], *["c"] * (i % 7 == 6))])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = decontam.contaminated(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert {r.doc_id: (r.first_word, r.end_word) for r in got} == {1: (20, 49), 2: (3, 16)} and all(r.score < 0.5 for r in got)


def test_alignment_against_plain_version():
    rng = np.random.default_rng(2)
    for _ in range(30):
        a, b = rng.integers(1, 5, 12).astype(np.uint64), rng.integers(1, 5, 25).astype(np.uint64)
        h = np.zeros((13, 26), int)
        for i in range(1, 13):
            for j in range(1, 26):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert decontam.smith_waterman(a, b[None, :])[0][0] == h.max()


def test_language_model(spark, docs):
    got = suffixlm.score_texts(docs, F.lit(True)).collect()
    assert len(got) == len(DOCS) and sorted(r.n_tokens for r in got if r.doc_id in (3, 4, 5, 6)) == [1, 1, 1, 2]
    assert len([r for r in got if r.doc_id == 9]) == 2 and len({r.score for r in got if r.doc_id in (8, 9)}) == 1
    none = suffixlm.score_texts(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in none)
    assert suffixlm.score_texts(empty(docs), F.lit(True)).count() == 0


def chain_texts(n, words=200, seed=1):
    """Texts in which some words mostly follow one or two others."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        w = ["start", "start"]
        for _ in range(words):
            nxt = {("a", "b"): "d", ("c", "b"): "e"}.get((w[-2], w[-1])) or {"a": "b", "c": "b"}.get(w[-1])
            w.append(nxt if nxt and rng.random() < 0.8 else "abcdefgh"[rng.integers(0, 8)])
        rows.append((i, " ".join(w[1:])))
    return rows


def plain_tree(texts, s):
    """The tree by dictionaries: counts of runs, states, and one log10
    probability of a token after its context."""
    end, runs = None, Counter()
    for t in texts:
        w = [*(t or "").lower().split(" "), end] if t else [end]
        for k in range(1, s.depth + 2):
            runs.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    words = {g[0]: n for g, n in runs.items() if len(g) == 1}
    total = sum(words.values()) + len(words) + 1
    states = {}

    def prob(context, x):
        if not context:
            return (words.get(x, 0) + 1) / total
        up = prob(context[1:], x)
        if context not in states:
            return up
        stored, rest = states[context]
        return stored[x] if x in stored else rest * up

    for k in range(1, s.depth + 1):
        after = {}
        for g, n in runs.items():
            if len(g) == k + 1 and n >= s.least_next and runs[g[:-1]] >= s.least_count:
                after.setdefault(g[:-1], {})[g[-1]] = n
        found = {}
        for c, seen in after.items():
            n, up = runs[c], {x: prob(c[1:], x) for x in seen}
            left, above = n - sum(seen.values()), 1 - sum(up.values())
            ratio = sum(m * math.log(m / (n * up[x])) for x, m in seen.items()) + (left * math.log(left / (n * above)) if left else 0)
            if ratio > len(seen) * math.log(n) + s.strength:
                stored = {x: (m - s.discount) / n for x, m in seen.items()}
                found[c] = stored, (1 - sum(stored.values())) / above
        states.update(found)
    return states, prob, list(words)


@pytest.mark.parametrize("cache", [0.02, 2.0])
def test_language_model_against_plain_tree(spark, cache):
    """Every score, whatever part of the tree is broadcast, and every state's
    probabilities over the words, the end and one unknown word sum to one."""
    rows, s = chain_texts(40), suffixlm.Settings(cache=cache)
    states, prob, words = plain_tree([t for _, t in rows], s)
    assert {len(c) for c in states} == {1, 2}
    for c in states:
        assert sum(prob(c, x) for x in [*words, "never"]) == pytest.approx(1.0)
    more = [(1000, "a b d a b never c b"), (1001, ""), (1002, "c b e"), (1003, "never seen"), (1004, None), (1005, "A B D")]
    df = spark.createDataFrame(rows + more, "doc_id long, text string")
    for r in suffixlm.score_texts(df, F.col("doc_id") < 1000, s).collect():
        t = dict(rows + more)[r.doc_id]
        w = [*t.lower().split(" "), None] if t else [None]
        assert r.score == pytest.approx(sum(math.log10(prob(tuple(w[max(0, i - 2):i]), x)) for i, x in enumerate(w)), rel=1e-9)
    model = suffixlm.learn(df.select("doc_id", (F.col("doc_id") < 1000).alias("teach"), "text"), s, 3)
    assert [x.count() for x in model.states] == [sum(len(c) == k for c in states) for k in (1, 2)]


def test_language_model_grows_with_the_corpus(spark):
    """Ten times the texts: more states, and a better score of texts not seen."""
    rng = np.random.default_rng(5)
    names = [f"w{i}" for i in range(400)]
    follow = {w: names[rng.integers(0, 400)] for w in names}

    def texts(n, first):
        for i in range(n):
            w = [names[rng.integers(0, 400)]]
            while len(w) < 100:
                w.append(follow[w[-1]] if rng.random() < 0.5 else names[rng.integers(0, 400)])
            yield first + i, " ".join(w)

    teach, held = list(texts(300, 0)), list(texts(20, 5000))
    seen = []
    for n in (30, 300):
        df = spark.createDataFrame(teach[:n] + held, "doc_id long, text string")
        model = suffixlm.learn(df.select("doc_id", (F.col("doc_id") < 5000).alias("teach"), "text"), suffixlm.Settings(), 3)
        got = suffixlm.score_texts(df, F.col("doc_id") < 5000).where("doc_id >= 5000").agg(F.sum("score")).first()[0]
        seen.append((sum(x.count() for x in model.states), got))
    assert seen[1][0] > 2 * seen[0][0] and seen[1][1] > seen[0][1]


def test_sieve_grows_with_its_table(spark):
    """32 bits a row up to the most; every hash of the table may be in it."""
    for n, most, bits in ((0, 20, 12), (1000, 20, 15), (50_000, 20, 20)):
        table = spark.range(n).select(F.xxhash64("id").alias("hash"))
        sieve = suffixlm._sieve(table, most)
        assert len(sieve) * 64 == 1 << bits
        h = table.toArrow().column("hash").to_numpy().astype(np.int64).view(np.uint64)
        assert suffixlm._may_be(sieve, h).all()
        other = spark.range(10_000).select(F.xxhash64(F.col("id") + 1_000_000).alias("hash")).toArrow().column("hash").to_numpy().view(np.uint64)
        assert suffixlm._may_be(sieve, other).mean() < 1.2 * n / (1 << bits) + 1e-9


def test_language_model_holds_little_at_once(spark, monkeypatch):
    """Chunks, tables of powers and Arrow batches are small, whatever the texts."""
    sizes, real = [], suffixlm.Tokens

    class Spy(real):
        def __init__(self, data, offs):
            sizes.append(len(data))
            super().__init__(data, offs)

    texts = pa.array([" ".join(f"w{i % 211}" for i in range(j, j + 4000)) for j in range(200)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array([True] * 200), texts], names=["doc_id", "teach", "text"])
    none = np.zeros(0, np.uint64)
    near = suffixlm._Near(2, 1.0, np.zeros(64, np.uint64), none, np.zeros(0, np.int64), np.zeros(0))
    monkeypatch.setattr(suffixlm, "Tokens", Spy)
    monkeypatch.setattr(B, "_powers", {})
    assert sum(len(b.column(4)[0].as_py()) for b in suffixlm._scored([batch], near, 3)) == 200 * suffixlm._STATIC.itemsize
    assert sum(len(t.hash) for t in suffixlm._taught([batch])) == 200 * 4001
    assert texts.nbytes > 3 << 20 and max(sizes) <= 1 << 20 and sum(sizes) > 2 * (3 << 20)
    assert max(len(x) for x, _ in B._powers.values()) <= (1 << 20) + 1
    suffixlm.score_texts(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(True)).collect()
    assert spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() <= 4 << 20


def test_language_model_in_passes(spark, monkeypatch):
    """A pass shuffles part of the contexts or texts, all passes together each
    of them once, and tables that nothing reads any more are gone."""
    made, real = [], suffixlm._written

    def spy(df, name, *more):
        out = real(df, name, *more)
        keys = [(r.context, r.suffix) for r in out.collect()] if name == "suffix-cells" else []
        made.append((name, out.count(), keys, out.inputFiles()[0].split("/")[-2]))
        return out

    monkeypatch.setattr(suffixlm, "_written", spy)
    s = suffixlm.Settings()
    df = spark.createDataFrame([*chain_texts(60), (3, None), (None, "a b d"), (7, "c b e")], "doc_id long, text string")
    assert suffixlm.score_texts(df, F.col("doc_id") < 1000, s).count() == 63
    cells = [keys for name, _, keys, _ in made if name == "suffix-cells"]
    assert len(cells) == s.depth * s.shares and s.shares > 1
    for k in range(s.depth):
        some = cells[k * s.shares:(k + 1) * s.shares]
        every = [x for keys in some for x in keys]
        assert len(set(every)) == len(every) > 0 and all(len(keys) < 0.8 * len(every) for keys in some)
    texts = [n for name, n, _, _ in made if name == "suffix-scores"]
    assert len(texts) == s.slices and sum(texts) == 63 and all(0 < n < 40 for n in texts)
    left = os.listdir(checkpoint_dir(spark).removeprefix("file://"))
    for name, _, _, at in made:
        assert (at in left) == (name in ("suffix-states", "suffix-table", "suffix-scores"))


def test_models_come_to_the_driver_as_arrow(spark, monkeypatch):
    """Rows as Python objects take many times the memory of their columns."""
    def refuse(self):
        raise AssertionError("rows collected as objects")

    monkeypatch.setattr(type(spark.range(1)), "toPandas", refuse)
    texts = [(i, ("vile filth " if i % 2 else "kind words ") * 3 + f"number {i}") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert len(toxicity.fit(docs, labels).slots)
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))], "item_id long, text string")
    bench = docs.unionByName(spark.createDataFrame([(900, "so " + " ".join(f"w{i}" for i in range(30)))], "doc_id long, text string"))
    assert [r.doc_id for r in decontam.contaminated(bench, items).collect()] == [900]
    assert suffixlm.score_texts(docs, F.col("doc_id") < 50).count() == 60


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, None, 1), (8, [None, 1.0], 1),
            (9, [1.0, 0.0], None), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0], 1), (12, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embdup.near_duplicates(df).collect()}
    assert {i: got[i] for i in (1, 2, 12)} == {1: (2, 1), 2: (2, 1), 12: (2, 1)}
    assert all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, None))
    assert len(embdup.near_duplicates(df).collect()) == len(rows) and embdup.near_duplicates(empty(df)).count() == 0


def test_urls(spark):
    rules = spark.createDataFrame([("example.org", "/", "allow"), ("example.org", "/x", "block"), ("example.org", "/x", "allow"), ("www.example.org", "/x/y", "allow"),
                                   ("org", "/x/y/z", "block"), (None, "/", "block"), ("", "/", "block"), ("ORG", None, "allow")], "host string, path string, verdict string")
    urls = ["http://example.org/x/1?q", "HTTP://WWW.Example.ORG/x/y/z#f", "http://badexample.org/x", "http://example.org", "no scheme", None, "://", "a://b://c/d", "http://a.org?x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0]), (None, urls[0])], "page_id long, url string").withColumn("part", F.lit(0))
    rows = urlrules.judge(df, rules, default="none").collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == len(urls) + 2
    assert got[0] == ("example.org", "/x/1", "example.org/x", "block") and got[1] == ("www.example.org", "/x/y/z", "www.example.org/x/y", "allow")
    assert got[2] == ("badexample.org", "/x", "org", "allow") and got[3] == ("example.org", "", "org", "allow")
    assert got[4] == got[5] == ("", "", None, "none") and got[6] == ("", "", None, "none") and got[7][:2] == ("b:", "//c/d") and got[8][0] == "a.org"
    assert urlrules.judge(empty(df), rules).count() == 0
    assert {r.verdict for r in urlrules.judge(df, empty(rules)).collect()} == {"allow"}


def test_archives(spark, tmp_path):
    big = "<p>" + "x" * 200
    rows = [(5, "http://a/ b\n", big), (2, None, big), (3, "", None), (4, "http://c", "short"), (6, "http://d", "short"), (7, "http://e", "\r\n\r\nWARC/1.1\r\n" + big), (5, "http://a/ b\n", big), (None, "http://n", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("p"))
    for version in (1, 2):
        got = {}
        for r in warc.archive_pages(df, version, str(tmp_path / f"v{version}")).collect():
            got.setdefault(r.page_id, []).append((r.payload_bytes, r.payload_digest, r.record_type, r.refers_to))
        digest = hashlib.sha256(big.encode()).hexdigest()
        assert got[2] == [(203, digest, "response", None)] and got[5] == [(203, digest, "revisit", 2)] * 2 and got[None] == [(203, digest, "revisit", 2)]
        assert got[3] == [(0, hashlib.sha256(b"").hexdigest(), "response", None)] and got[4][0][2] == got[6][0][2] == "response" and got[7][0][0] == 217
    assert warc.archive_pages(empty(df), 1, str(tmp_path / "none")).count() == 0


def test_archives_are_cut_by_bytes(spark, tmp_path, monkeypatch):
    assert list(warc._runs(np.array([5, 5, 5, 99, 1, 1]), 400, 10)) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert list(warc._runs(np.array([0, 0, 0]), 2, 10)) == [(0, 2), (2, 3)] and list(warc._runs(np.zeros(0, int), 2, 10)) == []
    df = spark.createDataFrame([(i, f"http://x/{i}", "y" * (9000 if i % 3 == 0 else 50)) for i in range(30)], "page_id long, url string, html string").coalesce(1)
    assert warc.pages_to_arc(df, most_bytes=10_000).count() > 8 and warc.pages_to_arc(df).count() == 1
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    monkeypatch.setattr(warc, "LARGE", 1000)
    got = warc.archive_pages(df, path=str(tmp_path / "w")).collect()
    # two large pages to a file; the small ones and the file description, 20 to a file
    assert len(list((tmp_path / "w").glob("*.gz"))) == 7 and sorted(r.page_id for r in got) == list(range(30))
    assert all(r.payload_bytes == (9000 if r.page_id % 3 == 0 else 50) for r in got)


def test_archive_parsing(spark):
    import gzip
    records = [("http://x/a b", "20240131", "text/html", 200, b"HTTP/1.1 200 OK\r\nA: b\r\n\r\npay\r\n\r\nload\n"), ("dns:x", "2024013123595", "text/dns", 200, b"\xff\x00\n")]
    for version in (1, 2):
        raw = warc.arc_bytes("f.arc", records, version)
        for content in (raw, gzip.compress(raw)):
            got = list(warc.convert("f", content))
            assert [r[3] for r in got] == ["warcinfo", "response", "resource"] and got[0][1] == version
            assert got[1][9] == b"pay\r\n\r\nload\n" and got[1][5] == "2024-01-31T00:00:00Z" and got[2][9] == b"\xff\x00\n" and got[2][5] == "1970-01-01T00:00:00Z"
        assert [r[3] for r in warc.convert("f", raw[:-8])][-1] == "malformed"
        assert [r[3] for r in warc.convert("f", raw + b"one two\n")][-1] == "malformed"
    assert [r[3] for r in warc.convert("f", b"")] == ["malformed"] and [r[3] for r in warc.convert("f", b"junk\n")] == ["malformed"]


def test_stages(spark, docs):
    import corpus_pipeline as C
    sf = "/root/testdata/sf0.001"
    for name, stage in C.STAGES[1:]:
        got = stage(spark, docs, sf)
        if name != "packing":
            assert got.columns == docs.columns
        ids = sorted(r.doc_id or 0 for r in got.collect())
        assert set(ids) >= {0, 1, 2, 3, 4, 5, 6, 7, 8} - ({2} if name == "near_duplicates" else set())
        assert stage(spark, empty(docs), sf).count() == 0
    assert C.STAGES[0][1](spark, docs, sf).columns == docs.columns


def test_toxicity_stage_without_two_classes(spark, docs, tmp_path):
    import corpus_pipeline as C
    for name, labels in (("none", empty(labelled(spark))), ("toxic", labelled(spark).where("toxic = 1")), ("clean", labelled(spark).where("toxic = 0"))):
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
        assert C.drop_toxic(spark, docs, str(tmp_path / name)).count() == len(DOCS)


def test_folds(spark):
    import brute
    got = spark.range(50).select(F.col("id"), fold("id", 7).alias("f")).collect()
    assert all(r.f == brute.fold(r.id, 7) for r in got) and load(spark, "/root/testdata/sf0.001", "labels").count() > 0


def test_quality_learns_from_every_label(spark):
    """Rows whose labels lie outside any bounded choice move mean, threshold and
    weights: the fit by blocks is that of one block of all rows."""
    docs = spark.createDataFrame([(i, " ".join(["word", "||", "alpha"][(i + j) % 3] * (1 + i % 5) for j in range(3 + i % 17)) + "!?" * (i % 4)) for i in range(400)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.pmod("doc_id", F.lit(7)) < 2).cast("int").alias("quality"))
    table = quality.feature_table(docs)
    whole, parted = (quality.fit(table, labels, quality.Settings(block=b, least=16)) for b in (6000, 40))
    x = quality.features(pa.array([r.text for r in docs.orderBy("doc_id").collect()]))
    assert np.allclose(whole.mean, x.mean(0)) and np.allclose(parted.mean, x.mean(0)) and np.allclose(parted.scale, x.std(0) + 1e-9)
    for m in (whole, parted):  # half-way between the scores at the worse labels' share
        raw = np.sort(m.raw(x))
        n0 = sum(i % 7 >= 2 for i in range(400))
        assert abs(m.threshold - (raw[n0 - 1] + raw[n0]) / 2) < 1e-9
    y = np.array([i % 7 < 2 for i in range(400)])

    def ordered(m):
        return (m.raw(x)[y][:, None] > m.raw(x)[~y][None]).mean()
    assert abs(ordered(whole) - ordered(parted)) < 0.1
