"""Serving queries on small stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from presswork.operators import serving as W
from presswork.sources.sinks import write_partitions

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_v2_overview(spark):
    kw = spark.createDataFrame([(D1, "FIX_1", "b"), (D1, "FIX_0", "a"), (D1, "FIX_10", "c"), (D1, "MIX_0", "a&b")], "date date, type_id string, value string")
    days = spark.createDataFrame([(D1,), (D2,)], "date date")
    got = {r.date: (r.fix, r.day, r.mix, r.missing) for r in W.day_overview(days, kw).collect()}
    assert got == {D1: (["a", "b", "c"], [], ["a&b"], False), D2: ([], [], [], True)}


def test_v3_cloud(spark):
    rows = [(D1, f"w{i:02}", i) for i in range(25)] + [(D1, None, 99), (D1, "x", None)]
    got = W.cloud_freq(spark.createDataFrame(rows, "date date, value string, cnt long"))
    assert sorted((r.cnt for r in got.collect()), reverse=True) == list(range(24, 4, -1)) and dict(got.dtypes)["cnt"] == "int"


def stored(spark, tmp_path):
    clusters = [(D1, f"{c}_{n}", c, n, 10 * n, f"t{n}") for c in ("a&b", "a&bc", "x&y") for n in range(3)] + [(D2, "a&b_0", "a&b", 0, 7, "other day")]
    c = spark.createDataFrame(clusters, "date date, row_key string, combo string, n int, id long, title string")
    a = spark.createDataFrame([(D1, "a", 5, "five"), (D1, "a", 3, "three"), (D1, "b", 1, "one"), (D2, "a", 9, "nine")], "date date, keyword string, id long, title string")
    write_partitions(c, str(tmp_path / "c"), sort=["row_key"])
    write_partitions(a, str(tmp_path / "a"), sort=["keyword"])
    return spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "c"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_v5_v6_detail_by_branch_and_prefix(spark, tmp_path):
    articles, clusters = stored(spark, tmp_path)
    assert [(r.pos, r.id) for r in W.keyword_detail(articles, clusters, D1, "a").orderBy("pos").collect()] == [(0, 3), (1, 5)]
    got = W.keyword_detail(articles, clusters, D1, "a&b")
    assert sorted((r.kind, r.pos, r.id) for r in got.collect()) == [("cluster", 0, 0), ("cluster", 1, 10), ("cluster", 2, 20)]
    assert W.by_prefix(clusters, D1, "a&b", exact=False).count() == 6 and W.by_prefix(clusters, D1, "a&b").count() == 3
    # the prefix and the date reach the files, and the other table is not read
    text = plan(got)
    assert "StringStartsWith(row_key,a&b_)" in text and "PartitionFilters: [isnotnull(date" in text and "keyword#" not in text.split("FileScan")[1].split("PushedFilters")[0]
    asked = spark.createDataFrame([(D1, "a"), (D1, "a&b"), (D1, "none"), (D2, "a&b"), (D1, "a")], "date date, value string")
    got = {(r.date, r.keyword, r.kind, r.pos, r.id) for r in W.keyword_details(articles, clusters, asked).collect()}
    assert got == {(D1, "a", "article", 0, 3), (D1, "a", "article", 1, 5), (D2, "a&b", "cluster", 0, 7)} | {(D1, "a&b", "cluster", n, 10 * n) for n in range(3)}


def test_v7_golden(spark):
    df = spark.createDataFrame([(D1, "k", "a.^^^b.^^^"), (D1, "e", ""), (D1, "n", None)], "date date, keyword string, summary string")
    assert [(r.pos, r.sentence) for r in W.summary_rows(df).orderBy("pos").collect()] == [(0, "a."), (1, "b.")]


def test_v8_golden_and_clamped(spark):
    df = spark.createDataFrame([(D1, "k", i) for i in range(17)] + [(D1, "l", 0)], "date date, keyword string, id int")
    def page(n):
        return {k: sorted((r.id, r.page, r.pages) for r in W.page(df, F.lit(n), ["id"]).collect() if r.keyword == k) for k in "kl"}
    assert page(3)["k"] == page(99)["k"] == [(16, 3, 3)] and page(99)["l"] == [(0, 1, 1)]
    assert page(-4)["k"] == page(1)["k"] == [(i, 1, 3) for i in range(8)] and len(page(2)["k"]) == 8


def test_v10_four_states(spark):
    kw = spark.createDataFrame([(D1, "ok"), (D1, "none"), (D1, "none")], "date date, value string")
    arts = spark.createDataFrame([(D1, "ok"), (D1, "ok"), (D1, "bare")], "date date, keyword string")
    summ = spark.createDataFrame([(D1, "ok"), (D1, "orphan")], "date date, keyword string")
    got = {r.keyword: (r.articles, r.summaries, r.status) for r in W.keyword_status(kw, arts, summ).collect()}
    assert got == {"ok": (2, 1, "ok"), "bare": (1, 0, "no summary"), "orphan": (0, 1, "no articles"), "none": (0, 0, "nothing")}


def test_shipped_package_imports(tmp_path):
    """As ``session.ship`` sends it: a zip of the files alone, which has no
    namespace packages."""
    import subprocess
    import sys
    import zipfile
    from pathlib import Path

    import presswork

    top, out = Path(presswork.__file__).resolve().parent, tmp_path / "package.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in top.rglob("*.py"):
            z.write(p, p.relative_to(top.parent))
    code = "import presswork.functions.text, presswork.operators.groups, presswork.sources.corpus, presswork.llm.common as c; print(c.__file__)"
    got = subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {str(out)!r}); {code}"], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0 and str(out) in got.stdout, got.stderr


def test_s4_texts_meet_no_join_and_no_window(spark, tmp_path):
    """The newest day written again, on tables of its own: bodies are neither
    joined with the events nor ordered nor kept, and repeats are known by digest."""
    from presswork.plans import q_combos as J3
    from presswork.plans.q_serving import s4_upsert
    t1, t2 = dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 2, 9)
    docs = [(1, "rate and loan", "o"), (2, "rate and loan", "o"), (3, "rate", "o"), (4, "nothing", "o"), (5, None, "o"), (6, "loan", None),
            (7, "loan", "p"), (8, "rate", "p"), (9, "rate", "o"), (10, "rate", "o"), (None, "rate", "o")]
    times = [(i, t1) for i in (1, 2, 3, 4, 5, 6)] + [(8, None), (9, t2), (10, t2)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("lang", F.lit("en")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(times, "event_id long, ts timestamp").write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame([(0, "rate loan rate it")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {(r.date, r.keyword, r.id, r.agency) for r in s4_upsert(spark, str(tmp_path)).collect()}
    assert got == {(D1, "rate", 1, "o"), (D1, "rate", 3, "o"), (D1, "loan", 1, "o"), (D1, "loan", 6, None), (D2, "rate", 9, "O")}

    def nodes(p):
        yield p
        for i in range(p.children().size()):
            yield from nodes(p.children().apply(i))

    arts = J3.articles_table(spark, str(tmp_path))
    for columns, carried in ((["date", "keyword", "id", "agency"], False), (["id", "content"], True)):
        met = [x for x in nodes(arts.select(*columns)._jdf.queryExecution().optimizedPlan()) if x.nodeName() in ("Join", "Window")]
        assert len(met) >= 3 and all(("content#" in x.output().mkString(",")) == carried for x in met)
    assert "FileScan" not in plan(s4_upsert(spark, str(tmp_path)))  # read once, before
