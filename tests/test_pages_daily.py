"""Block table (E6), outlet rules in both orders (E12), trimming (E8, K5), ties of
the keyed upsert (S4), numbering (E18), age exclusion (K1), daily lists (M1, M2, S5)."""

import datetime

import pytest
from pyspark.sql import functions as F

from presswork.functions import clean_rules as R
from presswork.functions.text import strip_ws
from presswork.operators import clean as C
from presswork.operators import combos as M
from presswork.operators import keywords as K
from presswork.operators import pages as P
from presswork.operators.articles import number_rows, upsert

PAGE = ("<article><span>s1</span><strong>t1</strong><ul><li>l1</li></ul><table><tr><td>tb</td></tr></table>"
        "<b>b1</b><div class=\"x pharm\">d1</div><figure>f1</figure></article>")
PLAIN = "<article><ul><li>l1</li><li>l2</li></ul><figure>f1</figure></article>"


@pytest.mark.parametrize("outlet, html, want", [
    ("어디", PAGE, ["s1", "t1"]),
    (None, PAGE, ["s1", "t1"]),
    ("머니S", PAGE, ["tb", "t1"]),
    ("머니투데이", PAGE, ["s1", "t1", "b1"]),
    ("이데일리", PAGE, ["tb", "t1", "d1"]),
    ("이데일리", PLAIN, ["f1", "l1", "l2"]),
    ("어디", PLAIN, ["l1", "l2"]),
    ("어디", "<p>no article</p>", []),
    ("어디", None, []),
])
def test_e6_blocks(spark, outlet, html, want):
    df = spark.createDataFrame([(html, outlet)], "html string, outlet string")
    assert df.select(P.boilerplate("html", "outlet")).first()[0] == want


def test_e6_without_outlet_and_e7(spark):
    df = spark.createDataFrame([(PAGE,)], "html string")
    got = df.select(P.boilerplate("html").alias("f"), P.extract_body("html").alias("b")).select("f", P.remove_fragments("b", "f").alias("c")).first()
    assert got.f == ["s1", "t1"] and got.c == "l1tbb1d1f1"


# one text of its form for each outlet rule, and what the rule leaves of it
SAMPLES = [
    ("매일경제", "[홍길동 기자]본문", "본문"), ("매일경제", "[신짜오 베트남 - 1]본문", "본문"), ("매일경제", "장관(사진)은", "장관은"),
    ("뉴시스", "기사내용 요약 가 [서울=뉴시스]본문", "본문"), ("뉴시스", "[서울=뉴시스]본문", "본문"), ("뉴시스", "홍길동 기자 =본문", "본문"),
    ("뉴시스", "본문☞공감언론 a@newsis.com", "본문"), ("연합뉴스", "(서울=연합뉴스) 홍길동 기자 =본문", "본문"),
    ("연합뉴스", "본문[표본 제공]", "본문."), ("연합뉴스", "본문. hong@yna.co.kr", "본문."), ("연합뉴스", "본문.(홍길동 기자)", "본문."),
    ("한국경제", "A. B. tail", "A. B. "), ("한국경제", "<아파트 탐구> 표본. 본문. tail", " "),
    ("KBS", "본문. 홍길동 기자 (hong@kbs.co.kr)", "본문."), ("KBS", "[KBS 춘천]본문", "본문"), ("중앙일보", "본문. 홍길동 기자 a@joongang.co.kr", "본문."),
    ("조선일보", "본문기사보기", "본문"), ("국민일보", "본문. 홍길동 기자 a@kmib.co.kr 재배포금지", "본문."),
    ("아시아경제", "[아시아경제 홍길동 기자]본문", "본문"), ("아시아경제", "본문 사진=홍길동 기자", "본문 "), ("조선비즈", "본문- Copyright ⓒ 조선비즈 & Chosun.com -", "본문"),
]


def test_e12_each_outlet(spark):
    rows = [(i, o, t) for i, (o, t, _w) in enumerate(SAMPLES)]
    df = spark.createDataFrame(rows, "i int, outlet string, t string")
    got = {r.i: r.t for r in C.clean_by_outlet(df, "t", "outlet").collect()}
    want = {i: w for i, (_o, _t, w) in enumerate(SAMPLES)}
    assert got == want
    # another outlet's rules leave the texts alone
    other = df.withColumn("outlet", F.lit("다른 곳"))
    assert {r.i: r.t for r in C.clean_by_outlet(other, "t", "outlet").collect()} == {i: t for i, _o, t in rows}


def test_e12_second_order(spark):
    df = spark.createDataFrame([("KBS", "본문 [KBS 춘천] 끝")], "outlet string, t string")
    first = C.clean_body(df, "t", "outlet").first().cleaned
    second = C.clean_body(df, "t", "outlet", symbols_last=True).first().cleaned
    assert first == "본문 KBS 춘천 끝" and second == "본문 끝"


def test_e8_unicode_trim(spark):
    spaces = "".join(map(chr, [0x20, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x205F, 0x3000, 0x1C, 0x1F, 0x0B]))
    df = spark.createDataFrame([(f"{spaces}a b{spaces}",), (spaces,), ("",), (None,), ("\u200ba",)], "t string")
    got = [r[0] for r in df.select(strip_ws("t")).collect()]
    assert got == [None if t is None else t.strip() for t in (f"{spaces}a b{spaces}", spaces, "", None, "\u200ba")]


def test_rules_are_all_sampled():
    assert {o for o, _p, _r in R.OUTLET_RULES} == {o for o, _t, _w in SAMPLES}


def test_s4_ties(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 5), ("b", 4), ("c", 3)], "k string, v int")
    got = upsert(new, old, ["k"], order=["v"]).collect()
    assert sorted((r.k, r.v) for r in got) == [("a", 1), ("b", 4), ("c", 3)]


def test_e18_numbers_across_blocks(spark):
    rows = [("k" if i % 3 else "m", i) for i in range(0, 50, 2)]
    df = spark.createDataFrame(rows, "k string, i long")
    got = {(r.k, r.i): r.id for r in number_rows(df, "k", "i", block=7).collect()}
    want = {}
    for key in ("k", "m"):
        want.update({(key, i): str(n) for n, i in enumerate(sorted(i for k, i in rows if k == key))})
    assert got == want
    assert number_rows(df.limit(0), "k", "i").count() == 0


def test_k1_excludes_older(spark):
    at = datetime.datetime(2024, 1, 2)
    df = spark.createDataFrame([(h, at - datetime.timedelta(hours=h)) for h in (0, 5, 6, 23, 24, 30)], "h int, ts timestamp")
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert {r.h: r.slot for r in K.age_slot(df, "ts", as_of).collect()} == {0: 0, 5: 0, 6: 1, 23: 5}


def test_m1_m2_s5_by_day(spark):
    d1, d2 = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)
    table = spark.createDataFrame(
        [(d1, "FIX_0", "rate"), (d1, "DAY_0", "loan"), (d1, "DAY_1", "rate"), (d1, "MIX_0", "a&b"), (d1, "FIX_1", "none"), (d2, "FIX_0", "rate")],
        "date date, type_id string, value string")
    base = M.daily_base_keywords(table)
    assert sorted((r.date.day, r.type_id, r.keyword, r.kpos) for r in base.collect()) == [
        (1, "DAY_0", "loan", 0), (1, "DAY_1", "rate", 1), (1, "FIX_1", "none", 2), (2, "FIX_0", "rate", 0)]
    arts = spark.createDataFrame([(d1, "o", 1, None, "loan and rate"), (d1, "o", 2, None, "loan"), (d1, "o", 3, None, "loan"), (d2, "o", 4, None, "loan"), (d2, "o", 5, None, None)],
                                 "date date, agency string, id long, thumbnail string, content string")
    rows = M.daily_retrieved(arts, base)
    assert sorted((r.date.day, r.keyword, r.id, [w.keyword for w in r.words]) for r in rows.collect()) == [
        (1, "loan", 1, ["loan", "rate"]), (1, "loan", 2, ["loan"]), (1, "rate", 1, ["loan", "rate"])]
    live = M.with_articles(base, rows)
    assert sorted((r.date.day, r.keyword) for r in live.collect()) == [(1, "loan"), (1, "rate")]
    left = M.drop_dead(table, base, live)
    assert sorted((r.date.day, r.type_id) for r in left.collect()) == [(1, "DAY_0"), (1, "DAY_1"), (1, "FIX_0"), (1, "MIX_0")]
    few = M.MAX_DAYS
    try:
        M.MAX_DAYS = 0
        assert M.daily_retrieved(arts, base).count() == 3
    finally:
        M.MAX_DAYS = few
