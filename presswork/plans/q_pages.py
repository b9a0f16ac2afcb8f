"""Registered queries: page extraction, gates and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.functions import clean_rules as R
from presswork.functions.text import TRIM_RE
from presswork.operators import clean as C
from presswork.operators import pages as P
from presswork.operators.articles import drop_repeats, number_rows, quota
from presswork.plans.registry import query
from presswork.session import cut_lineage
from presswork.sources.corpus import read_pages

TOPIC = "en"
BANNED = "Breaking"  # role of the personnel-notice word on the corpus


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _pages(spark, sf) -> DataFrame:
    return read_pages(spark, f"{sf}/pages.parquet")


def host_of(url="url"):
    """Outlet of a page = host of its url."""
    return F.regexp_extract(F.col(url), r"^[a-z]+://([^/]+)", 1)


def _parsed(spark, sf) -> DataFrame:
    return P.parse_pages(_pages(spark, sf), TOPIC, BANNED, host_of()).withColumn("agency", host_of())


# ---------------------------------------------------------------- SQL side

def sql_strip_tags(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '<[^>]+>', '', 'g'), '[\\n\\r\\t]', '', 'g')"


SQL_BLOCK = f"nullif(regexp_extract(html, {_q(P.ARTICLE_RE)}, 1), '')"
SQL_TITLE = f"nullif(trim(regexp_extract(html, {_q(P.TITLE_RE)}, 1)), '')"
SQL_BODY = sql_strip_tags(SQL_BLOCK)
SQL_THUMB = f"nullif(regexp_extract(html, {_q(P.IMG_RE)}, 1), '')"
SQL_CAT = f"nullif(regexp_extract(url, {_q(P.CATEGORY_RE)}, 1), '')"
SQL_AGENCY = "regexp_extract(url, '^[a-z]+://([^/]+)', 1)"


def sql_fragments(html: str, outlet: str, rules) -> str:
    """One list a part, the first pattern that finds anything."""
    block = f"coalesce(nullif(regexp_extract({html}, {_q(P.ARTICLE_RE)}, 1), ''), '')"

    def first_found(patterns):
        found = [f"regexp_extract_all({block}, {_q(r)}, 1)" for r in patterns]
        return "CASE " + " ".join(f"WHEN len({x}) > 0 THEN {x}" for x in found) + " ELSE [] END"

    parts = []
    for by in P.block_plan(rules).values():
        own = " ".join(f"WHEN {outlet} = {_q(w)} THEN {first_found(p)}" for w, p in by.items() if w is not None)
        common = first_found(by[None]) if None in by else "[]"
        parts.append(f"CASE {own} ELSE {common} END" if own else common)
    return f"list_filter(list_transform({' || '.join(f'({p})' for p in parts)}, lambda s: {sql_strip_tags('s')}), lambda s: length(s) > 0)"


SQL_FRAGS = sql_fragments("html", SQL_AGENCY, P.CORPUS_BLOCKS)


def sql_apply_rules(t: str, rules) -> str:
    for _who, pat, rep in rules:
        if pat == R.TAIL:
            tail = (f"(CASE WHEN contains({t}, '. ') THEN regexp_extract({t}, '(?s)^.*\\. (.*)$', 1) "
                    f"ELSE {t} END)")
            t = f"(CASE WHEN {tail} = '' THEN {t} ELSE replace({t}, {tail}, '') END)"
        else:
            t = f"regexp_replace({t}, {_q(pat)}, {_q(rep)}, 'g')"
    return t


def sql_by_outlet(c: str, outlet: str, rules) -> str:
    common = [r for r in rules if r[0] is None]
    per: dict = {}
    for r in rules:
        if r[0] is not None:
            per.setdefault(r[0], []).append(r)
    if not per:
        return sql_apply_rules(c, common)
    cases = " ".join(f"WHEN {outlet} = {_q(w)} THEN {sql_apply_rules(c, rs)}" for w, rs in per.items())
    return sql_apply_rules(f"(CASE {cases} ELSE {c} END)", common)


def sql_clean_ctes(src: str, c: str, outlet: str, extra, keys: str, symbols_last: bool = False) -> str:
    """CTEs ``{src}_c1`` .. ``{src}_c4``; ``{src}_cl`` has ``cleaned`` and ``keys``."""
    t = f"replace({c}, {_q(R.SCRIPT_NOISE)}, '')"
    for lit in ("\n", "\r", "<br>", "\t"):
        t = f"replace({t}, {_q(lit)}, '')"
    t = f"regexp_replace({t}, '{TRIM_RE}', '', 'g')"
    t = sql_apply_rules(t, R.GENERIC_RULES)
    symbols = "translate({0}, " + _q(R.SYMBOLS) + ", '')"
    t = t if symbols_last else symbols.format(t)
    t = sql_apply_rules(t, R.UNCONDITIONAL_RULES)
    own = sql_by_outlet('_t', outlet, R.OUTLET_RULES)
    return f"""{src}_c1 AS (SELECT *, {t} AS _t FROM {src}),
{src}_c2 AS (SELECT * EXCLUDE (_t), {symbols.format(own) if symbols_last else own} AS _t FROM {src}_c1),
{src}_c3 AS (SELECT * EXCLUDE (_t), {sql_by_outlet('_t', outlet, extra)} AS _t FROM {src}_c2),
{src}_c4 AS (SELECT * EXCLUDE (_t), CASE WHEN _t = '' OR _t = ' ' THEN NULL ELSE _t END AS _t FROM {src}_c3),
{src}_cl AS (SELECT * EXCLUDE (_t), regexp_replace(replace(_t, '  ', ' '), '^ ', '') AS cleaned FROM {src}_c4)"""


PARSED = f"""parsed AS (
  SELECT page_id, url, {SQL_TITLE} AS title, {SQL_BODY} AS body, {SQL_THUMB} AS thumbnail,
         {SQL_CAT} AS category, {SQL_FRAGS} AS fragments,
         {SQL_AGENCY} AS agency
  FROM pages),
gated AS (
  SELECT *, (title IS NOT NULL AND NOT coalesce(contains(title, {_q(BANNED)}), false) AND body IS NOT NULL
             AND coalesce(contains(category, {_q(TOPIC)}), false)) AS valid,
         list_reduce(fragments, lambda acc, f: replace(acc, f, ''), body) AS content
  FROM parsed)"""


@query("s7_read_pages", "SELECT page_id, url, length(html) AS n_html FROM pages")
def s7_read_pages(spark, sf):
    return _pages(spark, sf).select("page_id", "url", F.length("html").alias("n_html"))


@query("e1_extract_title", f"SELECT page_id, {SQL_TITLE} AS title FROM pages")
def e1_extract_title(spark, sf):
    return _pages(spark, sf).select("page_id", P.extract_title("html").alias("title"))


@query("e2_extract_body", f"SELECT page_id, {SQL_BODY} AS body FROM pages")
def e2_extract_body(spark, sf):
    return _pages(spark, sf).select("page_id", P.extract_body("html").alias("body"))


@query("e3_extract_thumbnail", f"SELECT page_id, {SQL_THUMB} AS thumbnail FROM pages")
def e3_extract_thumbnail(spark, sf):
    return _pages(spark, sf).select("page_id", P.extract_thumbnail("html").alias("thumbnail"))


@query("e4_category_gate", f"""SELECT page_id, {SQL_CAT} AS category,
  coalesce(contains({SQL_CAT}, {_q(TOPIC)}), false) AS ok FROM pages""")
def e4_category_gate(spark, sf):
    p = _pages(spark, sf).select("page_id", P.category_of("url").alias("category"))
    return p.withColumn("ok", P.category_gate("category", TOPIC))


@query("e5_article_gate", f"WITH {PARSED} SELECT page_id, valid FROM gated")
def e5_article_gate(spark, sf):
    return _parsed(spark, sf).select("page_id", "valid")


@query("e6_boilerplate", f"""WITH {PARSED}
SELECT page_id, CAST(generate_subscripts(fragments, 1) - 1 AS INTEGER) AS pos, unnest(fragments) AS fragment
FROM parsed""")
def e6_boilerplate(spark, sf):
    p = _parsed(spark, sf)
    return p.select("page_id", F.posexplode("fragments").alias("pos", "fragment"))


@query("e7_remove_fragments", f"WITH {PARSED} SELECT page_id, content FROM gated")
def e7_remove_fragments(spark, sf):
    return _parsed(spark, sf).select("page_id", "content")


@query("e8_e14_clean_text", f"""WITH {PARSED}, {sql_clean_ctes('gated', 'content', 'agency', R.CORPUS_RULES, 'page_id')}
SELECT page_id, cleaned FROM gated_cl""")
def e8_e14_clean_text(spark, sf):
    p = _parsed(spark, sf)
    return C.clean_body(p, "content", "agency", R.CORPUS_RULES).select("page_id", "cleaned")


@query("e10_strip_symbols", f"WITH {PARSED} SELECT page_id, translate(title, {_q(R.SYMBOLS)}, '') AS title FROM gated")
def e10_strip_symbols(spark, sf):
    p = _parsed(spark, sf)
    return p.select("page_id", C.strip_symbols("title").alias("title"))


@query("e13_drop_tail", f"WITH {PARSED} SELECT page_id, {sql_apply_rules('content', [(None, R.TAIL, '')])} AS content FROM gated")
def e13_drop_tail(spark, sf):
    p = _parsed(spark, sf)
    return p.select("page_id", C.drop_tail_after_last_stop("content").alias("content"))


def page_articles(spark, sf, n: int = 30) -> DataFrame:
    """Pages -> E1-E7 -> gate -> E8-E14 -> E15 -> E16 -> E18.

    The category plays the retrieved-under keyword; the host is the outlet, and
    E15 runs along one outlet's list, as the crawl does. Cleaned texts are
    written once; what goes through the windows is a digest of them.
    """
    p = C.clean_body(_parsed(spark, sf).filter("valid"), "content", "agency", R.CORPUS_RULES)
    texts = cut_lineage(p.select("page_id", F.col("category").alias("keyword"), "title", "thumbnail", "url", "agency",
                                 F.col("cleaned").alias("content")))
    kept = drop_repeats(texts.select("page_id", "keyword", "agency", "thumbnail", F.sha2(F.col("content").cast("binary"), 256).alias("content")),
                        order=[F.col("page_id")], partition=("keyword", "agency"))
    kept = quota(kept, order=[F.col("page_id")], n=n, partition=("keyword", "agency"))
    ids = number_rows(cut_lineage(kept.select("page_id", "keyword")), "keyword", "page_id")
    return texts.join(ids.select("page_id", "id"), "page_id")


@query("j1_page_articles", f"""WITH {PARSED},
vg AS (SELECT * FROM gated WHERE valid),
{sql_clean_ctes('vg', 'content', 'agency', R.CORPUS_RULES, 'page_id')},
cleaned AS (
  SELECT page_id, category AS keyword, title, thumbnail, url, agency, cleaned AS content FROM vg_cl),
rep AS (SELECT *, lag(content) OVER (PARTITION BY keyword, agency ORDER BY page_id) AS prev
        FROM cleaned WHERE content IS NOT NULL),
kept AS (SELECT * FROM rep WHERE NOT (thumbnail IS NULL AND prev IS NOT NULL AND content = prev)),
q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY keyword, agency ORDER BY page_id) AS rn FROM kept)
      WHERE rn <= 30)
SELECT page_id, keyword, title, thumbnail, url, agency, content,
       CAST(row_number() OVER (PARTITION BY keyword ORDER BY page_id) - 1 AS VARCHAR) AS id
FROM q""")
def j1_page_articles(spark, sf):
    return page_articles(spark, sf).select(
        "page_id", "keyword", "title", "thumbnail", "url", "agency", "content", "id")


# Own sample texts of the forms that the outlet rules are for: what an outlet puts before and after a body.
SIGNATURES = [
    ("매일경제", "[홍길동 기자] ", " 장관(사진)은 말했다."),
    ("뉴시스", "기사내용 요약 표본 [서울=뉴시스] 홍길동 기자 = ", " ☞공감언론 뉴시스 a@newsis.com"),
    ("연합뉴스", "(서울=연합뉴스) 홍길동 기자 = ", ". hong@yna.co.kr ▶제보는 카톡 okjebo"),
    ("한국경제", "<아파트 탐구> 표본. ", ". 홍길동 기자 hong@hankyung.com"),
    ("KBS", "[KBS 표본] ", ". 홍길동 기자 (hong@kbs.co.kr) KBS 지역국"),
    ("중앙일보", "", ". 홍길동 기자 hong@joongang.co.kr"),
    ("조선일보", "", " 기사보기 7NEWS 뉴스레터 구독하기 표본 subscriptions/123456"),
    ("국민일보", "", ". 홍길동 기자 hong@kmib.co.kr 표본 재배포금지"),
    ("아시아경제", "[아시아경제 홍길동 기자] ", " 사진=홍길동 기자"),
    ("조선비즈", "", "- Copyright ⓒ 조선비즈 & Chosun.com -"),
    ("다른 곳", "[표본 기자] ", " ▶"),
]
_SIGNED = ", ".join(f"({k}, {_q(o)}, {_q(a)}, {_q(b)})" for k, (o, a, b) in enumerate(SIGNATURES))
SIGNED_SQL = f"""signed AS (
  SELECT doc_id, outlet, head || text || tail AS body
  FROM documents JOIN (VALUES {_SIGNED}) s(k, outlet, head, tail) ON doc_id % {len(SIGNATURES)} = k)"""


def signed_texts(spark, sf) -> DataFrame:
    """Every document signed in the way of one of the outlets, by its id."""
    s = F.element_at(F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(("outlet", "head", "tail"), row, strict=True)))
                               for row in SIGNATURES)), (F.col("doc_id") % len(SIGNATURES) + 1).cast("int"))
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", s.alias("s"))
    return d.select("doc_id", "s.outlet", F.concat("s.head", "text", "s.tail").alias("body"))


@query("e12_outlet_rules", f"""WITH {SIGNED_SQL}, {sql_clean_ctes('signed', 'body', 'outlet', [], 'doc_id')}
SELECT doc_id, outlet, cleaned FROM signed_cl""")
def e12_outlet_rules(spark, sf):
    return C.clean_body(signed_texts(spark, sf), "body", "outlet").select("doc_id", "outlet", "cleaned")


@query("e12_symbols_last", f"""WITH {SIGNED_SQL}, {sql_clean_ctes('signed', 'body', 'outlet', [], 'doc_id', True)}
SELECT doc_id, outlet, cleaned FROM signed_cl""")
def e12_symbols_last(spark, sf):
    """The second order: bracketed signatures are still there when their rules run."""
    return C.clean_body(signed_texts(spark, sf), "body", "outlet", symbols_last=True).select("doc_id", "outlet", "cleaned")
