"""Page extraction and article gates: E1-E7.

HTML is handled with regex columns (JVM-side), one row per page; no HTML
parser per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of the page parts on the driver's pages.
TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
ARTICLE_RE = r"(?is)<article[^>]*>(.*?)</article>"
IMG_RE = r"(?is)<img[^>]*?(?:data-src|src)=\"([^\"]+)\""
TAG_RE = r"<[^>]+>"
CATEGORY_RE = r"/(en|de|fr|es)/"


def element_re(tag: str, cls: str | None = None) -> str:
    """Pattern of an element's inside, up to the first closing tag."""
    attrs = rf"[^>]*class=\"[^\"]*\b{cls}\b[^\"]*\"[^>]*" if cls else r"(?:\s[^>]*)?"
    return rf"(?is)<{tag}{attrs}>(.*?)</{tag}>"


# Boilerplate blocks as ``(outlet, part, seq, pattern)``. The parts
# are collected in this order; in a part the first pattern by ``seq`` that finds
# anything serves; an outlet's rows of a part stand in place of the common ones.
BLOCK_PARTS = ("photo", "summary", "other")
OUTLET_BLOCKS = [
    (None, "photo", 0, element_re("span")),
    (None, "summary", 0, element_re("strong")),
    (None, "summary", 1, element_re("li")),
    ("머니S", "photo", 0, element_re("table")),
    ("머니투데이", "other", 0, element_re("b")),
    ("이데일리", "photo", 0, element_re("table")),
    ("이데일리", "photo", 1, element_re("figure")),
    ("이데일리", "other", 0, element_re("div", "pharm")),
]

# The driver's pages: the heading repeats the title; where no strong block is,
# a bold lead block, which ends at </b>, <br> or </p>, is the summary.
CORPUS_BLOCKS = [
    (None, "photo", 0, r"(?is)<h1[^>]*>(.*?)</h1>"),
    (None, "summary", 0, element_re("strong")),
    (None, "summary", 1, r"(?is)<b>(.*?)(?:</b>|<br>|</p>)"),
    *(r for r in OUTLET_BLOCKS if r[0] is not None),
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_title(html="html", fallback: str | None = None) -> Column:
    """Text of <title>; ``fallback`` when absent."""
    t = F.nullif(F.trim(F.regexp_extract(_c(html), TITLE_RE, 1)), F.lit(""))
    return F.coalesce(t, F.lit(fallback)) if fallback is not None else t


def article_block(html="html") -> Column:
    return F.nullif(F.regexp_extract(_c(html), ARTICLE_RE, 1), F.lit(""))


def strip_tags(c) -> Column:
    """Tags removed, control whitespace (newline, CR, tab) deleted."""
    return F.regexp_replace(F.regexp_replace(_c(c), TAG_RE, ""), r"[\n\r\t]", "")


def extract_body(html="html") -> Column:
    """Article text, tags removed; null when there is no article node."""
    return strip_tags(article_block(html))


def extract_thumbnail(html="html") -> Column:
    """Image URL, null when absent."""
    return F.nullif(F.regexp_extract(_c(html), IMG_RE, 1), F.lit(""))


def category_of(url="url") -> Column:
    return F.nullif(F.regexp_extract(_c(url), CATEGORY_RE, 1), F.lit(""))


def category_gate(category, topic: str) -> Column:
    """The category must contain ``topic``; absent category rejects."""
    return F.coalesce(_c(category).contains(topic), F.lit(False))


def article_gate(title, body, category, topic: str, banned: str) -> Column:
    """E5: title present without ``banned``, body present, and E4."""
    t, b = _c(title), _c(body)
    ok = t.isNotNull() & ~F.coalesce(t.contains(banned), F.lit(False)) & b.isNotNull()
    return ok & category_gate(category, topic)


def block_plan(rules: Sequence[tuple] = tuple(OUTLET_BLOCKS)) -> dict[str, dict[str | None, list[str]]]:
    """The rule table by part, then by outlet: patterns in ``seq`` order."""
    plan: dict = {p: {} for p in BLOCK_PARTS}
    for outlet, part, _seq, pattern in sorted(rules, key=lambda r: r[2]):
        plan[part].setdefault(outlet, []).append(pattern)
    return plan


def boilerplate(html="html", outlet=None, rules: Sequence[tuple] = tuple(OUTLET_BLOCKS)) -> Column:
    """Fragments to delete (photo captions, summaries, an outlet's other
    blocks, in this order), as plain text. Without an ``outlet`` only the common
    rows count. An element ends at the first closing tag of its name."""
    blk = F.coalesce(article_block(html), F.lit(""))
    none = F.array().cast("array<string>")

    def first_found(patterns: list[str]) -> Column:
        found = [F.regexp_extract_all(blk, F.lit(r), 1) for r in patterns]
        if len(found) == 1:
            return found[0]
        return F.coalesce(F.get(F.filter(F.array(*found), lambda a: F.size(a) > 0), F.lit(0)), none)

    arrays = []
    for by in block_plan(rules).values():
        common = first_found(by[None]) if None in by else none
        case = None
        for who, patterns in by.items():
            if who is not None and outlet is not None:
                own = _c(outlet) == F.lit(who)
                case = F.when(own, first_found(patterns)) if case is None else case.when(own, first_found(patterns))
        arrays.append(common if case is None else case.otherwise(common))
    return F.filter(F.transform(F.concat(*arrays), strip_tags), lambda s: F.length(s) > 0)


def remove_fragments(body, frags) -> Column:
    """Delete every fragment from the body, in order."""
    return F.aggregate(_c(frags), _c(body), lambda acc, f: F.replace(acc, f, F.lit("")))


def parse_pages(pages: DataFrame, topic: str = "en", banned: str = "Breaking", outlet=None,
                blocks: Sequence[tuple] = tuple(CORPUS_BLOCKS)) -> DataFrame:
    """E1-E7 on a page table: ``(page_id, url, title, body, thumbnail, category,
    valid, fragments, content)``; ``outlet`` (a column of ``pages``) picks the
    rows of the block table."""
    p = pages.select(
        "page_id", "url", "html",
        (F.lit(None).cast("string") if outlet is None else _c(outlet)).alias("_outlet"),
        extract_title("html").alias("title"),
        extract_body("html").alias("body"),
        extract_thumbnail("html").alias("thumbnail"),
        category_of("url").alias("category"))
    p = p.withColumn("valid", article_gate("title", "body", "category", topic, banned))
    p = p.withColumn("fragments", boilerplate("html", None if outlet is None else "_outlet", blocks))
    return p.withColumn("content", remove_fragments("body", "fragments")).drop("html", "_outlet")
