"""Composite keywords: M1-M8, and the combo plan P1 / P2.

Everything is keyed by ``date``: each day's combos are mined from that
day's articles, all days in one plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.session import cut_lineage
from presswork.operators.articles import drop_keys, drop_repeats, quota


def base_keywords(keywords: DataFrame) -> DataFrame:
    """M1: every keyword but MIX ones, with its position ``kpos``."""
    return keywords.filter(~F.col("type_id").contains("MIX"))


def daily_base_keywords(keywords: DataFrame) -> DataFrame:
    """M1 for every day: ``(date, type_id, keyword, kpos)`` from the keyword table
    ``(date, type_id, value)``. Positions follow the ids, so DAY words stand
    before FIX words. A word listed twice on a day counts under its first id."""
    k = base_keywords(keywords).groupBy("date", F.col("value").alias("keyword")).agg(F.min("type_id").alias("type_id"))
    w = Window.partitionBy("date").orderBy("type_id")
    return k.select("date", "type_id", "keyword", (F.row_number().over(w) - 1).alias("kpos"))


def contains_join(articles: DataFrame, keywords: DataFrame, content: str = "content") -> DataFrame:
    """M3: article x keyword where the body contains the keyword.

    The keyword side is a bounded list (at most a few dozen per day), so the
    theta join is a broadcast nested loop; the article side streams.
    """
    k = F.broadcast(keywords.select("keyword", "kpos"))
    return articles.join(k, F.col(content).contains(F.col("keyword")))


def keyword_articles(articles: DataFrame, keywords: DataFrame, n: int = 30,
                     dated: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The per-day article table: retrieval by keyword (M3), repeats skipped
    (E15) and the quota of ``n`` per (keyword, outlet) (E16).

    The E15 window runs per (date, keyword, outlet): the crawl walks one
    outlet's list at a time, and this bounds every window by one outlet's
    articles of one day.

    A body is read once, against the whole list (one value: a list of a few
    dozen keywords), and compared by its digest, so it goes no further where
    the caller does not read it. ``dated`` adds the dates to articles that have
    none yet (a join that bodies then need not go through); rows that get none
    are left out.
    """
    content = F.col("content")
    listed = keywords.agg(F.array_sort(F.collect_list(F.struct("kpos", "keyword"))).alias("l")).scalar()
    found = articles.filter(content.isNotNull()).withColumns({"_digest": F.unhex(F.sha2(content.cast("binary"), 256)), "_listed": listed})
    found = found.withColumn("_words", F.filter("_listed", lambda k: content.contains(k["keyword"]))).drop("_listed")
    if dated is not None:
        found = dated(found).filter(F.col("date").isNotNull())
    hits = found.select("*", F.inline("_words")).drop("_words")
    hits = drop_repeats(hits, order=[F.col("id")], partition=("date", "keyword", "agency"), content="_digest").drop("_digest")
    return quota(hits, order=[F.col("id")], n=n, partition=("date", "keyword", "agency"))


def retrieved(articles: DataFrame, keywords: DataFrame, n: int = 30) -> DataFrame:
    """The rows of ``keyword_articles`` without the texts, with all keywords of
    each text: ``(date, keyword, kpos, agency, id, words)``; ``words`` are
    ``(kpos, keyword)`` in order.

    A body is read once, against the whole list (one value: a list of a few
    dozen keywords), and stays behind: what goes through the windows of E15 and
    E16 is its id and a digest, once a keyword that it contains."""
    listed = keywords.agg(F.array_sort(F.collect_list(F.struct("kpos", "keyword"))).alias("l")).scalar()
    content = F.col("content")
    found = articles.filter(content.isNotNull()).select(
        "date", "agency", "id", F.col("thumbnail").isNull().alias("bare"), F.sha2(content.cast("binary"), 256).alias("digest"),
        "content", listed.alias("listed"))
    return _accepted(found, n)


#: Days whose keyword lists (a few dozen words each) are sent to every executor.
MAX_DAYS = 20_000


def daily_retrieved(articles: DataFrame, keywords: DataFrame, n: int = 30) -> DataFrame:
    """``retrieved`` with each day's own list: ``keywords`` are ``(date, keyword,
    kpos)``. The lists are broadcast as one row a day where there are at most
    ``MAX_DAYS`` of them (counted), else joined by date."""
    lists = cut_lineage(keywords.groupBy("date").agg(F.array_sort(F.collect_list(F.struct("kpos", "keyword"))).alias("listed")))
    few = lists.limit(MAX_DAYS + 1).count() <= MAX_DAYS
    found = articles.filter(F.col("content").isNotNull()).select(
        "date", "agency", "id", F.col("thumbnail").isNull().alias("bare"), F.sha2(F.col("content").cast("binary"), 256).alias("digest"), "content")
    return _accepted(found.join(F.broadcast(lists) if few else lists, "date"), n)


def _accepted(found: DataFrame, n: int) -> DataFrame:
    """E15 and E16 on articles with the list ``listed`` to look for in ``content``."""
    content = F.col("content")
    found = found.withColumn("words", F.filter("listed", lambda k: content.contains(k["keyword"]))).drop("content", "listed")
    hits = found.select("date", "agency", "id", "bare", "digest", "words", F.inline("words"))
    by = Window.partitionBy("date", "keyword", "agency").orderBy("id")
    before = F.lag("digest").over(by)
    kept = hits.withColumn("_same", F.col("bare") & F.coalesce(before == F.col("digest"), F.lit(False))).filter("not _same")
    kept = kept.withColumn("_rn", F.row_number().over(by)).filter(F.col("_rn") <= n)
    return kept.select("date", "keyword", "kpos", "agency", "id", "words")


def live_keywords(articles: DataFrame) -> DataFrame:
    """M2: per date, the keywords that retrieved at least one article."""
    return articles.select("date", "keyword", "kpos").distinct()


def with_articles(keywords: DataFrame, articles: DataFrame) -> DataFrame:
    """M2: the keywords of a day that retrieved at least one of its articles."""
    return keywords.join(articles.select("date", "keyword"), ["date", "keyword"], "left_semi")


def drop_dead(table: DataFrame, base: DataFrame, live: DataFrame) -> DataFrame:
    """S5 after M2: the keyword table ``(date, type_id, value)`` without the rows
    of base keywords that retrieved nothing; all other rows (MIX) stay."""
    dead = base.join(live, ["date", "keyword"], "left_anti").select("date", F.col("keyword").alias("value"))
    rest = table.filter(~F.col("type_id").contains("MIX"))
    return drop_keys(rest, dead, ["date", "value"]).unionByName(table.filter(F.col("type_id").contains("MIX")))


def prefix_itemsets(arts: DataFrame, keywords: DataFrame) -> DataFrame:
    """M4: per retrieved article row, the matched keywords in ``kpos`` order;
    its first two and first three are counted (not all pairs).

    Output ``(date, combo array, size, first)``: one row per prefix, with
    ``first`` = position of the article row (retrieving keyword, id) for the
    first-appearance tie-break.
    """
    k = F.broadcast(keywords.select(F.col("keyword").alias("w"), F.col("kpos").alias("wpos")))
    matched = (arts.select("date", "keyword", "kpos", "id", "content")
               .join(k, F.col("content").contains(F.col("w")))
               .groupBy("date", "keyword", "kpos", "id")
               .agg(F.array_sort(F.collect_list(F.struct("wpos", "w"))).alias("ws")))
    words = F.transform("ws", lambda s: s["w"])
    return prefixes_of(matched.select("date", "kpos", "id", words.alias("words")))


def prefixes_of(rows: DataFrame) -> DataFrame:
    """M4 on rows ``(date, kpos, id, words)`` whose words are in order."""
    two = rows.filter(F.size("words") >= 2).select(
        "date", F.slice("words", 1, 2).alias("combo"), F.lit(2).alias("size"), "kpos", "id")
    three = rows.filter(F.size("words") >= 3).select(
        "date", F.slice("words", 1, 3).alias("combo"), F.lit(3).alias("size"), "kpos", "id")
    return two.unionByName(three)


def top_combos(prefixes: DataFrame, n: int = 10) -> DataFrame:
    """M5: per date, top ``n`` combos by count; ties by first appearance."""
    agg = prefixes.groupBy("date", "combo").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min(F.struct("kpos", F.col("id").cast("string").alias("ids"), "size")).alias("first"))
    w = Window.partitionBy("date").orderBy(F.desc("cnt"), F.asc("first"))
    return (agg.withColumn("top_pos", F.row_number().over(w) - 1)
            .filter(F.col("top_pos") < n).drop("first"))


def prune_supersets(top: DataFrame) -> DataFrame:
    """M6: drop a combo whose space-joined text contains the text of another
    combo of the same day's top list (self theta join on <= n rows a day)."""
    t = top.withColumn("text", F.array_join("combo", " "))
    other = t.select("date", F.col("text").alias("sub"))
    return t.join(other, (t["date"] == other["date"]) & (t["text"] != other["sub"])
                  & t["text"].contains(other["sub"]), "left_anti").drop("text")


def encode_combo(combo) -> F.Column:
    """M7: ``w1&w2[&w3]``; spaces inside a word also become ``&``."""
    c = F.col(combo) if isinstance(combo, str) else combo
    return F.replace(F.trim(F.array_join(c, " ")), F.lit(" "), F.lit("&"))


def rank_combos(kept: DataFrame) -> DataFrame:
    """M8: per date, ``MIX_<k>`` ids and ``rank = k`` in top-list order."""
    w = Window.partitionBy("date").orderBy("top_pos")
    r = kept.withColumn("rank", (F.row_number().over(w) - 1).cast("int"))
    return r.select("date", F.concat(F.lit("MIX_"), F.col("rank").cast("string")).alias("mix_id"),
                    encode_combo("combo").alias("value"), "rank", "cnt")


def combo_plan(combos: DataFrame, words: int = 2) -> DataFrame:
    """Decode, order by rank, cut to ``words`` words."""
    return combos.select("date", "mix_id", "rank", "value",
                         F.slice(F.split("value", "&"), 1, words).alias("words"))


def combo_articles(plan: DataFrame, articles: DataFrame) -> DataFrame:
    """Articles of a combo = each word's articles, duplicates kept (an
    equi-join of the exploded words with the article table's keyword)."""
    w = plan.select("date", "mix_id", "rank", "value", F.posexplode("words").alias("wpos", "keyword"))
    return w.join(articles, ["date", "keyword"])
