"""Serving queries V2-V8, V10 over the stored tables: keywords, articles, cluster
rows and summaries, each keyed and partitioned by date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KG = ["date", "keyword"]
KINDS = ("FIX", "DAY", "MIX")


def position(type_id: str = "type_id") -> Column:
    """The number in ``FIX_3``."""
    return F.regexp_extract(type_id, r"_(\d+)$", 1).cast("int")


def day_overview(dates: DataFrame, keywords: DataFrame) -> DataFrame:
    """V2: ``(date, fix, day, mix, missing)``: the three lists of each date in
    their order; ``missing`` where all are empty (the page shows an error)."""
    lists = [F.array_sort(F.collect_list(F.when(F.col("type_id").startswith(k), F.struct(position().alias("p"), "value")))) for k in KINDS]
    got = keywords.groupBy("date").agg(*(x.alias(k) for k, x in zip(KINDS, lists, strict=True)))
    got = dates.select("date").join(got, "date", "left")
    words = [F.coalesce(F.transform(k, lambda s: s["value"]), F.array().cast("array<string>")) for k in KINDS]
    return got.select("date", *(w.alias(k.lower()) for k, w in zip(KINDS, words, strict=True)),
                      (sum((F.size(w) for w in words), F.lit(0)) == 0).alias("missing"))


def cloud_freq(words: DataFrame, n: int = 20) -> DataFrame:
    """V3: at most ``n`` words a date with their counts as whole numbers, most
    first; rows without a word or a count are left out."""
    fine = words.filter(F.col("value").isNotNull() & F.col("cnt").isNotNull())
    w = Window.partitionBy("date").orderBy(F.desc("cnt"), "value")
    return (fine.select("date", "value", F.col("cnt").cast("int").alias("cnt")).withColumn("_r", F.row_number().over(w))
            .filter(F.col("_r") <= n).drop("_r"))


def is_combo(keyword: Column) -> Column:
    """Two or more words."""
    return F.size(F.split(keyword, "&")) > 1


def by_prefix(clusters: DataFrame, date, text: str, exact: bool = True) -> DataFrame:
    """V6: cluster rows of a date whose key ``<combo>_<n>`` starts with a combo's
    text; not ``exact``: also those of longer combos that start with it. Both
    are a partition filter and a string prefix on the sorted key, so files and
    row groups of other dates and keys are not read."""
    day = clusters.filter(F.col("date") == F.lit(date).cast("date"))
    return day.filter(F.col("row_key").startswith(f"{text}_" if exact else text))


def keyword_detail(articles: DataFrame, clusters: DataFrame, date, keyword: str) -> DataFrame:
    """V5 for one request: ``(date, keyword, kind, pos, id, title)``. A keyword of
    two or more words has cluster rows, in their order; one word has the
    articles retrieved under it, by id. The branch is taken before anything is read."""
    if "&" in keyword:
        rows = by_prefix(clusters, date, keyword)
        return rows.select("date", F.lit(keyword).alias("keyword"), F.lit("cluster").alias("kind"), F.col("n").alias("pos"), "id", "title")
    rows = articles.filter((F.col("date") == F.lit(date).cast("date")) & (F.col("keyword") == keyword))
    pos = (F.row_number().over(Window.partitionBy(*KG).orderBy("id")) - 1).cast("int")
    return rows.select("date", "keyword", F.lit("article").alias("kind"), pos.alias("pos"), "id", "title")


def keyword_details(articles: DataFrame, clusters: DataFrame, keywords: DataFrame) -> DataFrame:
    """V5 for all ``(date, value)`` of a keyword table, each by its branch."""
    asked = keywords.select("date", F.col("value").alias("keyword")).distinct()
    pos = (F.row_number().over(Window.partitionBy(*KG).orderBy("id")) - 1).cast("int")
    one = (articles.join(asked.filter(~is_combo(F.col("keyword"))), KG)
           .select(*KG, F.lit("article").alias("kind"), pos.alias("pos"), "id", "title"))
    two = (clusters.withColumnRenamed("combo", "keyword").join(asked.filter(is_combo(F.col("keyword"))), KG)
           .select(*KG, F.lit("cluster").alias("kind"), F.col("n").alias("pos"), "id", "title"))
    return one.unionByName(two)


def summary_rows(summaries: DataFrame) -> DataFrame:
    """V7: ``(date, keyword, pos, sentence)``; the empty piece after the last mark is no row."""
    cut = summaries.select(*KG, F.posexplode(F.split("summary", r"\^\^\^", -1)).alias("pos", "sentence"))
    return cut.filter(F.length("sentence") > 0)


def page(rows: DataFrame, wanted: Column, order: list, size: int = 8) -> DataFrame:
    """V8: the rows of one page per (date, keyword), with ``page`` and ``pages``.
    ``wanted`` is the page asked for; pages out of range become the nearest."""
    by = Window.partitionBy(*KG)
    numbered = (rows.withColumn("_pos", F.row_number().over(by.orderBy(*order)) - 1)
                .withColumn("pages", F.ceil(F.count(F.lit(1)).over(by) / size).cast("int")))
    numbered = numbered.withColumn("page", F.greatest(F.lit(1), F.least(wanted, "pages")).cast("int"))
    return numbered.filter(F.floor(F.col("_pos") / size) + 1 == F.col("page")).drop("_pos")


STATUS = ("nothing", "no articles", "no summary", "ok")


def keyword_status(keywords: DataFrame, articles: DataFrame, summaries: DataFrame) -> DataFrame:
    """``(date, keyword, articles, summaries, status)``: the two counts of a
    keyword, from either table or the keyword list, and what the page says."""
    a = articles.groupBy(*KG).agg(F.count(F.lit(1)).alias("articles"))
    s = summaries.groupBy(*KG).agg(F.count(F.lit(1)).alias("summaries"))
    listed = keywords.select("date", F.col("value").alias("keyword")).distinct()
    got = a.join(s, KG, "full_outer").join(listed, KG, "full_outer").fillna(0, ["articles", "summaries"])
    has_a, has_s = F.col("articles") > 0, F.col("summaries") > 0
    status = (F.when(has_a & has_s, STATUS[3]).when(has_a, STATUS[2]).when(has_s, STATUS[1]).otherwise(STATUS[0]))
    return got.withColumn("status", status)
