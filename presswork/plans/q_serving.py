"""Registered queries: scans, keyed writes and simple serving views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from presswork.operators.articles import drop_keys, upsert
from presswork.plans import q_combos as J3
from presswork.plans.q_combos import ARTICLES_SQL
from presswork.plans.registry import query
from presswork.session import cut_lineage
from presswork.sources.corpus import date_status, read_articles

NEWEST = "newest AS (SELECT max(date) AS d FROM articles)"


def _newest(arts):
    """The newest date that has articles (one value)."""
    return arts.agg(F.max("date")).first()[0]


@query("s1_articles_of_day", f"""WITH {ARTICLES_SQL}, {NEWEST},
first AS (SELECT keyword FROM kw WHERE kpos < 3)
SELECT keyword, id, title FROM articles WHERE date = (SELECT d FROM newest) AND keyword IN (SELECT keyword FROM first)""")
def s1_articles_of_day(spark, sf):
    """The newest day's articles of the three first fixed keywords."""
    arts = J3.articles_table(spark, sf)
    words = [r["keyword"] for r in J3.crawl_keywords(spark, sf).filter("kpos < 3").collect()]
    return read_articles(arts, _newest(arts), words).select("keyword", "id", "title")


@query("s3_whole_day", f"""WITH {ARTICLES_SQL}, {NEWEST}
SELECT keyword, id, agency FROM articles WHERE date = (SELECT d FROM newest)""")
def s3_whole_day(spark, sf):
    """S3: every article row of the newest day, no matter how many."""
    arts = J3.articles_table(spark, sf)
    return read_articles(arts, _newest(arts)).select("keyword", "id", "agency")


@query("s4_upsert", f"""WITH {ARTICLES_SQL}, {NEWEST}
SELECT date, keyword, id, CASE WHEN date = (SELECT d FROM newest) THEN upper(agency) ELSE agency END AS agency FROM articles""")
def s4_upsert(spark, sf):
    """The newest day written again with other outlet names; the last write of a key stays.
    The table (without texts) is made once, for the newest day and both sides of the upsert."""
    arts = cut_lineage(J3.articles_table(spark, sf).select("date", "keyword", "id", "agency"))
    again = read_articles(arts, _newest(arts)).withColumn("agency", F.upper("agency"))
    return upsert(again, arts, ["date", "keyword", "id"])


@query("s5_drop_keys", f"""WITH {ARTICLES_SQL}, {NEWEST}
SELECT type_id, keyword FROM kw WHERE keyword IN (SELECT keyword FROM articles WHERE date = (SELECT d FROM newest))""")
def s5_drop_keys(spark, sf):
    """S5 as M2 uses it: keywords that retrieved no article on the newest day go."""
    arts = J3.articles_table(spark, sf)
    words = J3.crawl_keywords(spark, sf)
    today = read_articles(arts, _newest(arts)).select("keyword").distinct()
    return drop_keys(words, words.select("keyword").exceptAll(today), ["keyword"]).select("type_id", "keyword")


@query("s8_date_status", f"""WITH {ARTICLES_SQL}, {NEWEST},
days AS (SELECT CAST((SELECT d FROM newest) + CAST(k AS INTEGER) AS DATE) AS date FROM range(-40, 3) t(k))
SELECT date, date IN (SELECT date FROM articles) AS "exists" FROM days""")
def s8_date_status(spark, sf):
    """Which of the days around the stored ones have a partition."""
    arts = J3.articles_table(spark, sf)
    days = (arts.agg(F.max("date").alias("d"))
            .select(F.explode(F.sequence(F.date_sub("d", 40), F.date_add("d", 2))).alias("date")))
    return date_status(arts, days)


@query("v4_bar_data", f"""WITH {ARTICLES_SQL}
SELECT date, keyword, count(*) AS articles,
       CAST(row_number() OVER (PARTITION BY date ORDER BY count(*) DESC, keyword) AS INTEGER) AS bar
FROM articles GROUP BY date, keyword""")
def v4_bar_data(spark, sf):
    """V4: bars of a day, most articles first."""
    n = J3.articles_table(spark, sf).groupBy("date", "keyword").agg(F.count(F.lit(1)).alias("articles"))
    w = Window.partitionBy("date").orderBy(F.desc("articles"), "keyword")
    return n.withColumn("bar", F.row_number().over(w).cast("int"))


@query("v9_thumbnails", f"""WITH {ARTICLES_SQL}
SELECT date, keyword, id, coalesce(thumbnail, '/static/no_image.png') AS thumbnail FROM articles""")
def v9_thumbnails(spark, sf):
    """V9: the default picture where an article has none."""
    a = J3.articles_table(spark, sf)
    return a.select("date", "keyword", "id", F.coalesce("thumbnail", F.lit("/static/no_image.png")).alias("thumbnail"))


KG = ["date", "keyword"]


@query("v1_recent_dates", """WITH d AS (SELECT CAST(max(ts) AS DATE) AS as_of FROM events)
SELECT CAST(as_of - CAST(k AS INTEGER) AS DATE) AS date, CAST(k AS INTEGER) AS days_back
FROM d, range(1, 8) t(k)""")
def v1_recent_dates(spark, sf):
    """V1: the seven dates before the newest event date, newest first."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    as_of = ev.select(F.to_date(F.max(F.col("ts").cast("timestamp"))).alias("as_of"))
    seq = as_of.select(F.posexplode(F.sequence(F.date_sub("as_of", 1), F.date_sub("as_of", 7),
                                               F.expr("INTERVAL -1 DAY"))).alias("p", "date"))
    return seq.select("date", (F.col("p") + 1).cast("int").alias("days_back"))


@query("v8_page_of_articles", f"""WITH {ARTICLES_SQL},
r AS (SELECT date, keyword, id, CAST(row_number() OVER (PARTITION BY date, keyword ORDER BY id) - 1 AS INTEGER) AS pos,
             count(*) OVER (PARTITION BY date, keyword) AS total FROM articles)
SELECT date, keyword, id, CAST(pos // 8 + 1 AS INTEGER) AS page, CAST(ceil(total / 8) AS INTEGER) AS pages FROM r""")
def v8_page_of_articles(spark, sf):
    """V8: page (of 8 articles) of every article and page counts per keyword."""
    a = J3.articles_table(spark, sf)
    w = Window.partitionBy(*KG).orderBy("id")
    a = a.withColumn("pos", (F.row_number().over(w) - 1).cast("int"))
    a = a.withColumn("total", F.count(F.lit(1)).over(Window.partitionBy(*KG)))
    return a.select("date", "keyword", "id", (F.floor(F.col("pos") / 8) + 1).cast("int").alias("page"),
                    F.ceil(F.col("total") / 8).cast("int").alias("pages"))
