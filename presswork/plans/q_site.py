"""Registered queries: the date page and the keyword page (V2, V3, V5-V8, V10,
J7) on stored tables, and day keywords with a date key (J2 for every day)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators import keywords as K
from presswork.operators import serving as W
from presswork.plans import day_keywords as J2
from presswork.plans.q_cluster import EMIT_SQL, Clustering
from presswork.plans.q_combos import ARTICLES_SQL
from presswork.plans.q_day import FIXED_SQL, K14_CTE
from presswork.plans.q_stream import scratch
from presswork.plans.q_summary import J5_SQL, KSENT_SQL, combo_summaries, keyword_summaries
from presswork.plans.registry import query
from presswork.plans.sql_common import ANALYSED, DAY_TOKENS, SLOT
from presswork.session import cut_lineage
from presswork.sources.corpus import fixed_keywords
from presswork.sources.sinks import write_partitions

KG = W.KG


class Site:
    """The stored tables behind the pages, each written once, partitioned by
    date and sorted by its key."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf, self.top = spark, sf, scratch(spark, "site")
        self.clustering = Clustering(spark, sf)

    def stored(self, df: DataFrame, name: str, sort: list[str]) -> DataFrame:
        write_partitions(df, f"{self.top}/{name}", sort=sort)
        return self.spark.read.schema(df.schema).parquet(f"{self.top}/{name}").select(*df.columns)

    @cached_property
    def articles(self) -> DataFrame:
        titles = self.clustering.articles.select("date", "id", "title", "thumbnail")
        rows = self.clustering.rows.select("date", "keyword", "id", "agency").join(titles, ["date", "id"])
        return self.stored(rows.select("date", "keyword", "id", "agency", "title", "thumbnail"), "articles", ["keyword", "id"])

    @cached_property
    def clusters(self) -> DataFrame:
        rows = self.clustering.cluster_articles().select("date", "row_key", "combo", "n", "id", "title", "content", "thumbnail", "label", "keyword_id")
        return self.stored(rows, "clusters", ["row_key"])

    @cached_property
    def day(self) -> DataFrame:
        return cut_lineage(J2.daily_merged(self.spark, self.sf))

    @cached_property
    def keywords(self) -> DataFrame:
        """``(date, type_id, value)``: FIX and DAY words of every day with
        articles, and MIX of the combos that J4 emitted."""
        day = K.daily_keywords(self.day).select("date", "type_id", F.col("word").alias("value"))
        listed = fixed_keywords(self.spark, self.sf).agg(F.collect_list(F.struct("type_id", "value"))).scalar()
        fix = self.day.select("date").distinct().withColumn("listed", listed).select("date", F.inline("listed"))
        mix = self.clusters.select("date", F.col("keyword_id").alias("type_id"), F.col("combo").alias("value")).distinct()
        return self.stored(day.unionByName(fix).unionByName(mix), "keywords", ["type_id"])

    @cached_property
    def cloud(self) -> DataFrame:
        words = K.daily_keywords(self.day, 15)
        return self.stored(words.select("date", F.col("type_id").alias("day_id"), F.col("word").alias("value"), "cnt"), "cloud", ["day_id"])

    @cached_property
    def summaries(self) -> DataFrame:
        one = keyword_summaries(self.spark, self.sf, self.clustering).select("date", "keyword", "summary")
        return self.stored(one.unionByName(combo_summaries(self.spark, self.sf, self.clustering)), "summaries", ["keyword"])

    @cached_property
    def retrieved(self) -> DataFrame:
        """Rows that a keyword's page lists: articles or cluster rows."""
        return self.articles.select(*KG, "id").unionByName(self.clusters.select("date", F.col("combo").alias("keyword"), "id"))


# ----------------------------------------------------------------------------
# the SQL side

DAILY_ANALYSED = f"""analysed AS (
  SELECT id, date, slot, coalesce(title, '') || coalesce(content, '') AS text FROM (
    SELECT *, row_number() OVER (PARTITION BY date, slot, title ORDER BY id) AS rn FROM (
      SELECT *, {SLOT} AS slot FROM (
        SELECT *, CAST(floor((epoch_us(CAST(date + 1 AS TIMESTAMP)) - epoch_us(ts)) / 3600000000.0) AS BIGINT) AS h FROM art WHERE ts IS NOT NULL))
    WHERE slot IS NOT NULL) WHERE rn = 1)"""

# the day's run of q_day with date keys added
DAILY_SQL = (DAY_TOKENS.replace(ANALYSED, DAILY_ANALYSED) + ", " + K14_CTE
             .replace("SELECT a.slot, k.word", "SELECT a.date, a.slot, k.word")
             .replace("SELECT slot, 'DAY_'", "SELECT date, slot, 'DAY_'").replace("PARTITION BY slot", "PARTITION BY date, slot")
             + f""", {FIXED_SQL},
merged AS (SELECT date, word, sum(cnt) AS cnt FROM slot_top GROUP BY date, word),
day AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY cnt DESC, word) - 1 AS r
        FROM merged m WHERE NOT EXISTS (SELECT 1 FROM fixed f WHERE contains(m.word, f.value)))""")

KEYWORDS_SQL = f"""dayk AS MATERIALIZED (WITH {DAILY_SQL} SELECT date, word, cnt, r FROM day),
fixk AS (WITH {FIXED_SQL} SELECT type_id, value FROM fixed),
emit AS MATERIALIZED (WITH RECURSIVE {EMIT_SQL} SELECT date, combo, label, n, id, k FROM emitted),
keyword AS MATERIALIZED (
  SELECT date, 'DAY_' || CAST(r AS VARCHAR) AS type_id, word AS value, r AS p FROM dayk WHERE r < 10
  UNION ALL SELECT date, type_id, value, CAST(split_part(type_id, '_', 2) AS BIGINT) FROM (SELECT DISTINCT date FROM dayk), fixk
  UNION ALL SELECT DISTINCT date, 'MIX_' || CAST(k AS VARCHAR), combo, k FROM emit)"""

TITLED = "(SELECT doc_id AS id, split_part(text, chr(10), 1) AS title FROM documents)"
PAGES_SQL = f"""{KEYWORDS_SQL},
arts AS MATERIALIZED (WITH {ARTICLES_SQL} SELECT date, keyword, id FROM articles),
summ AS MATERIALIZED (
  SELECT DISTINCT date, keyword FROM (WITH {KSENT_SQL} SELECT date, keyword FROM sent WHERE len(tokens) > 0)
  UNION ALL SELECT date, keyword FROM (WITH RECURSIVE {J5_SQL} SELECT date, keyword FROM j5)),
na AS (SELECT date, keyword, count(*) AS articles FROM (SELECT * FROM arts UNION ALL SELECT date, combo, id FROM emit) GROUP BY ALL),
status AS (
  SELECT date, keyword, coalesce(articles, 0) AS articles, coalesce(s.n, 0) AS summaries,
         CASE WHEN articles > 0 AND s.n > 0 THEN 'ok' WHEN articles > 0 THEN 'no summary' WHEN s.n > 0 THEN 'no articles' ELSE 'nothing' END AS status
  FROM na FULL JOIN (SELECT date, keyword, count(*) AS n FROM summ GROUP BY ALL) s USING (date, keyword)
          FULL JOIN (SELECT DISTINCT date, value AS keyword FROM keyword) k USING (date, keyword))"""


@query("j2_daily_keywords", f"""WITH {DAILY_SQL}
SELECT date, 'DAY_' || CAST(r AS VARCHAR) AS type_id, word AS value, cnt FROM day WHERE r < 10""")
def j2_daily_keywords(spark, sf):
    """J2 with a date key: each day's ten keywords."""
    out = K.daily_keywords(J2.daily_merged(spark, sf))
    return out.select("date", "type_id", F.col("word").alias("value"), "cnt")


@query("v2_day_overview", f"""WITH {KEYWORDS_SQL}, days AS (
  SELECT CAST(unnest(generate_series(min(date) - 2, max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM dayk),
l AS (SELECT date, string_agg(value, ' ' ORDER BY p) FILTER (starts_with(type_id, 'FIX')) AS fix,
             string_agg(value, ' ' ORDER BY p) FILTER (starts_with(type_id, 'DAY')) AS day,
             string_agg(value, ' ' ORDER BY p) FILTER (starts_with(type_id, 'MIX')) AS mix FROM keyword GROUP BY ALL)
SELECT date, coalesce(fix, '') AS fix, coalesce(day, '') AS day, coalesce(mix, '') AS mix, coalesce(fix, day, mix) IS NULL AS missing
FROM days LEFT JOIN l USING (date)""")
def v2_day_overview(spark, sf):
    """V2: every day from two before the first to the last, empty ones flagged."""
    site = Site(spark, sf)
    days = site.day.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(F.explode(F.sequence(F.date_sub("a", 2), "b")).alias("date"))
    out = W.day_overview(days, site.keywords)
    return out.select("date", *(F.array_join(c, " ").alias(c) for c in ("fix", "day", "mix")), "missing")


@query("v3_cloud_freq", f"""WITH {DAILY_SQL} SELECT date, word AS value, CAST(cnt AS INTEGER) AS cnt FROM day WHERE r < 15""")
def v3_cloud_freq(spark, sf):
    return W.cloud_freq(Site(spark, sf).cloud)


@query("v5_keyword_detail", f"""WITH {KEYWORDS_SQL},
arts AS (WITH {ARTICLES_SQL} SELECT date, keyword, id FROM articles),
asked AS (SELECT DISTINCT date, value AS keyword FROM keyword)
SELECT date, keyword, 'article' AS kind, CAST(row_number() OVER (PARTITION BY date, keyword ORDER BY id) - 1 AS INTEGER) AS pos, id, title
FROM arts JOIN asked USING (date, keyword) JOIN {TITLED} t USING (id) WHERE NOT contains(keyword, '&')
UNION ALL SELECT e.date, e.combo, 'cluster', e.n, id, title FROM emit e JOIN {TITLED} t USING (id)
WHERE (e.date, e.combo) IN (SELECT date, keyword FROM asked) AND contains(e.combo, '&')""")
def v5_keyword_detail(spark, sf):
    """V5: what the page of each keyword of each day lists."""
    site = Site(spark, sf)
    return W.keyword_details(site.articles, site.clusters, site.keywords)


@query("v6_by_prefix", f"""WITH RECURSIVE {EMIT_SQL},
pick AS (SELECT date, split_part(combo, '&', 1) AS text FROM emitted ORDER BY date DESC, combo LIMIT 1)
SELECT date, combo || '_' || CAST(n AS VARCHAR) AS row_key, id FROM emitted
WHERE date = (SELECT date FROM pick) AND starts_with(combo || '_' || CAST(n AS VARCHAR), (SELECT text FROM pick))""")
def v6_by_prefix(spark, sf):
    """V6: the newest day's cluster rows under the first word of its first combo."""
    clusters = Site(spark, sf).clusters
    first = clusters.orderBy(F.desc("date"), "combo").select("date", F.split("combo", "&")[0].alias("text")).first()
    if first is None:
        return clusters.select("date", "row_key", "id")
    return W.by_prefix(clusters, first.date, first.text, exact=False).select("date", "row_key", "id")


@query("v7_summary_rows", f"""WITH RECURSIVE {J5_SQL},
cut7 AS (SELECT date, keyword, unnest(string_split(summary, '^^^')) AS sentence, generate_subscripts(string_split(summary, '^^^'), 1) - 1 AS pos FROM j5)
SELECT date, keyword, CAST(pos AS INTEGER) AS pos, sentence FROM cut7 WHERE length(sentence) > 0""")
def v7_summary_rows(spark, sf):
    return W.summary_rows(combo_summaries(spark, sf))


@query("v8_clamped_page", f"""WITH {ARTICLES_SQL},
r AS (SELECT date, keyword, id, row_number() OVER (PARTITION BY date, keyword ORDER BY id) - 1 AS pos,
             CAST(ceil(count(*) OVER (PARTITION BY date, keyword) / 8) AS INTEGER) AS pages, kpos FROM articles)
SELECT date, keyword, id, greatest(1, least(kpos * 3 - 2, pages)) AS page, pages FROM r
WHERE pos // 8 + 1 = greatest(1, least(kpos * 3 - 2, pages))""")
def v8_clamped_page(spark, sf):
    """V8: page -2 of the first keyword, 1 of the second, 4 of the third ...: where
    a keyword has no such page its first or last."""
    rows = Clustering(spark, sf).rows.select(*KG, "id", "kpos")
    return W.page(rows, F.col("kpos") * 3 - 2, ["id"]).select(*KG, "id", "page", "pages")


@query("v10_keyword_status", f"WITH {PAGES_SQL} SELECT date, keyword, articles, summaries, status FROM status")
def v10_keyword_status(spark, sf):
    site = Site(spark, sf)
    return W.keyword_status(site.keywords, site.retrieved, site.summaries)


@query("j7_pages", f"""WITH {PAGES_SQL}
SELECT date, type_id, value AS keyword, status, articles, CAST(ceil(articles / 8) AS INTEGER) AS pages
FROM keyword JOIN (SELECT date, keyword AS value, status, articles FROM status) USING (date, value)""")
def j7_pages(spark, sf):
    """The links of each date page with the state and length of the page behind each."""
    site = Site(spark, sf)
    state = W.keyword_status(site.keywords, site.retrieved, site.summaries)
    links = site.keywords.select("date", "type_id", F.col("value").alias("keyword"))
    return links.join(state, KG).select("date", "type_id", "keyword", "status", "articles", F.ceil(F.col("articles") / 8).cast("int").alias("pages"))
