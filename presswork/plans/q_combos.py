"""Registered queries: per-day article table and composite keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.operators import combos as M
from presswork.operators.articles import assign_ids, slot_of
from presswork.plans.q_day import FIXED_SQL
from presswork.plans.registry import query
from presswork.plans.sql_common import ART
from presswork.sources.corpus import corpus_articles, document_articles, fixed_keywords, with_times


def crawl_keywords(spark, sf) -> DataFrame:
    """M1: the base keyword list ``(type_id, keyword, kpos)`` (the fixed list)."""
    k = fixed_keywords(spark, sf)
    return M.base_keywords(k).select("type_id", F.col("value").alias("keyword"),
                                     F.col("rank").alias("kpos"))


def articles_table(spark, sf) -> DataFrame:
    """Per-day article table ``(date, keyword, kpos, id, title, content, thumbnail, agency)``."""
    art = document_articles(spark, sf)
    return M.keyword_articles(art, crawl_keywords(spark, sf), dated=lambda found: with_times(found, sf)).select(
        "date", "keyword", "kpos", "id", "title", "content", "thumbnail", "agency")


def combos(spark, sf) -> DataFrame:
    """``(date, mix_id, value, rank, cnt)``."""
    arts = articles_table(spark, sf)
    pre = M.prefix_itemsets(arts, crawl_keywords(spark, sf))
    return M.rank_combos(M.prune_supersets(M.top_combos(pre, 10)))


ARTICLES_SQL = f"""{ART}, {FIXED_SQL},
kw AS (SELECT type_id, value AS keyword, rank AS kpos FROM fixed WHERE NOT contains(type_id, 'MIX')),
hits AS (SELECT a.*, k.keyword, k.kpos FROM art a JOIN kw k ON contains(a.content, k.keyword)
         WHERE a.content IS NOT NULL AND a.date IS NOT NULL),
rep AS (SELECT *, lag(content) OVER (PARTITION BY date, keyword, agency ORDER BY id) AS prev FROM hits),
kept AS (SELECT * FROM rep WHERE NOT (thumbnail IS NULL AND prev IS NOT NULL AND content = prev)),
articles AS (
  SELECT date, keyword, kpos, id, title, content, thumbnail, agency FROM (
    SELECT *, row_number() OVER (PARTITION BY date, keyword, agency ORDER BY id) AS rn FROM kept)
  WHERE rn <= 30)"""

COMBO_SQL = f"""{ARTICLES_SQL},
matched AS (
  SELECT a.date, a.keyword AS rkw, a.kpos, a.id, list(k.keyword ORDER BY k.kpos) AS words
  FROM articles a JOIN kw k ON contains(a.content, k.keyword) GROUP BY ALL),
prefixes AS (
  SELECT date, words[1:2] AS combo, 2 AS size, kpos, id FROM matched WHERE len(words) >= 2
  UNION ALL
  SELECT date, words[1:3] AS combo, 3 AS size, kpos, id FROM matched WHERE len(words) >= 3),
agg AS (
  SELECT date, combo, count(*) AS cnt, min((kpos, CAST(id AS VARCHAR), size)) AS first
  FROM prefixes GROUP BY date, combo),
top AS (
  SELECT date, combo, cnt, top_pos FROM (
    SELECT *, row_number() OVER (PARTITION BY date ORDER BY cnt DESC, first) - 1 AS top_pos FROM agg)
  WHERE top_pos < 10),
pruned AS (
  SELECT * FROM top t WHERE NOT EXISTS (
    SELECT 1 FROM top o WHERE o.date = t.date AND array_to_string(o.combo, ' ') <> array_to_string(t.combo, ' ')
      AND contains(array_to_string(t.combo, ' '), array_to_string(o.combo, ' ')))),
combos AS (
  SELECT date, 'MIX_' || CAST(rank AS VARCHAR) AS mix_id,
         replace(trim(array_to_string(combo, ' ')), ' ', '&') AS value, rank, cnt
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY date ORDER BY top_pos) - 1 AS INTEGER) AS rank FROM pruned))"""


@query("m1_base_keywords", f"WITH {FIXED_SQL} SELECT type_id, value AS keyword, rank AS kpos FROM fixed WHERE NOT contains(type_id, 'MIX')")
def m1_base_keywords(spark, sf):
    return crawl_keywords(spark, sf)


@query("m3_contains_join", f"""WITH {ART}, {FIXED_SQL},
kw AS (SELECT value AS keyword, rank AS kpos FROM fixed)
SELECT a.id, k.keyword FROM art a JOIN kw k ON contains(a.content, k.keyword)""")
def m3_contains_join(spark, sf):
    art = corpus_articles(spark, sf)
    return M.contains_join(art, crawl_keywords(spark, sf)).select("id", "keyword")


@query("e15_e16_article_table", f"WITH {ARTICLES_SQL} SELECT date, keyword, kpos, id, agency FROM articles")
def e15_e16_article_table(spark, sf):
    return articles_table(spark, sf).select("date", "keyword", "kpos", "id", "agency")


@query("m2_live_keywords", f"WITH {ARTICLES_SQL} SELECT DISTINCT date, keyword, kpos FROM articles")
def m2_live_keywords(spark, sf):
    return M.live_keywords(articles_table(spark, sf))


@query("m4_prefix_itemsets", f"""WITH {COMBO_SQL}
SELECT date, array_to_string(combo, ' ') AS combo, count(*) AS cnt FROM prefixes GROUP BY ALL""")
def m4_prefix_itemsets(spark, sf):
    pre = M.prefix_itemsets(articles_table(spark, sf), crawl_keywords(spark, sf))
    return (pre.groupBy("date", F.array_join("combo", " ").alias("combo"))
            .agg(F.count(F.lit(1)).alias("cnt")))


@query("m5_top_combos", f"""WITH {COMBO_SQL}
SELECT date, array_to_string(combo, ' ') AS combo, cnt, CAST(top_pos AS INTEGER) AS top_pos FROM top""")
def m5_top_combos(spark, sf):
    pre = M.prefix_itemsets(articles_table(spark, sf), crawl_keywords(spark, sf))
    t = M.top_combos(pre, 10)
    return t.select("date", F.array_join("combo", " ").alias("combo"), "cnt", "top_pos")


@query("m6_prune_supersets", f"""WITH {COMBO_SQL}
SELECT date, array_to_string(combo, ' ') AS combo, cnt FROM pruned""")
def m6_prune_supersets(spark, sf):
    pre = M.prefix_itemsets(articles_table(spark, sf), crawl_keywords(spark, sf))
    t = M.prune_supersets(M.top_combos(pre, 10))
    return t.select("date", F.array_join("combo", " ").alias("combo"), "cnt")


@query("j3_combos", f"WITH {COMBO_SQL} SELECT date, mix_id, value, rank, cnt FROM combos")
def j3_combos(spark, sf):
    return combos(spark, sf)


@query("e18_e19_ids_and_slots", f"""WITH {FIXED_SQL}
SELECT type_id, value, CAST(floor(rank / 3) AS INTEGER) AS run_slot, CAST(floor(rank / 5) AS INTEGER) AS half
FROM fixed""")
def e18_e19_ids_and_slots(spark, sf):
    k = fixed_keywords(spark, sf)
    return k.select("type_id", "value", slot_of("rank", 3).alias("run_slot"), slot_of("rank", 5).alias("half"))
