"""Registered queries: the keyword jobs with a date key end to end (K1-K16, M1,
M2, S5, J3). Each day's list is its ten DAY words of J2 and the fixed ones."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators import combos as M
from presswork.operators import keywords as K
from presswork.plans import day_keywords as J2
from presswork.plans.q_combos import COMBO_SQL
from presswork.plans.q_day import FIXED_SQL
from presswork.plans.q_site import DAILY_ANALYSED, DAILY_SQL
from presswork.plans.registry import query
from presswork.plans.sql_common import ART
from presswork.session import cut_lineage
from presswork.sources.corpus import corpus_articles, fixed_keywords


class Days:
    """The tables that the daily jobs pass on, each made once."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    @cached_property
    def articles(self) -> DataFrame:
        return corpus_articles(self.spark, self.sf).filter(F.col("date").isNotNull())

    @cached_property
    def table(self) -> DataFrame:
        """The keyword table ``(date, type_id, value)``: DAY and FIX rows of every
        day with articles."""
        day = K.daily_keywords(J2.daily_merged(self.spark, self.sf)).select("date", "type_id", F.col("word").alias("value"))
        listed = fixed_keywords(self.spark, self.sf).agg(F.collect_list(F.struct("type_id", "value"))).scalar()
        fix = self.articles.select("date").distinct().withColumn("listed", listed).select("date", F.inline("listed"))
        return cut_lineage(day.unionByName(fix))

    @cached_property
    def base(self) -> DataFrame:
        return M.daily_base_keywords(self.table)

    @cached_property
    def rows(self) -> DataFrame:
        return cut_lineage(M.daily_retrieved(self.articles, self.base))

    @cached_property
    def live(self) -> DataFrame:
        return M.with_articles(self.base, self.rows)

    def combos(self) -> DataFrame:
        """A word found in an article that was retrieved is live, so the
        matched words of a row are those of the live list."""
        words = F.transform("words", lambda s: s["keyword"])
        pre = M.prefixes_of(self.rows.select("date", "kpos", "id", words.alias("words")))
        return M.rank_combos(M.prune_supersets(M.top_combos(pre, 10)))


TABLE_SQL = f"""dayk AS MATERIALIZED (WITH {DAILY_SQL} SELECT date, word, r FROM day WHERE r < 10),
{ART}, {FIXED_SQL},
ktable AS MATERIALIZED (
  SELECT date, 'DAY_' || CAST(r AS VARCHAR) AS type_id, word AS value FROM dayk
  UNION ALL SELECT date, type_id, value FROM (SELECT DISTINCT date FROM art WHERE date IS NOT NULL), fixed),
kw AS MATERIALIZED (
  SELECT date, type_id, value AS keyword, row_number() OVER (PARTITION BY date ORDER BY type_id) - 1 AS kpos
  FROM (SELECT date, value, min(type_id) AS type_id FROM ktable WHERE NOT contains(type_id, 'MIX') GROUP BY ALL))"""

# the plan of q_combos with the list of each day in place of the one list
_TAIL = (COMBO_SQL[COMBO_SQL.index("hits AS ("):]
         .replace("JOIN kw k ON contains(a.content, k.keyword)\n", "JOIN kw k ON a.date = k.date AND contains(a.content, k.keyword)\n")
         .replace("JOIN kw k ON contains(a.content, k.keyword) GROUP", "JOIN kw k ON a.date = k.date AND contains(a.content, k.keyword) GROUP"))
DAILY_COMBO_SQL = f"{TABLE_SQL},\n{_TAIL}"
LIVE_SQL = "live AS (SELECT k.* FROM kw k WHERE EXISTS (SELECT 1 FROM articles a WHERE a.date = k.date AND a.keyword = k.keyword))"


@query("k3_daily_titles", f"WITH {ART}, {DAILY_ANALYSED} SELECT id, date, slot FROM analysed")
def k3_daily_titles(spark, sf):
    """K1 and K3 of every day's run: articles older than the day are excluded."""
    return J2.daily_articles(spark, sf)


@query("k14_daily_slot_top", f"WITH {DAILY_SQL} SELECT date, slot, day_id, word, cnt FROM slot_top")
def k14_daily_slot_top(spark, sf):
    return K.slot_top(J2.daily_slot_counts(spark, sf), 30, by=["date"]).select("date", "slot", "day_id", "word", "cnt")


@query("k16_daily_merged", f"WITH {DAILY_SQL} SELECT date, word, cnt FROM day")
def k16_daily_merged(spark, sf):
    return J2.daily_merged(spark, sf).select("date", "word", "cnt")


@query("m1_daily_keywords", f"WITH {TABLE_SQL} SELECT date, type_id, keyword, CAST(kpos AS INTEGER) AS kpos FROM kw")
def m1_daily_keywords(spark, sf):
    return Days(spark, sf).base.select("date", "type_id", "keyword", "kpos")


@query("m2_daily_live", f"WITH {DAILY_COMBO_SQL}, {LIVE_SQL} SELECT date, type_id, keyword FROM live")
def m2_daily_live(spark, sf):
    return Days(spark, sf).live.select("date", "type_id", "keyword")


@query("s5_drop_dead_keywords", f"""WITH {DAILY_COMBO_SQL}, {LIVE_SQL}
SELECT date, type_id, value FROM ktable t WHERE EXISTS (SELECT 1 FROM live l WHERE l.date = t.date AND l.keyword = t.value)""")
def s5_drop_dead_keywords(spark, sf):
    days = Days(spark, sf)
    return M.drop_dead(days.table, days.base, days.live)


@query("j3_daily_combos", f"WITH {DAILY_COMBO_SQL} SELECT date, mix_id, value, rank, cnt FROM combos")
def j3_daily_combos(spark, sf):
    """J3 on each day's DAY and FIX words."""
    return Days(spark, sf).combos()
