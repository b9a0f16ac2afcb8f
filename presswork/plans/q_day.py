"""Registered queries: day keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.operators import keywords as K
from presswork.operators import vectors as V
from presswork.plans import day_keywords as J2
from presswork.plans.registry import query
from presswork.plans.sql_common import (ANALYSED, ART, DAY_TOKENS, GENERIC, HOURS, WORD,
                                        text_rank_ctes)
from presswork.sources.corpus import corpus_articles, fixed_keywords, text_size

#: Rounds of the SQL side: more of them change no digit of the results.
R = 200

FIXED_SQL = f"""fixed AS (
  SELECT 'FIX_' || CAST(row_number() OVER (ORDER BY cnt DESC, value) - 1 AS VARCHAR) AS type_id,
         CAST(row_number() OVER (ORDER BY cnt DESC, value) - 1 AS INTEGER) AS rank, value, cnt
  FROM (SELECT value, count(*) AS cnt
        FROM (SELECT unnest(regexp_extract_all(lower(text), '{WORD}')) AS value FROM benchmark)
        WHERE length(value) >= 4 GROUP BY value ORDER BY cnt DESC, value LIMIT 10))"""


@query("s9_fixed_keywords", f"WITH {FIXED_SQL} SELECT type_id, rank, value, cnt FROM fixed")
def s9_fixed_keywords(spark, sf):
    return fixed_keywords(spark, sf).select("type_id", "rank", "value", "cnt")


@query("k1_age_slot", f"""WITH {ART}
SELECT id, h AS hours, slot FROM (
  SELECT id, h, CASE WHEN h IS NULL OR h < 0 OR h > 23 THEN NULL WHEN h >= 22 THEN 5
    WHEN h >= 18 THEN 4 WHEN h >= 14 THEN 3 WHEN h >= 10 THEN 2 WHEN h >= 6 THEN 1 ELSE 0 END AS slot
  FROM (SELECT id, (({HOURS} % 24) + 24) % 24 AS h FROM art))""")
def k1_age_slot(spark, sf):
    art = corpus_articles(spark, sf)
    as_of = art.select(F.max("ts")).scalar()
    h = K.age_hours("ts", as_of, wrap=True)
    return art.select("id", h.alias("hours"), K.slot_of_age(h).alias("slot"))


@query("k2_parse_age", f"""WITH {ART}, ages AS (
  SELECT id, CASE WHEN h = 0 THEN CAST(m AS VARCHAR) || '분전' ELSE CAST(h AS VARCHAR) || '시간전' END AS age_text
  FROM (SELECT id, (({HOURS} % 24) + 24) % 24 AS h,
               CAST(floor((epoch_us((SELECT max(ts) FROM art)) - epoch_us(ts)) / 60000000.0) AS BIGINT) % 60 AS m
        FROM art WHERE ts IS NOT NULL))
SELECT id, age_text, CAST(nullif(regexp_extract(age_text, '^(\\d+)시간전', 1), '') AS INTEGER) AS age_hours
FROM ages""")
def k2_parse_age(spark, sf):
    """Age texts rendered from the article ages ("N시간전", or "M분전" in the
    first hour), parsed back with K2."""
    art = corpus_articles(spark, sf).filter(F.col("ts").isNotNull())
    as_of = art.select(F.max("ts")).scalar()
    h = K.age_hours("ts", as_of, wrap=True)
    m = F.pmod(F.floor((F.unix_micros(as_of) - F.unix_micros("ts")) / F.lit(60_000_000)).cast("long"), F.lit(60))
    txt = F.when(h == 0, F.concat(m.cast("string"), F.lit("분전"))).otherwise(
        F.concat(h.cast("string"), F.lit("시간전")))
    out = art.select("id", txt.alias("age_text"))
    return out.select("id", "age_text", K.parse_age("age_text").alias("age_hours"))


@query("k3_dedup_title", f"WITH {ART}, {ANALYSED} SELECT id, slot, title FROM analysed")
def k3_dedup_title(spark, sf):
    return J2.analysed_articles(spark, sf).select("id", "slot", "title")


@query("k5_sentences", f"WITH {DAY_TOKENS} SELECT id, sent, sentence FROM tok")
def k5_sentences(spark, sf):
    return J2.sentence_tokens(J2.analysed_articles(spark, sf), text_size(spark, sf)).select("id", "sent", "sentence")


@query("k6_tokens", f"WITH {DAY_TOKENS} SELECT id, sent, array_to_string(tokens, ' ') AS tokens FROM tok")
def k6_tokens(spark, sf):
    st = J2.sentence_tokens(J2.analysed_articles(spark, sf), text_size(spark, sf))
    return st.select("id", "sent", F.array_join("tokens", " ").alias("tokens"))


@query("k7_sentence_counts", f"WITH {DAY_TOKENS} SELECT id, sent, word, c FROM cnt")
def k7_sentence_counts(spark, sf):
    st = J2.sentence_tokens(J2.analysed_articles(spark, sf), text_size(spark, sf))
    return V.sentence_counts(st, "id", "sent").select("id", "sent", "word", "c")


@query("k8_l2_norm", f"WITH {DAY_TOKENS} SELECT id, sent, word, round(x, 6) AS x FROM xn")
def k8_l2_norm(spark, sf):
    st = J2.sentence_tokens(J2.analysed_articles(spark, sf), text_size(spark, sf))
    x = V.l2_by(V.sentence_counts(st, "id", "sent"), ["id", "word"])
    return x.select("id", "sent", "word", F.round("x", 6).alias("x"))


@query("k9_word_graph", f"WITH {DAY_TOKENS} SELECT id, src, dst, round(w, 6) AS w FROM edges")
def k9_word_graph(spark, sf):
    st = J2.sentence_tokens(J2.analysed_articles(spark, sf), text_size(spark, sf))
    return J2.word_edges(st, digits=6)


K10_SQL = (f"WITH {DAY_TOKENS}, {text_rank_ctes(R)}\n"
           f"SELECT id, node, round(round(x, 9), 6) AS rank FROM r{R}")


@query("k10_text_rank", K10_SQL)
def k10_text_rank(spark, sf):
    st = J2.sentence_tokens(J2.analysed_articles(spark, sf), text_size(spark, sf))
    return J2.article_ranks(st)


K11_CTE = f"""{text_rank_ctes(R)},
top AS (
  SELECT id, CAST(pos AS INTEGER) AS pos, node AS word, round(round(x, 9), 6) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(round(x, 9), 6) DESC, node) - 1 AS pos FROM r{R})
  WHERE pos < 10)"""


@query("k11_top_words", f"WITH {DAY_TOKENS}, {K11_CTE} SELECT id, pos, word, rank FROM top")
def k11_top_words(spark, sf):
    st = J2.sentence_tokens(J2.analysed_articles(spark, sf), text_size(spark, sf))
    return J2.article_keywords(st)


K13_CTE = f"""{K11_CTE},
kept AS (SELECT * FROM top WHERE NOT list_contains({GENERIC}, word)),
slot_counts AS (
  SELECT a.slot, k.word, count(DISTINCT k.id) AS cnt FROM kept k JOIN analysed a ON a.id = k.id GROUP BY ALL)"""


@query("k13_slot_counts", f"WITH {DAY_TOKENS}, {K13_CTE} SELECT slot, word, cnt FROM slot_counts")
def k13_slot_counts(spark, sf):
    return J2.slot_keyword_counts(spark, sf).select("slot", "word", "cnt")


K14_CTE = f"""{K13_CTE},
slot_top AS (
  SELECT slot, 'DAY_' || CAST(slot * 30 + rn - 1 AS VARCHAR) AS day_id, word, cnt FROM (
    SELECT *, row_number() OVER (PARTITION BY slot ORDER BY cnt DESC, word) AS rn FROM slot_counts)
  WHERE rn <= 30)"""


@query("k14_slot_top", f"WITH {DAY_TOKENS}, {K14_CTE} SELECT slot, day_id, word, cnt FROM slot_top")
def k14_slot_top(spark, sf):
    return J2.slot_top30(spark, sf).select("slot", "day_id", "word", "cnt")


K16_CTE = f"""{K14_CTE}, {FIXED_SQL},
merged AS (SELECT word, sum(cnt) AS cnt FROM slot_top GROUP BY word),
day AS (SELECT * FROM merged m WHERE NOT EXISTS (SELECT 1 FROM fixed f WHERE contains(m.word, f.value)))"""


@query("k15_merge_slots", f"WITH {DAY_TOKENS}, {K14_CTE} SELECT word, sum(cnt) AS cnt FROM slot_top GROUP BY word")
def k15_merge_slots(spark, sf):
    return K.merge_slots(J2.slot_top30(spark, sf)).select("word", "cnt")


@query("k16_drop_fixed_overlap", f"WITH {DAY_TOKENS}, {K16_CTE} SELECT word, cnt FROM day")
def k16_drop_fixed_overlap(spark, sf):
    return J2.merged_day(spark, sf).select("word", "cnt")


def _top_sql(n: int, id_name: str) -> str:
    return (f"WITH {DAY_TOKENS}, {K16_CTE}\n"
            f"SELECT 'DAY_' || CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS VARCHAR) AS {id_name}, "
            f"word AS value, cnt FROM (SELECT * FROM day ORDER BY cnt DESC, word LIMIT {n})")


@query("k17_day_keywords", _top_sql(10, "type_id"))
def k17_day_keywords(spark, sf):
    return J2.day_keywords(spark, sf)


@query("k18_cloud_words", _top_sql(15, "day_id"))
def k18_cloud_words(spark, sf):
    return J2.cloud_words(spark, sf)


@query("k19_slot_articles", f"WITH {ART}, {ANALYSED} SELECT slot, count(DISTINCT id) AS articles FROM analysed GROUP BY slot")
def k19_slot_articles(spark, sf):
    return K.slot_articles(J2.analysed_articles(spark, sf))


@query("j2_top_words_by_frequency", f"""WITH {DAY_TOKENS},
df AS (SELECT word, count(DISTINCT id) AS cnt FROM (SELECT id, unnest(tokens) AS word FROM tok) GROUP BY word)
SELECT 'DAY_' || CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS VARCHAR) AS type_id, word AS value, cnt
FROM (SELECT * FROM df ORDER BY cnt DESC, word LIMIT 10)""")
def j2_top_words_by_frequency(spark, sf):
    return J2.top_words_by_frequency(spark, sf)
