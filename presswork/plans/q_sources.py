"""Registered queries: keyword lists by kind, stop words, off-topic keywords."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from presswork.functions.text import word_tokens
from presswork.operators.articles import offtopic_keywords
from presswork.operators.combos import contains_join
from presswork.plans import q_combos as J3
from presswork.plans.q_day import FIXED_SQL
from presswork.plans.q_site import KEYWORDS_SQL, Site
from presswork.plans.q_stream import scratch
from presswork.plans.registry import query
from presswork.plans.sql_common import ART, WORD
from presswork.sources.corpus import corpus_articles, read_keywords, read_stopwords, table


@query("s2_keywords_of_kind", f"WITH {KEYWORDS_SQL} SELECT date, type_id, value FROM keyword WHERE starts_with(type_id, 'DAY')")
def s2_keywords_of_kind(spark, sf):
    """The DAY words of the stored keyword table."""
    return read_keywords(Site(spark, sf).keywords, kind="DAY").select("date", "type_id", "value")


@query("s6_stopwords", f"""SELECT word FROM (
  SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS r
  FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '{WORD}')) AS word FROM documents) GROUP BY lang, word)
WHERE r <= 20 GROUP BY word""")
def s6_stopwords(spark, sf):
    """A stop list as text, a line a language with its 20 most frequent words, read back."""
    path = f"{scratch(spark, 'stop')}/words"
    words = table(spark, sf, "documents").select("lang", F.explode(word_tokens(F.lower("text"))).alias("word"))
    n = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    top = n.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where("r <= 20")
    top.groupBy("lang").agg(F.array_join(F.collect_list("word"), " ").alias("value")).select("value").write.text(path)
    return read_stopwords(spark, path)


@query("e17_offtopic_keywords", f"""WITH {ART}, {FIXED_SQL},
per AS (SELECT f.value AS keyword, agency, count(*) AS n FROM art JOIN fixed f ON contains(content, f.value)
        WHERE category IS DISTINCT FROM 'en' GROUP BY ALL)
SELECT keyword FROM per WHERE n > 3 GROUP BY keyword HAVING count(*) >= 3""")
def e17_offtopic_keywords(spark, sf):
    """Keywords with more than three articles of another category at three or more outlets."""
    art = corpus_articles(spark, sf).where("content is not null and not (category <=> 'en')")
    return offtopic_keywords(contains_join(art, J3.crawl_keywords(spark, sf)), n=3)
