"""Day keywords, as one Spark plan (K1 -> K19).

documents + events -> slot / title dedup -> sentences -> tokens -> word
graph per article -> TextRank -> top 10 per article -> blacklist -> counts per
slot -> top 30 per slot -> merge -> drop fixed overlap -> DAY / cloud lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.session import co_partition_on_group, cut_lineage, group_partitions
from presswork.functions.stopwords import FUNCTION_WORDS, GENERIC_WORDS
from presswork.operators import graph, keywords as K, vectors as V
from presswork.sources.corpus import corpus_articles, fixed_keywords, text_size


def analysed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 (slot by age, modulo a day) -> K3 (title dedup per slot) -> K4 text."""
    art = corpus_articles(spark, sf_dir).select("id", "title", "content", "ts", "agency")
    art = K.age_slot(art, "ts", wrap=True)
    art = K.dedup_title(art, order=[F.col("id")])
    return K.concat_text(art)


def sentence_tokens(arts: DataFrame, size: int = 0) -> DataFrame:
    """K5 + K6: ``(id, slot, sent, sentence, tokens)``.

    Sentence rows are hash-partitioned by article id once; the word graph,
    its norms and the rank rounds (all keyed by id first) then run without
    further shuffles. ``size``: bytes of the texts; the partitions grow with
    them, so that a task's tables do not.
    """
    spark = arts.sparkSession
    co_partition_on_group(spark)
    s = K.sentence_rows(arts, ["id", "slot"], "text").repartition(group_partitions(spark, size), "id")
    return K.tokens(s, "sentence", stop=FUNCTION_WORDS)


def word_edges(st: DataFrame, digits: int | None = None) -> DataFrame:
    """K7 -> K9: ``(id, src, dst, w)``; ``w`` to ``digits`` digits if given."""
    return V.word_graph(V.sentence_counts(st, "id", "sent"), "id", "sent", digits=digits)


def word_nodes(st: DataFrame) -> DataFrame:
    return V.sentence_counts(st, "id", "sent").select("id", F.col("word").alias("node")).distinct()


def article_ranks(st: DataFrame, top: int | None = None) -> DataFrame:
    """K7 -> K10: ``(id, node, rank)``, the solved ranks of each article's word graph."""
    xn = V.l2_by(V.sentence_counts(st, "id", "sent"), ["id", "word"])
    return graph.text_rank_grouped(xn, "id", "sent", top=top).select("id", F.col("word").alias("node"), "rank")


def article_keywords(st: DataFrame) -> DataFrame:
    """K9 -> K11: top 10 words per article ``(id, pos, word, rank)``. K7/K8 run
    in Spark, the rank rounds of an article in one grouped task on its sparse
    sentence x word table."""
    xn = V.l2_by(V.sentence_counts(st, "id", "sent"), ["id", "word"])
    return graph.text_rank_grouped(xn, "id", "sent", top=10)


def slot_keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K12 + K13: ``(slot, word, cnt)``."""
    arts = analysed_articles(spark, sf_dir)
    st = sentence_tokens(arts, text_size(spark, sf_dir))
    kw = article_keywords(st)
    bl = spark.createDataFrame([(w,) for w in GENERIC_WORDS], "word string")
    kw = K.drop_blacklisted(kw, bl)
    kw = kw.join(arts.select("id", "slot"), "id")
    return K.keyword_counts(kw, ["slot"], "word", "id")


def slot_top30(spark, sf_dir) -> DataFrame:
    """``(slot, day_id, word, cnt)``."""
    return K.slot_top(slot_keyword_counts(spark, sf_dir), 30)


def merged_day(spark, sf_dir) -> DataFrame:
    """K15 -> K16."""
    merged = K.merge_slots(slot_top30(spark, sf_dir))
    return K.drop_fixed_overlap(merged, fixed_keywords(spark, sf_dir))


def day_keywords(spark, sf_dir, n: int = 10) -> DataFrame:
    """``(type_id, value, cnt)``."""
    out = K.day_keywords(merged_day(spark, sf_dir), n)
    return out.select("type_id", F.col("word").alias("value"), "cnt")


def cloud_words(spark, sf_dir, n: int = 15) -> DataFrame:
    """``(day_id, value, cnt)``."""
    out = K.day_keywords(merged_day(spark, sf_dir), n, prefix="DAY_")
    return out.select(F.col("type_id").alias("day_id"), F.col("word").alias("value"), "cnt")


def daily_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 -> K3 with a date key: ``(id, date, slot)`` of the articles that each
    day's run analyses. Ages count back from the end of the day, so articles
    of other days (or of the very midnight before) are in no slot."""
    art = corpus_articles(spark, sf_dir).filter(F.col("ts").isNotNull()).select("id", "date", "title", "ts")
    art = K.age_slot(art, "ts", F.date_add("date", 1).cast("timestamp"))
    return K.dedup_title(art, [F.col("id")], ("date", "slot")).select("id", "date", "slot")


def daily_slot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 -> K13 with a date key: ``(date, slot, word, cnt)``. Ids are chosen
    first and written, so the texts join them once and the words of an article
    find its day and slot again without reading a text."""
    chosen = cut_lineage(daily_articles(spark, sf_dir))
    texts = corpus_articles(spark, sf_dir).select("id", "title", "content").join(chosen.select("id", "slot"), "id")
    kw = article_keywords(sentence_tokens(K.concat_text(texts), text_size(spark, sf_dir)))
    bl = spark.createDataFrame([(w,) for w in GENERIC_WORDS], "word string")
    kw = K.drop_blacklisted(kw, bl).join(chosen, "id")
    return K.keyword_counts(kw, ["date", "slot"], "word", "id")


def daily_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K14 -> K16 with a date key: ``(date, word, cnt)``."""
    top = K.slot_top(daily_slot_counts(spark, sf_dir), 30, by=["date"])
    return K.drop_fixed_overlap(K.merge_slots(top, by=["date"]), fixed_keywords(spark, sf_dir))


def top_words_by_frequency(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    """Minimum J2 slice without the graph: documents -> K5 -> K6 -> K13 -> K17.

    Top ``n`` content words by the number of articles they occur in.
    """
    arts = analysed_articles(spark, sf_dir)
    st = sentence_tokens(arts, text_size(spark, sf_dir))
    words = st.select("id", F.explode("tokens").alias("word"))
    counts = K.keyword_counts(words, [], "word", "id")
    out = K.day_keywords(counts, n)
    return out.select("type_id", F.col("word").alias("value"), "cnt")
