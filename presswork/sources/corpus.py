"""Driver tables and the article model derived from them.

Mapping (see README): ``documents`` rows are articles (id = doc_id, outlet =
source, category = lang, title = first line), publish time is
``events.ts`` of the event with ``event_id = doc_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.text import word_tokens

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def title_of(text) -> F.Column:
    """Title = text before the first newline, whole."""
    return F.substring_index(text, "\n", 1)


def document_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article rows without their publish time: id, title, content, thumbnail, url, agency, category."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        title_of(F.col("text")).alias("title"),
        F.col("text").alias("content"),
        F.lit(None).cast("string").alias("thumbnail"),
        F.lit(None).cast("string").alias("url"),
        F.col("source").alias("agency"),
        F.col("lang").alias("category"))


def with_times(articles: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ts and date: equi-join with the publish events (both large: shuffled
    sort-merge join on the id; the event side is pruned to two columns)."""
    ev = table(articles.sparkSession, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"))
    return articles.join(ev, "id", "left").withColumn("date", F.to_date("ts"))


def corpus_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article rows: id, title, content, thumbnail, url, agency, category, ts, date."""
    return with_times(document_articles(spark, sf_dir), sf_dir)


def text_size(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the texts of ``documents``."""
    return table(spark, sf_dir, "documents").select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def fixed_keywords(spark: SparkSession, sf_dir: str, n: int = 10,
                   min_len: int = 4) -> DataFrame:
    """The official keyword list, first ``n`` by rank.

    The list is taken from ``benchmark``: its ``n`` most frequent lower-case
    words of ``min_len``+ letters (ties by word). Output: rank (0-based),
    value, type_id ``FIX_<rank>``.
    """
    words = (table(spark, sf_dir, "benchmark")
             .select(F.explode(word_tokens(F.lower("text"))).alias("value"))
             .filter(F.length("value") >= min_len)
             .groupBy("value").agg(F.count(F.lit(1)).alias("cnt")))
    from presswork.operators.articles import assign_ids
    top = words.orderBy(F.desc("cnt"), "value").limit(n)
    return assign_ids(top, "FIX_", [F.desc("cnt"), F.col("value")], id_col="type_id",
                      pos_col="rank")


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Stop words from a space-separated text file -> one ``word`` per row."""
    return (spark.read.text(path)
            .select(F.explode(F.split(F.trim("value"), r"\s+")).alias("word"))
            .filter(F.length("word") > 0).distinct())


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """HTML page table ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_articles(articles: DataFrame, date=None, keywords=None) -> DataFrame:
    """Articles of one date (partition pruning on ``date``), optionally
    only those retrieved under the given keywords (equality)."""
    out = articles
    if date is not None:
        out = out.filter(F.col("date") == F.lit(date).cast("date"))
    if keywords is not None:
        out = out.filter(F.col("keyword").isin(list(keywords)))
    return out


def read_keywords(keywords: DataFrame, date=None, kind: str | None = None) -> DataFrame:
    """Keyword rows of a date whose ``type_id`` starts with ``kind``."""
    out = keywords
    if date is not None:
        out = out.filter(F.col("date") == F.lit(date).cast("date"))
    if kind:
        out = out.filter(F.col("type_id").startswith(kind))
    return out


def date_status(articles: DataFrame, dates: DataFrame) -> DataFrame:
    """For each requested date, whether a partition of articles exists."""
    have = articles.select("date").distinct().withColumn("present", F.lit(True))
    return (dates.join(have, "date", "left")
            .select("date", F.coalesce("present", F.lit(False)).alias("exists")))
