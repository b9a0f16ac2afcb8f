"""Daily keyword mining: K1-K19.

Per-article work (sentences, tokens, word graph, ranks) is keyed by the
article id; per-day work (counts, top-k, merges) is keyed by slot / word and
uses partial (map-side) aggregation before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions.text import filter_tokens, merge_sentences, word_tokens
from presswork.operators.articles import assign_ids

# Slot bins of article age in hours (start hour of each slot).
SLOT_STARTS = (0, 6, 10, 14, 18, 22)

# The age text form "<N>시간전" ("N hours ago").
AGE_HOURS_RE = r"^(\d+)시간전"


def age_hours(ts, as_of, wrap: bool = False) -> Column:
    """Whole hours between ``ts`` and ``as_of``; modulo 24 when ``wrap``."""
    t = F.col(ts) if isinstance(ts, str) else ts
    h = F.floor((F.unix_micros(as_of) - F.unix_micros(t)) / F.lit(3_600_000_000)).cast("long")
    return F.pmod(h, F.lit(24)) if wrap else h


def slot_of_age(hours: Column) -> Column:
    """K1: 0-5, 6-9, 10-13, 14-17, 18-21, 22-23 -> slot 0..5; older -> null."""
    expr = (F.when(hours.isNull() | (hours < 0) | (hours > 23), F.lit(None).cast("int"))
            .when(hours >= 22, 5).when(hours >= 18, 4).when(hours >= 14, 3)
            .when(hours >= 10, 2).when(hours >= 6, 1).otherwise(0))
    return expr


def age_slot(df: DataFrame, ts: str = "ts", as_of: Column | None = None,
             wrap: bool = False) -> DataFrame:
    """K1: add ``slot``, older articles excluded; ``as_of`` defaults to the newest
    ``ts`` (scalar subquery). ``wrap`` takes ages modulo a day instead."""
    if as_of is None:
        as_of = df.select(F.max(ts)).scalar()
    out = df.withColumn("_h", age_hours(ts, as_of, wrap))
    out = out.withColumn("slot", slot_of_age(F.col("_h")))
    return out.filter(F.col("slot").isNotNull()).drop("_h")


def parse_age(c) -> Column:
    """K2: "N hours ago" text -> N; other forms -> null."""
    v = F.regexp_extract(F.col(c) if isinstance(c, str) else c, AGE_HOURS_RE, 1)
    return F.when(v != "", v.cast("int"))


def dedup_title(df: DataFrame, order: Sequence, partition: Sequence = ("slot",),
                title: str = "title") -> DataFrame:
    """K3: first article per exact title within a slot."""
    w = Window.partitionBy(*partition, title).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def concat_text(df: DataFrame, title: str = "title", content: str = "content",
                out: str = "text") -> DataFrame:
    """K4: analysis text = title || body (no separator)."""
    return df.withColumn(out, F.concat(F.coalesce(title, F.lit("")), F.coalesce(content, F.lit(""))))


def sentence_rows(df: DataFrame, keys: Sequence[str], text: str = "text",
                  min_len: int = 15) -> DataFrame:
    """K5 as rows: ``(keys..., sent, sentence)``; ``sent`` is 0-based."""
    m = merge_sentences(df.select(*keys, text), text, "_sents", min_len)
    # the _outer generator keeps Catalyst from inferring a size() filter that
    # would inline the fragment expression back into the lambdas
    return (m.select(*keys, F.posexplode_outer("_sents").alias("sent", "sentence"))
            .filter(F.col("sentence").isNotNull()))


def tokens(df: DataFrame, col: str = "sentence", stop: Sequence[str] | None = None,
           min_len: int = 2, out: str = "tokens", analyser=None) -> DataFrame:
    """K6: content-word tokens of ``col``: word runs of ``min_len``+ chars not in
    ``stop``. ``analyser`` (optional) is a Column -> Column callable, e.g. a
    pandas UDF wrapping a morphological analyser, used instead of the word
    pattern."""
    raw = analyser(F.col(col)) if analyser is not None else word_tokens(col)
    return df.withColumn(out, filter_tokens(raw, stop, min_len))


def drop_blacklisted(df: DataFrame, blacklist: DataFrame, word: str = "word") -> DataFrame:
    """Broadcast anti join against a bounded blacklist (a fixed list)."""
    return df.join(F.broadcast(blacklist.select(F.col("word").alias(word)).distinct()), word, "left_anti")


def keyword_counts(df: DataFrame, keys: Sequence[str] = ("slot",), word: str = "word",
                   doc: str = "id") -> DataFrame:
    """In how many articles each keyword occurs, per key."""
    return df.groupBy(*keys, word).agg(F.count_distinct(doc).alias("cnt"))


def slot_top(counts: DataFrame, n: int = 30, slot: str = "slot", word: str = "word",
             by: Sequence[str] = ()) -> DataFrame:
    """Top ``n`` per slot (of each ``by``; cnt desc, word asc), ids offset by ``n * slot``."""
    w = Window.partitionBy(*by, slot).orderBy(F.desc("cnt"), F.asc(word))
    out = counts.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return out.withColumn("day_id", F.concat(
        F.lit("DAY_"), (F.col(slot) * n + F.col("_rn") - 1).cast("string"))).drop("_rn")


def merge_slots(df: DataFrame, word: str = "word", by: Sequence[str] = ()) -> DataFrame:
    """Sum counts per keyword (of each ``by``) over slots."""
    return df.groupBy(*by, word).agg(F.sum("cnt").alias("cnt"))


def drop_fixed_overlap(day: DataFrame, fixed: DataFrame, word: str = "word",
                       fixed_value: str = "value") -> DataFrame:
    """Remove day keywords that contain any fixed keyword (set-wise).

    The fixed list is bounded (10 rows), so the theta join is a broadcast
    nested loop over the day keywords.
    """
    f = F.broadcast(fixed.select(F.col(fixed_value).alias("_fix")))
    return day.join(f, F.col(word).contains(F.col("_fix")), "left_anti")


def day_keywords(merged: DataFrame, n: int = 10, word: str = "word",
                 prefix: str = "DAY_") -> DataFrame:
    """Top ``n`` by count (word asc) with ids ``<prefix><k>``."""
    top = merged.orderBy(F.desc("cnt"), F.asc(word)).limit(n)
    return assign_ids(top, prefix, [F.desc("cnt"), F.asc(word)], id_col="type_id")


def daily_keywords(merged: DataFrame, n: int = 10, word: str = "word", prefix: str = "DAY_",
                   by: Sequence[str] = ("date",)) -> DataFrame:
    """K17 / K18 for every day at once: top ``n`` of each ``by`` with ids ``<prefix><k>``."""
    w = Window.partitionBy(*by).orderBy(F.desc("cnt"), F.asc(word))
    out = merged.withColumn("_r", F.row_number().over(w) - 1).filter(F.col("_r") < n)
    return out.withColumn("type_id", F.concat(F.lit(prefix), F.col("_r").cast("string"))).drop("_r")


def slot_articles(df: DataFrame, slot: str = "slot", doc: str = "id") -> DataFrame:
    """Analysed articles per slot."""
    return df.groupBy(slot).agg(F.count_distinct(doc).alias("articles"))
