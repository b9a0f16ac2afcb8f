"""Registered queries: streaming (T1-T4) and the summary sink's relatives.

The streams are ``events`` (hourly counts a type) and ``documents`` with their
publish time from ``events`` (titles). Runs write below the checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators.keywords import slot_of_age
from presswork.plans.registry import query
from presswork.plans.sql_common import ART, SLOT
from presswork.session import checkpoint_dir
from presswork.sources.corpus import table, title_of
from presswork.streaming import streams as T


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for the tables of one run."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def hourly(events: DataFrame, delay: str) -> DataFrame:
    counts = T.stream_counts(events.select("ts", F.col("event_type").alias("word")), delay=delay)
    return counts.withColumn("date", F.to_date("start"))


EVENTS = "ev AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, event_type AS word FROM events WHERE ts IS NOT NULL)"


@query("t1_stream_counts", f"""WITH {EVENTS}
SELECT CAST(date_trunc('day', ts) AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, word, count(*) AS cnt FROM ev GROUP BY ALL""")
def t1_stream_counts(spark, sf):
    """Hourly event counts by type, as the stream's keyed table holds them
    after a run (equal to the batch count)."""
    top = scratch(spark, "t1")
    sdf = hourly(T.read_stream(spark, f"{sf}/events.parquet"), "1 day")
    T.stream_upsert(sdf, f"{top}/counts", ["start", "word"], f"{top}/state")
    return spark.read.parquet(f"{top}/counts").select("date", F.hour("start").alias("hour"), "word", "cnt")


@query("t1_slot_sums", f"""WITH {EVENTS}
SELECT CAST(date_trunc('day', ts) AS DATE) AS date, {SLOT.replace('h ', 'hour(ts) ')} AS slot, word, count(*) AS cnt FROM ev GROUP BY ALL""")
def t1_slot_sums(spark, sf):
    """The uneven slots of a day (6, 4, 4, 4, 4, 2 hours) as sums of the stream's hours."""
    hours = t1_stream_counts(spark, sf)
    return hours.groupBy("date", slot_of_age(F.col("hour")).alias("slot"), "word").agg(F.sum("cnt").alias("cnt"))


@query("t2_stream_dedup", f"""WITH {ART}
SELECT DISTINCT date, {SLOT.replace('h ', 'hour(ts) ')} AS slot, title FROM art WHERE ts IS NOT NULL""")
def t2_stream_dedup(spark, sf):
    """Titles of a day's slot, each once; the delay covers the span of the
    events, so the result is K3's."""
    top = scratch(spark, "t2")
    published = table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("ts"))
    docs = T.read_stream(spark, f"{sf}/documents.parquet").select("doc_id", title_of(F.col("text")).alias("title"))
    rows = docs.join(published, "doc_id").withColumn("date", F.to_date("ts")).withColumn("slot", slot_of_age(F.hour("ts")))
    T.run_available(T.stream_dedup(rows, ["date", "slot", "title"], delay="366 days"), f"{top}/state", "append", path=f"{top}/titles")
    return spark.read.parquet(f"{top}/titles").select("date", "slot", "title")


EARLY = "coalesce(user_id % 2, 1) = 1"


@query("t3_late_cutoff", f"""WITH ev AS (
  SELECT CAST(ts AS TIMESTAMP) AS ts, event_type AS word, {EARLY} AS early FROM events WHERE ts IS NOT NULL),
reached AS (SELECT max(ts) - INTERVAL 10 DAYS AS mark FROM ev WHERE early)
SELECT CAST(date_trunc('day', ts) AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, word, count(*) AS cnt
FROM ev, reached WHERE early OR mark IS NULL OR date_trunc('hour', ts) + INTERVAL 1 HOUR > mark GROUP BY ALL""")
def t3_late_cutoff(spark, sf):
    """Two runs; the first reads the events of odd users, the second the
    others, of which those in windows that the watermark (10 days behind the
    first run's newest) has passed come too late."""
    top = scratch(spark, "t3")
    events = table(spark, sf, "events").where("ts is not null")
    for run in (EARLY, f"not ({EARLY})"):
        events.where(run).select("ts", "event_type").write.mode("append").parquet(f"{top}/arrived")
        T.stream_upsert(hourly(T.read_stream(spark, f"{top}/arrived"), "10 days"), f"{top}/counts", ["start", "word"], f"{top}/state")
    return spark.read.parquet(f"{top}/counts").select("date", F.hour("start").alias("hour"), "word", "cnt")


@query("t4_daily_refresh", f"""WITH {EVENTS}
SELECT CAST(date_trunc('day', ts) AS DATE) AS date, word, max(event_id) AS event_id, max_by(ts, event_id) AS ts FROM ev GROUP BY ALL""")
def t4_daily_refresh(spark, sf):
    """T4: the newest event of each type and day, kept by a keyed refresh; the
    stream comes in two runs and the second run's batch is written twice."""
    top = scratch(spark, "t4")
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("word")).where("ts is not null")
    mid = events.select(F.median("event_id")).scalar()
    write = T.upsert_batch(f"{top}/newest", ["word"])

    def each(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy(F.to_date("ts").alias("date"), "word").agg(F.max(F.struct("event_id", "ts")).alias("e"))
        newest = newest.select("date", "word", "e.event_id", "e.ts")
        write(newest, batch_id)
        write(newest, batch_id)

    for run in ((F.col("event_id") <= mid), (F.col("event_id") > mid)):
        events.where(run).write.mode("append").parquet(f"{top}/arrived")
        T.run_available(T.read_stream(spark, f"{top}/arrived"), f"{top}/state", "append", each=each)
    return spark.read.parquet(f"{top}/newest").select("date", "word", "event_id", "ts")
