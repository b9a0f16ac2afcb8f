"""Event-time counts, dedup, late cut-off and keyed refresh.

Each run reads what is new in a folder, with the offsets, state and watermark
in a checkpoint folder (``availableNow``): a scheduled job that goes on where
the last run ended, and after a lost driver too. State is bounded by the watermark:
windows and keys older than it are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.sources.sinks import upsert_partitions


def read_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The Parquet files of a folder (or one file) as a stream, oldest file
    first. The schema is that of the files that are there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a plain path must be a folder; a pattern that matches just it may be a file
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def event_time(sdf: DataFrame, ts: str, delay: str) -> DataFrame:
    """``ts`` as an instant (session time zone) with a watermark ``delay`` behind
    the newest; rows without a time belong to no window and go."""
    return (sdf.withColumn(ts, F.col(ts).cast("timestamp")).where(F.col(ts).isNotNull())
            .withWatermark(ts, delay))


def stream_counts(sdf: DataFrame, ts: str = "ts", word: str = "word", delay: str = "1 day",
                  width: str = "1 hour") -> DataFrame:
    """T1 (K13 on a stream): rows a word and tumbling window of event time:
    ``(start, word, cnt)``. T3: a row is left out when its window ended at or
    before the watermark that the earlier runs reached."""
    counts = event_time(sdf, ts, delay).groupBy(F.window(ts, width), word).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select(F.col("window.start").alias("start"), word, "cnt")


def stream_dedup(sdf: DataFrame, keys: Sequence[str], ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """T2 (K3 on a stream): the first row to arrive of each ``keys``. A key is
    forgotten ``delay`` after its row's time: rows further apart count as new."""
    return event_time(sdf, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def run_available(sdf: DataFrame, checkpoint: str, mode: str, each: Callable[[DataFrame, int], None] | None = None,
                  path: str | None = None) -> None:
    """Processes all that is there, in as many batches as the source makes, and
    stops: into ``path`` (Parquet, each row once) or through ``each(batch,
    batch_id)``, which may see a batch again after a failure."""
    out = sdf.writeStream.trigger(availableNow=True).outputMode(mode).option("checkpointLocation", checkpoint)
    query = out.foreachBatch(each).start() if each else out.format("parquet").start(path)
    try:
        query.awaitTermination()
    finally:
        query.stop()


def upsert_batch(path: str, keys: Sequence[str], partition: str = "date") -> Callable[[DataFrame, int], None]:
    """T4: a ``foreachBatch`` function that writes a batch's rows into the keyed
    table at ``path``. Rows carry the number of their batch, and the largest
    stays: a batch that runs twice, or again after later ones, changes nothing."""
    def each(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        upsert_partitions(rows, path, keys, ["batch"], partition)

    return each


def stream_upsert(sdf: DataFrame, path: str, keys: Sequence[str], checkpoint: str, partition: str = "date",
                  mode: str = "update") -> None:
    """T4: one run of a stream into a keyed table (see ``upsert_batch``)."""
    run_available(sdf, checkpoint, mode, each=upsert_batch(path, keys, partition))
