"""Keyed tables on Parquet: S4 and U16 as sinks.

A table is a folder partitioned by one column (``date``). A write replaces the
partitions that it has rows for and no others (dynamic partition overwrite), so
a rerun of a day leaves the files of every other day alone, and a failed write
leaves the old files in place until the job commits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, partition: str = "date", sort: Sequence[str] = ()) -> None:
    """Replaces the partitions that ``df`` has rows for. One shuffle brings a
    partition's rows together (a hot partition is split by the writer's
    rebalancing, at the cost of more files); ``sort`` orders rows in the files,
    so that range predicates on these columns skip row groups."""
    out = df.hint("rebalance", partition)
    if sort:
        out = out.sortWithinPartitions(partition, *sort)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path`` with the columns of ``like``; empty where none is there yet."""
    try:
        return spark.read.schema(like.schema).parquet(path).select(*like.columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def upsert_partitions(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (),
                      partition: str = "date") -> None:
    """Rows of ``new`` replace stored rows of equal ``keys``; of several rows
    with one key the last by ``order`` stays, whether stored or new (ties: the
    new one; then by all columns, so the choice is defined). Only partitions
    that ``new`` meets are read and written. Writing the same rows again
    changes nothing. Rows with a null partition are refused: they have no file."""
    spark = new.sparkSession
    new = new.select(*new.columns).where(F.assert_true(F.col(partition).isNotNull(), F.lit(f"{partition} is null")).isNull())
    days = new.select(partition).distinct()
    old = read_table(spark, path, new).join(days, partition, "left_semi").select(*new.columns)
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    by_key = [partition, *(k for k in keys if k != partition)]
    rest = [c for c in new.columns if c not in by_key]
    last = Window.partitionBy(*by_key).orderBy(*(F.desc(c) for c in order), F.desc("_new"), *(F.asc(c) for c in rest))
    kept = both.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn", "_new")
    write_partitions(kept, path, partition, [k for k in by_key if k != partition])
