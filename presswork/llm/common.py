"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.session import cut_lineage, ship

__all__ = ["cut_lineage", "fold", "load", "ship", "spread", "text_bytes"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, m: int) -> Column:
    """``crc32(doc_id as text) mod m``; null ids fall in no fold."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(m))


def spread(spark: SparkSession) -> int:
    """Partitions of an explicit shuffle: what the session uses for its own."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def text_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of ``df``: for a scan, its stored bytes;
    0 where it has none (rows that do not come from files)."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 53 else 0
