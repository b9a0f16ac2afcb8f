"""Article-level operators: repeats, quota, ids, slots, keyed upsert/delete.

E15-E19, S4, S5. All are window or join plans; windows are partitioned by
the business key (keyword, outlet), never global, except ``assign_ids`` on
tables already cut to a top-k (keyword lists of at most a few dozen rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def drop_repeats(df: DataFrame, order: Sequence, partition: Sequence = ("keyword",),
                 content: str = "content", thumbnail: str = "thumbnail") -> DataFrame:
    """Drop rows with no body, and rows without thumbnail whose body equals
    the previously kept body (within ``partition`` in ``order``).

    A row dropped as a repeat equals the kept row before it, so comparing with
    the previous surviving row (``lag`` after the null filter) is exact.
    """
    w = Window.partitionBy(*_cols(partition)).orderBy(*_cols(order))
    kept = df.filter(F.col(content).isNotNull())
    prev = F.lag(content).over(w)
    return (kept.withColumn("_prev", prev)
            .filter(~(F.col(thumbnail).isNull() & F.col("_prev").isNotNull()
                      & (F.col(content) == F.col("_prev"))))
            .drop("_prev"))


def quota(df: DataFrame, order: Sequence, n: int = 30,
          partition: Sequence = ("keyword", "agency")) -> DataFrame:
    """First ``n`` accepted articles per (keyword, outlet).

    ``row_number() <= n`` lets Spark insert a partial per-partition group
    limit before the shuffle, so a hot (keyword, outlet) ships at most ``n``
    rows per map task.
    """
    w = Window.partitionBy(*_cols(partition)).orderBy(*_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def offtopic_keywords(rejected: DataFrame, n: int = 30, outlets: int = 3,
                      keyword: str = "keyword", outlet: str = "agency") -> DataFrame:
    """Keywords whose rejected articles exceed ``n`` at ``outlets`` or more
    outlets (two-level aggregation). Off by default in the jobs."""
    per = rejected.groupBy(keyword, outlet).agg(F.count(F.lit(1)).alias("rejected"))
    return (per.filter(F.col("rejected") > n).groupBy(keyword)
            .agg(F.count(F.lit(1)).alias("outlets"))
            .filter(F.col("outlets") >= outlets).select(keyword))


def number_rows(df: DataFrame, key: str, order: str, out: str = "id", block: int = 1 << 16) -> DataFrame:
    """E18 for keys of any size: zero-based positions within ``key`` by the
    integer column ``order``, whose values are unique. No task orders a whole
    key: rows are numbered within blocks of ``block`` values of ``order``, and
    only the counts of these blocks are summed up a key."""
    b = df.withColumn("_block", F.floor(F.col(order) / block))
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (b.groupBy(key, "_block").agg(F.count(F.lit(1)).alias("_n"))
              .select(key, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = F.row_number().over(Window.partitionBy(key, "_block").orderBy(order)) - 1
    return (b.withColumn("_at", inside).join(starts, [key, "_block"])
            .withColumn(out, (F.col("_start") + F.col("_at")).cast("string")).drop("_block", "_at", "_start"))


def assign_ids(df: DataFrame, prefix: str, order: Sequence, offset: int = 0,
               partition: Sequence = (), id_col: str = "type_id",
               pos_col: str | None = None) -> DataFrame:
    """Zero-based sequential ids ``<prefix><n>`` in ``order``.

    Without ``partition`` the window is global (one task); use it only on
    tables already bounded by a top-k.
    """
    w = Window.partitionBy(*_cols(partition)).orderBy(*_cols(order)) if partition \
        else Window.orderBy(*_cols(order))
    pos = F.row_number().over(w) - 1 + offset
    out = df.withColumn("_pos", pos)
    out = out.withColumn(id_col, F.concat(F.lit(prefix), F.col("_pos").cast("string")))
    if pos_col:
        return out.withColumnRenamed("_pos", pos_col)
    return out.drop("_pos")


def slot_of(pos, size: int) -> Column:
    """Run slot of a zero-based position for slots of ``size``."""
    p = F.col(pos) if isinstance(pos, str) else pos
    return F.floor(p / F.lit(size)).cast("int")


def upsert(new: DataFrame, old: DataFrame, keys: Sequence[str],
           version: str = "_version", order: Sequence = ()) -> DataFrame:
    """Keyed upsert, last write wins (rows of ``new`` replace equal keys).
    Of rows that share a key on one side the first in ``order`` stays; without
    an order, keys must be unique on each side or any of the rows stays."""
    both = (old.withColumn(version, F.lit(0))
            .unionByName(new.withColumn(version, F.lit(1)), allowMissingColumns=True))
    w = Window.partitionBy(*keys).orderBy(F.desc(version), *_cols(order))
    return (both.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn", version))


def drop_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keyed delete (anti join)."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")
