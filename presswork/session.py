"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # theta joins against small keyword tables are broadcast explicitly,
    # after a size check; automatic broadcast stays at its default bound
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "presswork") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(partitions or int(cpus)))
    b = b.config("spark.driver.memory", os.environ.get("PRESSWORK_DRIVER_MEM", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def co_partition_on_group(spark: SparkSession) -> None:
    """Let joins and aggregations keyed by ``(group, ...)`` reuse a hash
    partitioning on ``group`` alone (per-article / per-keyword work is
    partitioned once by its group and stays partition-local afterwards)."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def group_partitions(spark: SparkSession, size: int = 0, each: int = 4 << 20) -> int:
    """Partitions for work hash-partitioned once by its group key.

    Several sorts and aggregations then share one stage per partition, so use
    more, smaller partitions than the plain shuffle setting (at least 8 per
    core), and so many that of ``size`` bytes of text about ``each`` fall to
    one; ``presswork.group.partitions`` overrides.
    """
    v = spark.conf.get("presswork.group.partitions", None)
    if v:
        return int(v)
    cores = spark.sparkContext.defaultParallelism
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * cores, -(-size // each))


def checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    On a cluster this must be a shared folder, and it is an error if it is
    unset; under a ``local[...]`` master a scratch folder is created then.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        have = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = have.get() if have.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="presswork-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(d)
    return d


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete an action's shuffle files when the action ends, not when
    the driver collects its garbage: what later steps read is in a checkpoint or
    a table by then (anything else is computed again)."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Bound the bytes of what goes to Python workers at once: batches of texts
    and of packed rows lie outside the executor's heap, once more in the worker."""
    if spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() > most:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    checkpoint_dir(df.sparkSession)
    free_shuffles(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that their
    Python workers can import it wherever they start."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="presswork-ship-")) / "presswork_package.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(out))
    _shipped.add(app)
