"""URL filter: sort-merge range join of urls with prefix rules.

The canonical key of a host is its labels in reverse, each closed by a dot
(``www.example.org`` is ``org.example.www.``), so a rule's host and all its
subdomains are one interval of keys that begin with the rule's key. Urls are
range-partitioned and sorted by key (ties split by path and id, so one hot
host takes as many partitions as it needs); each rule is sent to the
partitions that its interval meets. A sweep over the sorted urls keeps a stack
of the active rules, nested because intervals of prefixes are: a rule is
pushed when the sweep reaches its key and popped when the keys leave its
interval. Of the active rules whose path begins the url's path the longest
(host and path together, then host) decides.

Defined results: a null url, or one without ``://``, has an empty host and
path and meets no rule; without a rule the verdict is ``default``. Rules with
a null or empty host, or a null verdict, are left out; a null path counts as
empty. Of rules with the same host and path, block wins. Repeated urls are
judged each for itself; null ids are carried; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import cut_lineage, spread

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


class _Frame:
    """Active rules of one host: verdicts by path, and the path lengths present."""

    __slots__ = ("key", "host", "paths", "lengths")

    def __init__(self, key: str, host: str):
        self.key, self.host, self.paths, self.lengths = key, host, {}, []

    def add(self, path: str, verdict: str) -> None:
        if self.paths.get(path) != "block":
            self.paths[path] = verdict
        self.lengths = sorted({len(p) for p in self.paths}, reverse=True)

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in self.lengths if n <= len(path) and path[:n] in self.paths), None)


def sweep(urls: list[tuple[str, str]], rules: list[tuple[str, str, str, str]]) -> Iterator[tuple[str | None, str | None]]:
    """Rule and verdict of each (key, path), sorted by key; rules are (key,
    host, path, verdict), sorted by key."""
    stack: list[_Frame] = []
    frames: dict[str, _Frame] = {}
    order: list[_Frame] = []
    for key, host, path, verdict in rules:
        if key not in frames:
            frames[key] = _Frame(key, host)
            order.append(frames[key])
        frames[key].add(path, verdict)
    at = 0
    for key, path in urls:
        while at < len(order) and order[at].key <= key:
            while stack and not order[at].key.startswith(stack[-1].key):
                stack.pop()
            stack.append(order[at])
            at += 1
        while stack and not key.startswith(stack[-1].key):
            stack.pop()
        best = None
        for f in stack:  # outermost first: of equal lengths the longer host stays
            p = f.longest(path)
            if p is not None and (best is None or len(f.host) + len(p) >= len(best[0].host) + len(best[1])):
                best = (f, p)
        yield (best[0].host + best[1], best[0].paths[best[1]]) if best else (None, None)


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every row of ``urls``."""
    spark, kind = urls.sparkSession, dict(urls.dtypes)[id_col]
    table = urls.select(F.col(id_col).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    table = table.withColumn("key", host_key(F.col("host")))
    # written once: the bounds below must be those of the very partitions swept
    table = cut_lineage(table.repartitionByRange(spread(spark), "key", "path", "page_id")
                        .withColumn("part", F.spark_partition_id()))
    bounds = table.groupBy(F.col("part").alias("to")).agg(F.min("key").alias("low"), F.max("key").alias("high"))
    clean = (rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"),
                          F.col("verdict").alias("rule_verdict"))
             .where("rule_host is not null and rule_host <> '' and rule_verdict is not null").distinct()
             .withColumn("rule_key", host_key(F.col("rule_host"))))
    # at most one row a partition of urls
    sent = clean.join(F.broadcast(bounds), (F.col("rule_key") <= F.col("high"))
                      & ((F.col("rule_key") >= F.col("low")) | F.col("low").startswith(F.col("rule_key"))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("key")
        mine = sorted(zip(*(right.column(c).to_pylist() for c in ("rule_key", "rule_host", "rule_path", "rule_verdict")), strict=True))
        got = list(sweep(list(zip(left.column("key").to_pylist(), left.column("path").to_pylist(), strict=True)), mine))
        out = left.select(["page_id", "host", "path"])
        out = out.append_column("rule", pa.array([x[0] for x in got], pa.string()))
        return out.append_column("verdict", pa.array([x[1] or default for x in got], pa.string()))

    return table.groupBy("part").cogroup(sent.groupBy("to")).applyInArrow(
        run, f"page_id {kind}, host string, path string, rule string, verdict string")
