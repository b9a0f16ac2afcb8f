"""T1-T4 and the keyed sinks."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from presswork.sources.sinks import read_table, upsert_partitions, write_partitions
from presswork.streaming import streams as T

SCHEMA = "ts timestamp, word string, title string"


def at(day, hour, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def counted(spark, top, delay):
    sdf = T.stream_counts(T.read_stream(spark, f"{top}/in"), delay=delay).withColumn("date", F.to_date("start"))
    T.stream_upsert(sdf, f"{top}/out", ["start", "word"], f"{top}/state")
    return {(r.start, r.word): r.cnt for r in spark.read.parquet(f"{top}/out").collect()}


def test_t1_counts_equal_batch_over_runs(spark, tmp_path):
    top = str(tmp_path)
    first = [(at(1, 3, 5), "a", "x"), (at(1, 3, 50), "a", "y"), (at(2, 4), "b", "z"), (None, "a", "n")]
    arrive(spark, f"{top}/in", first)
    assert counted(spark, top, "30 days") == {(at(1, 3), "a"): 2, (at(2, 4), "b"): 1}
    arrive(spark, f"{top}/in", [(at(1, 3, 59), "a", "q"), (at(1, 3), None, "q")])
    want = {(at(1, 3), "a"): 3, (at(1, 3), None): 1, (at(2, 4), "b"): 1}
    assert counted(spark, top, "30 days") == want
    # nothing new: nothing changes
    assert counted(spark, top, "30 days") == want


def test_t3_late_row_is_absent(spark, tmp_path):
    top = str(tmp_path)
    arrive(spark, f"{top}/in", [(at(5, 12), "a", "x")])
    counted(spark, top, "2 hours")
    # the watermark stands at 10:00: the window 9-10 is closed, 10-11 is not
    arrive(spark, f"{top}/in", [(at(5, 9, 30), "a", "late"), (at(5, 10, 30), "a", "in time")])
    assert counted(spark, top, "2 hours") == {(at(5, 12), "a"): 1, (at(5, 10), "a"): 1}


def titles(spark, top, delay):
    sdf = T.stream_dedup(T.read_stream(spark, f"{top}/in"), ["title"], delay=delay)
    T.run_available(sdf, f"{top}/state", "append", path=f"{top}/out")
    return sorted(r.title for r in spark.read.parquet(f"{top}/out").collect())


def test_t2_titles_once_within_the_delay(spark, tmp_path):
    long, short = str(tmp_path / "long"), str(tmp_path / "short")
    for top, delay, want in ((long, "10 days", ["p", "q", "r"]), (short, "1 hour", ["p", "p", "q", "r"])):
        arrive(spark, f"{top}/in", [(at(1, 1), "a", "p"), (at(1, 1), "a", "p"), (at(1, 2), "a", "q")])
        titles(spark, top, delay)
        arrive(spark, f"{top}/in", [(at(3, 1), "a", "r")])
        titles(spark, top, delay)
        # a key of two days ago is forgotten where the delay is an hour
        arrive(spark, f"{top}/in", [(at(3, 2), "a", "p")])
        assert titles(spark, top, delay) == want


def test_t4_batch_twice_and_out_of_turn(spark, tmp_path):
    path = str(tmp_path / "t")
    write = T.upsert_batch(path, ["k"])
    def rows(*x):
        return spark.createDataFrame([(dt.date(2024, 1, d), k, v) for d, k, v in x], "date date, k string, v int")
    def read():
        return sorted((r.date.day, r.k, r.v) for r in spark.read.parquet(path).collect())
    write(rows((1, "a", 1), (2, "a", 1)), 0)
    write(rows((1, "a", 2), (1, "b", 5)), 1)
    want = [(1, "a", 2), (1, "b", 5), (2, "a", 1)]
    assert read() == want
    for batch, of in ((1, rows((1, "a", 2), (1, "b", 5))), (0, rows((1, "a", 1), (2, "a", 1)))):
        write(of, batch)
        assert read() == want
    write(rows(), 2)
    assert read() == want


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_sink_leaves_other_dates_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(dt.date(2024, 1, d), k, f"{d}{k}") for d in (1, 2, 3) for k in "ab"], "date date, keyword string, v string")
    assert read_table(spark, path, df).count() == 0
    write_partitions(df, path, sort=["keyword"])
    before = files(path)
    upsert_partitions(df.where("date = '2024-01-02' and keyword = 'a'").withColumn("v", F.lit("new")), path, ["keyword"])
    after = files(path)
    same = {f for f in before if "date=2024-01-02" not in f}
    assert same and all(after[f] == before[f] for f in same) and not any("date=2024-01-02" in f and f in after for f in before)
    got = {(r.date.day, r.keyword): r.v for r in spark.read.parquet(path).collect()}
    assert got == {(d, k): "new" if (d, k) == (2, "a") else f"{d}{k}" for d in (1, 2, 3) for k in "ab"}
    # two rows of one key: the last by order, then a defined one
    two = spark.createDataFrame([(dt.date(2024, 1, 3), "a", "z"), (dt.date(2024, 1, 3), "a", "y")], df.schema)
    upsert_partitions(two, path, ["keyword"])
    assert [r.v for r in spark.read.parquet(path).where("date = '2024-01-03' and keyword = 'a'").collect()] == ["y"]
    with pytest.raises(PySparkException):
        upsert_partitions(df.limit(1).withColumn("date", F.lit(None).cast("date")), path, ["keyword"])
