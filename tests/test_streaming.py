from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from tidemill.streaming import (
    drain_merge,
    drain_to_files,
    drain_updates,
    latest_updates,
    stream_aggregate,
    stream_deduplicate,
    stream_files,
)

DDL = "id int, t timestamp_ntz, x double"


def feed(spark, path, data):
    spark.createDataFrame(data, "id int, t string, x double").withColumn("t", F.col("t").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(path)


def test_dedup_across_batches(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    feed(spark, source, [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:00:10", 1.0), (2, "2024-01-01 00:01:00", 2.0)])
    schema = spark.read.parquet(source).schema

    def drain():
        once = stream_deduplicate(stream_files(spark, source, schema, files_per_batch=1), "id", "t", "1 hour")
        drain_to_files(once.select("id"), out, f"{tmp_path}/cp")

    drain()
    feed(spark, source, [(2, "2024-01-01 00:02:00", 2.0), (3, "2024-01-01 00:03:00", 3.0)])
    drain()
    assert rows(spark.read.parquet(out)) == [(1,), (2,), (3,)]


def test_window_aggregate_updates(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    feed(spark, source, [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 23:00:00", 2.0)])
    schema = spark.read.parquet(source).schema

    def drain():
        agg = stream_aggregate(stream_files(spark, source, schema), "t", "2 days", "1 day", "id", "count:*,sum:x")
        drain_updates(agg, out, f"{tmp_path}/cp")

    drain()
    feed(spark, source, [(1, "2024-01-01 12:00:00", 4.0), (2, "2024-01-02 12:00:00", 8.0)])
    drain()
    got = latest_updates(spark, out, "window_start,id").withColumn("window_start", F.date_format("window_start", "dd"))
    assert rows(got) == [("01", 1, 3, 7.0), ("02", 2, 1, 8.0)]


def test_upsert_over_batches(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    feed(spark, source, [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:00:10", 1.5), (2, "2024-01-01 00:01:00", 2.0)])
    schema = spark.read.parquet(source).schema

    def drain():
        drain_merge(stream_files(spark, source, schema), out, f"{tmp_path}/cp", "id", order_by="t")

    drain()
    feed(spark, source, [(2, "2024-01-01 00:02:00", 9.0), (3, "2024-01-01 00:03:00", 3.0)])
    drain()
    drain()
    assert rows(spark.read.parquet(out).select("id", "x")) == [(1, 1.5), (2, 9.0), (3, 3.0)]


def test_a_late_row_does_not_replace_a_newer_one(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    feed(spark, source, [(1, "2024-01-10 00:00:00", 1.0), (2, "2024-01-05 00:00:00", 2.0)])
    schema = spark.read.parquet(source).schema
    for late in ([], [(1, "2024-01-01 00:00:00", 7.0), (2, "2024-01-06 00:00:00", 8.0), (3, "2023-01-01 00:00:00", 9.0)]):
        if late:
            feed(spark, source, late)
        drain_merge(stream_files(spark, source, schema), out, f"{tmp_path}/cp", "id", order_by="t")
    assert rows(spark.read.parquet(out).select("id", "x")) == [(1, 1.0), (2, 8.0), (3, 9.0)]
