"""Structured Streaming ingestion of the events table, drained to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_path
from ..sources import read_table
from ..streaming import (
    drain_merge,
    drain_to_files,
    drain_updates,
    latest_updates,
    stream_aggregate,
    stream_deduplicate,
    stream_files,
)
from .registry import day, query, rounded, table


def _events(spark, sf):
    schema = table(spark, sf, "events").schema
    # A stream path must be a folder unless it is a glob; this one fits a file and a folder.
    return stream_files(spark, f"{sf}/events.parque[t]", schema)


@query("stream_dedup", "SELECT DISTINCT event_id, user_id, event_type, value FROM events")
def stream_dedup(spark, sf):
    """Every event delivered twice, kept once."""
    twice = _events(spark, sf).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    once = stream_deduplicate(twice, "event_id", "ts", "40 days")
    path = shared_path(spark, "stream-dedup")
    drain_to_files(once.select("event_id", "user_id", "event_type", "value"), path, path + "-checkpoint")
    return spark.read.schema("event_id bigint, user_id bigint, event_type string, value double").parquet(path)


@query(
    "stream_window_agg",
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_start, event_type, count(*) AS count_rows,
           round(sum(value), 2) AS sum_value
    FROM events GROUP BY ALL
    """,
)
def stream_window_agg(spark, sf):
    agg = stream_aggregate(_events(spark, sf), "ts", "40 days", "1 day", "event_type", "count:*,sum:value")
    path = shared_path(spark, "stream-agg")
    drain_updates(agg, path, path + "-checkpoint")
    out = latest_updates(spark, path, "window_start,event_type")
    return rounded(out.withColumn("window_start", day("window_start")), "sum_value")


@query(
    "stream_upsert",
    """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def stream_upsert(spark, sf):
    """The latest event per user, kept as a table that every batch merges into."""
    path = shared_path(spark, "stream-upsert")
    drain_merge(_events(spark, sf), path, path + "-checkpoint", "user_id", order_by="ts,event_id", buckets=8)
    return read_table(spark, path).select("user_id", "event_id", "event_type", "value")


@query(
    "stream_late_rows",
    """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def stream_late_rows(spark, sf):
    """As ``stream_upsert``, but the feed comes in five batches, out of time order."""
    feed, path = shared_path(spark, "late-feed"), shared_path(spark, "late-upsert")
    events = table(spark, sf, "events")
    turn = F.coalesce(F.pmod(F.datediff(F.to_date("ts"), F.lit("1970-01-01")), F.lit(5)), F.lit(0))
    for batch in (3, 0, 4, 2, 1):
        events.filter(turn == batch).write.mode("append").parquet(feed)
        drain_merge(stream_files(spark, feed, events.schema), path, path + "-checkpoint", "user_id", order_by="ts,event_id", buckets=8)
    return read_table(spark, path).select("user_id", "event_id", "event_type", "value")
