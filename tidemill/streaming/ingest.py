"""File ingestion with Structured Streaming, drained with ``availableNow``."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from ..functions import col, names
from ..operators.aggregate import SIMPLE, parse_metric
from ..operators.dedup import deduplicate
from ..sources.writers import merge_into_table


def stream_files(
    spark: SparkSession, path: str, schema: StructType, format: str = "parquet", files_per_batch: int | None = None, **options
) -> DataFrame:
    """Files of a folder as a stream; ``pathGlobFilter`` and other reader options pass through."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _zoneless(df: DataFrame, time: str) -> bool:
    return isinstance(df.schema[time].dataType, TimestampNTZType)


def _epochs() -> tuple[Column, Column]:
    """The start of 1970, as an instant in UTC and as a zone-less time."""
    return F.timestamp_seconds(F.lit(0)), F.lit("1970-01-01").cast("timestamp_ntz")


def with_event_time(df: DataFrame, time: str, delay: str) -> DataFrame:
    """Watermark on ``time``. A watermark needs an instant: a zone-less time is read as UTC,
    to which windows are aligned, whatever the session's zone is."""
    instant, zoneless = _epochs()
    value = instant + (col(time) - zoneless) if _zoneless(df, time) else col(time).cast("timestamp")
    return df.withColumn(time, value).withWatermark(time, delay)


def stream_deduplicate(df: DataFrame, keys: str | Iterable[str], time: str, delay: str) -> DataFrame:
    """Drop repeats that arrive within the watermark delay; state expires with the watermark."""
    return with_event_time(df, time, delay).dropDuplicatesWithinWatermark(names(keys))


def stream_aggregate(
    df: DataFrame, time: str, delay: str, window: str, group_by: str | Iterable[str] | None, metrics: str | Iterable[str]
) -> DataFrame:
    """Tumbling-window aggregates: ``window_start``, the groups and ``func_column`` metrics.

    ``window_start`` has the kind of ``time`` (zone-less stays zone-less). Rows without a time
    belong to no window and are left out.
    """
    parsed = [parse_metric(m) for m in names(metrics)]
    if any(f not in SIMPLE for f, _, _ in parsed):
        raise ValueError("stream_aggregate: only plain aggregates can be kept as state")
    keys = [col(g) for g in names(group_by)]
    exprs = [F.count(F.lit(1)).alias(a) if c == "*" else SIMPLE[f](col(c)).alias(a) for f, c, a in parsed]
    instant, zoneless = _epochs()
    start = F.col("window.start")
    start = zoneless + (start - instant) if _zoneless(df, time) else start
    return (
        with_event_time(df, time, delay)
        .groupBy(F.window(col(time), window), *keys)
        .agg(*exprs)
        .select(start.alias("window_start"), *keys, *[a for _, _, a in parsed])
    )


def drain_to_files(df: DataFrame, path: str, checkpoint: str, format: str = "parquet") -> None:
    """Process everything that is there, append to files exactly once, stop."""
    query = (
        df.writeStream.format(format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def drain_updates(df: DataFrame, path: str, checkpoint: str) -> None:
    """Like :func:`drain_to_files` for changing results: each batch's updates go to their own
    ``batch_id=N`` folder, written with overwrite, so a repeated batch replaces itself."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    _drain_batches(df, put, checkpoint)


def drain_merge(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: str | Iterable[str],
    partition_by: str | Iterable[str] | None = None,
    order_by: str | Iterable[str] | None = None,
    buckets: int | None = None,
) -> None:
    """Upsert every batch into a path-based table. Nothing else may write to the table.

    With ``buckets`` it is a table of versions laid out by a hash of the key: a batch reads and writes only the buckets that
    its keys fall in, and readers (:func:`~tidemill.sources.read_table`) never see half a batch.

    Without ``order_by`` the batch wins over what is there. With it the row of a key that is last
    by these columns stays, however late its batch comes; on a tie the batch wins. A batch that
    is repeated after a failure merges to the same table.
    """
    newest = bool(names(order_by))

    def put(batch: DataFrame, batch_id: int) -> None:
        merge_into_table(batch, path, keys, partition_by=partition_by, order_by=order_by, target_unique=True, newest_wins=newest, buckets=buckets)

    _drain_batches(df, put, checkpoint)


def _drain_batches(df: DataFrame, put: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        df.writeStream.foreachBatch(put)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_updates(spark: SparkSession, path: str, keys: str | Iterable[str]) -> DataFrame:
    """Current value per key out of the folders :func:`drain_updates` wrote."""
    return deduplicate(spark.read.parquet(path), keys, "latest", "batch_id").drop("batch_id")
