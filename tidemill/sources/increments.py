"""Incremental loads that remember: the mark of the last load, and which rows at the mark it already had."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..functions import col, fresh, require_columns
from ..operators.mask import record_hash
from ..session import staged
from .files import children, discard, publish_small, read_small

#: States that stay: the current one, and the one before for who is reading it.
KEPT_STATES = 2


class Increment(NamedTuple):
    """Rows to load, and what to call once they are loaded."""

    rows: DataFrame
    commit: Callable[[], None]


def _states(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in children(spark, path) if n.endswith(".json"))


def load_increment(source: DataFrame, state: str, watermark: str) -> Increment:
    """Rows of ``source`` that no committed load had, by a watermark and the state kept under ``state``.

    New are rows above the mark, rows at the mark that the loads before did not have, and rows without a watermark that
    they did not have. Rows are the same if all their columns are; repeated rows of one load are all loaded. A row that
    comes late with a watermark below the mark is not seen: choose a watermark that only grows.

    The state is the mark and the hashes of the rows at the mark and of those without one. The rows are computed once,
    into the shared folder, and the state is made from that copy. It is replaced by ``commit``, whole or
    not at all; without it the next load brings the same rows again. Only the mark reaches the driver; as a
    literal it is pushed into the source's scan.
    """
    spark, state = source.sparkSession, state.rstrip("/")
    require_columns(source, [watermark], "load_increment")
    kind, key = source.schema[watermark].dataType, fresh("row_hash", source.columns)
    numbers = _states(spark, state)
    known = json.loads(read_small(spark, f"{state}/{numbers[-1]:08d}.json")) if numbers else None
    value = F.unix_micros(col(watermark)) if isinstance(kind, TimestampType) else col(watermark)

    def bound(mark: str):
        return F.timestamp_micros(F.lit(int(mark))) if isinstance(kind, TimestampType) else F.lit(mark).cast(kind)

    rows = source
    if known is not None:
        loaded = spark.read.schema("hash string").parquet(f"{state}/{known['rows']}")
        above = source.filter(col(watermark) > bound(known["mark"])) if known["mark"] is not None else source.filter(col(watermark).isNotNull())
        doubtful = col(watermark).isNull()
        if known["mark"] is not None:
            doubtful = doubtful | (col(watermark) == bound(known["mark"]))
        some = record_hash(source.filter(doubtful), source.columns, key)
        unseen = some.join(loaded, col(key) == F.col("hash"), "left_anti").drop(key)
        rows = above.unionByName(unseen)
    rows = staged(rows, "increment")

    def commit() -> None:
        newest = rows.agg(F.max(value).cast("string").alias("mark")).first()["mark"]
        before = known["mark"] if known is not None else None
        mark = newest if newest is not None else before
        at_mark = col(watermark).isNull()
        if mark is not None:
            at_mark = at_mark | (col(watermark) == bound(mark))
        hashes = record_hash(rows.filter(at_mark), source.columns, key).select(col(key).alias("hash"), col(watermark).isNull().alias("unmarked"))
        if known is not None:
            old = spark.read.schema("hash string, unmarked boolean").parquet(f"{state}/{known['rows']}")
            hashes = hashes.unionAll(old if mark == before else old.filter("unmarked"))
        folder = f"rows-{uuid.uuid4().hex}"
        hashes.distinct().write.parquet(f"{state}/{folder}")
        number = numbers[-1] + 1 if numbers else 1
        publish_small(spark, f"{state}/{number:08d}.json", json.dumps({"mark": mark, "rows": folder}))
        for old_number in numbers[: -(KEPT_STATES - 1) or None]:
            gone = json.loads(read_small(spark, f"{state}/{old_number:08d}.json"))["rows"]
            discard(spark, f"{state}/{old_number:08d}.json")
            discard(spark, f"{state}/{gone}")

    return Increment(rows, commit)
