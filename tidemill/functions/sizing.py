"""Size checks that stand in front of anything that needs a small input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from .names import col

#: Largest reference that is ever broadcast on request (rows after column pruning).
BROADCAST_ROWS = 200_000
#: Largest reference that is ever broadcast on request, by the bytes of its values.
BROADCAST_BYTES = 256 * 1024**2


def within_rows(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows.

    ``take`` reads partitions step by step and stops after ``limit + 1`` rows, so the
    check on a huge table touches a handful of tasks; only literals reach the driver.
    """
    return len(df.select(F.lit(1).alias("one")).take(limit + 1)) <= limit


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes the values of a row take."""

    def one(field) -> Column:
        kind, value = field.dataType, col(field.name)
        if isinstance(kind, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
        if isinstance(kind, (ArrayType, MapType, StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("v")))), F.lit(0)).cast("long")
        return F.lit(8).cast("long")

    return reduce(lambda a, b: a + b, map(one, df.schema.fields), F.lit(8).cast("long"))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``(hinted frame, True)`` when both bounds hold, else ``(df, False)``.

    Bytes are only summed for a frame within the row bound.
    """
    if within_rows(df, limit) and (df.agg(F.sum(_row_bytes(df))).first()[0] or 0) <= max_bytes:
        return F.broadcast(df), True
    return df, False


def fits_broadcast(df: DataFrame) -> bool:
    """True when Spark's own size estimate is within its broadcast threshold.

    This is the test by which the planner picks a broadcast join; no job is run.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return 0 <= estimate <= limit


def spread(df: DataFrame) -> DataFrame:
    """Give up the partitioning a grouping left behind.

    A join on the grouping's own keys would reuse that partitioning and skip its exchange, and
    adaptive execution splits a hot partition of the other side only between two plain
    exchanges. One more exchange of the grouped (collapsed) side buys that back.
    """
    return df.hint("rebalance")
