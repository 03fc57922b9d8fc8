"""Global sort."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import col, fresh, names, quoted, require_columns
from ..session import staged


def ordering(order_by: list[str], direction: str | Iterable[str], nulls: str | None) -> list[Column]:
    """Sort expressions; Spark's defaults (asc: nulls first, desc: nulls last) unless told."""
    ways = [w.lower() for w in names(direction)]
    if len(ways) == 1:
        ways = ways * len(order_by)
    if len(ways) != len(order_by):
        raise ValueError("sort: give one direction, or one per column")
    if any(w not in ("asc", "desc") for w in ways):
        raise ValueError(f"sort: direction must be asc or desc, got {direction!r}")
    if nulls not in (None, "first", "last"):
        raise ValueError(f"sort: nulls must be first or last, got {nulls!r}")
    suffix = f"_nulls_{nulls}" if nulls else ""
    return [getattr(col(c), way + suffix)() for c, way in zip(order_by, ways)]


def sort(
    df: DataFrame,
    order_by: str | Iterable[str],
    direction: str | Iterable[str] = "asc",
    nulls: str | None = None,
    split_ties: bool = True,
    position: str | None = None,
) -> DataFrame:
    """Total order over the whole table (sort last: a later shuffle loses it).

    Range partitioning sends all rows of one sort value to one task. With
    ``split_ties`` the input partition id closes the sort key, so a value that holds
    a large share of the rows spreads over several ranges. The id of a task does not
    change when the task is run again, which keeps retries consistent.

    ``position`` names a column for each row's place, from 1. It makes the order part of the data, so that it
    outlives later shuffles and can be checked (see :func:`with_position`).
    """
    order = names(order_by)
    if not order:
        raise ValueError("sort: order_by is required")
    require_columns(df, order, "sort")
    keys = ordering(order, direction, nulls)
    if split_ties:
        part = fresh("source_partition", df.columns)
        ordered = df.withColumn(part, F.spark_partition_id()).orderBy(*keys, col(part)).drop(part)
    else:
        ordered = df.orderBy(*keys)
    return ordered if position is None else with_position(ordered, position)


def with_position(df: DataFrame, position: str = "position") -> DataFrame:
    """``df`` with the place of each row from 1, in the order of its partitions and of the rows within.

    The rows are written to the shared folder once, each with its number within its partition. Partitions are
    counted, and each starts where those before it end: one small row per partition is all that is added up in one
    place, and no task sees more than its own rows. Without an order in ``df`` the places are arbitrary.
    """
    if position in df.columns:
        raise ValueError(f"sort: {position!r} already exists")
    at, part, start = (fresh(n, [*df.columns, position]) for n in ("row_at", "row_part", "part_start"))
    rows = staged(df.withColumn(at, F.monotonically_increasing_id()), "sorted")
    part_of = F.shiftrightunsigned(col(at), 33)
    counts = rows.groupBy(part_of.alias(part)).agg(F.count(F.lit(1)).alias("n"))
    before = F.expr(f"sum(n) OVER (ORDER BY {quoted(part)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n")
    starts = counts.select(col(part), before.alias(start))
    within = col(at) - F.shiftleft(col(part), 33)
    placed = rows.withColumn(part, part_of).join(starts, part).withColumn(position, col(start) + within + 1)
    return placed.select(*[col(c) for c in df.columns], col(position))
