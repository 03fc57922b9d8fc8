"""Deduplication and golden records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import col, fresh, names, require_columns

KEEP = ("any", "first", "last", "latest", "earliest")


def deduplicate(
    df: DataFrame,
    keys: str | Iterable[str],
    keep: str = "any",
    order_by: str | Iterable[str] | None = None,
    tie_breaker: str | Iterable[str] | None = None,
) -> DataFrame:
    """One row per key; null keys are equal to each other.

    * ``any`` keeps an arbitrary row per key and needs no order.
    * ``first`` / ``earliest`` keep the smallest row by ``order_by`` (nulls first),
      ``last`` / ``latest`` the largest (nulls last). They require ``order_by``:
      a distributed table has no row position of its own.
    * ``tie_breaker`` columns follow ``order_by`` in the same direction.
    * empty ``keys`` means distinct over the whole row.

    Hot keys stay cheap: ``any`` is a partial aggregate, and Catalyst turns the
    ``row_number = 1`` filter into a group limit that runs before the exchange, so
    each map task ships at most one row per key.
    """
    keys, order, ties = names(keys), names(order_by), names(tie_breaker)
    if keep not in KEEP:
        raise ValueError(f"deduplicate: keep must be one of {KEEP}, got {keep!r}")
    require_columns(df, [*keys, *order, *ties], "deduplicate")
    if not keys:
        return df.distinct()
    if keep == "any":
        return df.dropDuplicates(keys)
    if not order:
        raise ValueError(f"deduplicate: keep={keep!r} needs order_by (use keep='any' for an arbitrary row)")
    if keep in ("first", "earliest"):
        ordering = [col(c).asc_nulls_first() for c in order + ties]
    else:
        ordering = [col(c).desc_nulls_last() for c in order + ties]
    rank = fresh("row_rank", df.columns)
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*ordering)
    return df.withColumn(rank, F.row_number().over(window)).filter(col(rank) == 1).drop(rank)


def golden_record(
    df: DataFrame,
    keys: str | Iterable[str],
    order_by: str | Iterable[str],
    columns: str | Iterable[str] | None = None,
) -> DataFrame:
    """Survivorship: per key and column the newest value that is not null.

    ``order_by`` should be total within a key, otherwise equal rows tie arbitrarily.
    ``max_by`` ignores rows whose ordering is null, so the null test lives there and
    every column is filled in the same aggregation pass.
    """
    keys, order = names(keys), names(order_by)
    if not keys or not order:
        raise ValueError("golden_record: keys and order_by are required")
    picked = names(columns) or [c for c in df.columns if c not in keys]
    require_columns(df, [*keys, *order, *picked], "golden_record")
    newest = F.struct(*[col(c) for c in order])
    return df.groupBy(*[col(k) for k in keys]).agg(
        *[F.max_by(col(c), F.when(col(c).isNotNull(), newest)).alias(c) for c in picked]
    )
