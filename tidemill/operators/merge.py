"""Union-merge and keyed upsert."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import col, fresh, names, require_columns
from .dedup import deduplicate
from .join import join


def merge(
    source: DataFrame,
    target: DataFrame | None,
    keys: str | Iterable[str] | None = None,
    order_by: str | Iterable[str] | None = None,
    target_unique: bool = False,
    newest_wins: bool = False,
) -> DataFrame:
    """Bring ``source`` into ``target``.

    No target: the source passes through. No keys: union by column name, columns of one
    side only are null on the other, duplicates stay. With keys: one row per key (null
    keys equal), **source wins**; within one side the largest ``order_by`` wins, and
    without ``order_by`` an arbitrary row of that side.

    The keyed form is one exchange over the union. The ``row_number = 1`` filter becomes
    a group limit below the exchange, so a hot key ships one row per map task.

    ``target_unique`` says that the target already holds one row per key, as every merge
    leaves it. Then only target rows whose key the source has must go: an anti join against
    the source's keys, which a small source turns into a broadcast, so that a huge target is
    not shuffled at all.

    ``newest_wins`` compares ``order_by`` across both sides: a source row older than the
    target's does not replace it, and on a tie the source wins.
    """
    if target is None:
        return source
    union = lambda a, b: a.unionByName(b, allowMissingColumns=True)
    keys, order = names(keys), names(order_by)
    if not keys:
        return union(source, target)
    require_columns(source, keys, "merge source")
    require_columns(target, keys, "merge target")
    if newest_wins and not order:
        raise ValueError("merge: newest_wins needs order_by")
    if target_unique and newest_wins:
        # Only the target rows whose key the source has are compared; the others pass as they are.
        newest = deduplicate(source, keys, "latest", order)
        met, rest = (
            join(target, newest, keys, how, left_id="target", right_id="source", null_safe=True)
            for how in ("semi", "anti")
        )
        return union(merge(newest, met, keys, order, newest_wins=True), rest)
    if target_unique:
        newest = deduplicate(source, keys, "latest" if order else "any", order)
        rest = join(target, source, keys, "anti", left_id="target", right_id="source", null_safe=True)
        return union(newest, rest)
    side = fresh("merge_side", [*source.columns, *target.columns])
    rank = fresh("merge_rank", [*source.columns, *target.columns])
    both = union(source.withColumn(side, F.lit(0)), target.withColumn(side, F.lit(1)))
    require_columns(both, order, "merge")
    newest_first = [col(c).desc_nulls_last() for c in order]
    precedence = [*newest_first, col(side)] if newest_wins else [col(side), *newest_first]
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*precedence)
    return both.withColumn(rank, F.row_number().over(window)).filter(col(rank) == 1).drop(side, rank)
