"""Grouped, windowed and multi-level aggregation from ``func:column`` metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import col, fresh, names, require_columns
from .ranks import medians, modes

#: Aggregates Spark computes with partial aggregation and a bounded buffer per group.
SIMPLE: dict[str, Callable[[Column], Column]] = {
    "count": F.count,
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.mean,
    "min": F.min,
    "max": F.max,
    "count_distinct": F.count_distinct,
    "countDistinct": F.count_distinct,
    "sum_distinct": F.sum_distinct,
    "sumDistinct": F.sum_distinct,
    "approx_count_distinct": F.approx_count_distinct,
    "stddev": F.stddev,
    "std": F.std,
    "stddev_samp": F.stddev_samp,
    "stddev_pop": F.stddev_pop,
    "variance": F.variance,
    "var_samp": F.var_samp,
    "var_pop": F.var_pop,
    "skewness": F.skewness,
    "kurtosis": F.kurtosis,
    "first": F.first,
    "last": F.last,
    "first_value": F.first_value,
    "last_value": F.last_value,
    "any_value": F.any_value,
    "bool_and": F.bool_and,
    "every": F.every,
    "bool_or": F.bool_or,
    "some": F.some,
    "count_if": F.count_if,
    "bit_and": F.bit_and,
    "bit_or": F.bit_or,
    "bit_xor": F.bit_xor,
    "product": F.product,
    "try_sum": F.try_sum,
    "try_avg": F.try_avg,
}

def _joined(items: Column) -> Column:
    """Comma-separated text; null when there was nothing to join."""
    return F.when(F.size(items) > 0, F.array_join(items, ","))


#: Aggregates whose result holds the whole group in one cell.
COLLECTING: dict[str, Callable[[Column], Column]] = {
    "collect_list": F.collect_list,
    "array_agg": F.array_agg,
    "collect_set": F.collect_set,
    "listagg": lambda c: _joined(F.collect_list(c.cast("string"))),
    "string_agg": lambda c: _joined(F.collect_list(c.cast("string"))),
    "listagg_distinct": lambda c: _joined(F.collect_set(c.cast("string"))),
}
_COLLECT_DISTINCT = ("collect_set", "listagg_distinct")

#: Aggregates that need the order or the frequency of a group's values.
RANKED = ("median", "mode")


def parse_metric(metric: str) -> tuple[str, str, str]:
    """``func:column`` to (func, column, result name); bare ``count`` counts rows."""
    func, _, column = (p.strip() for p in metric.partition(":"))
    if not column:
        if func != "count":
            raise ValueError(f"aggregate: metric {metric!r} needs a column, as in {func}:amount")
        column = "*"
    if func not in SIMPLE and func not in COLLECTING and func not in RANKED:
        raise ValueError(f"aggregate: unknown function {func!r}")
    if column == "*" and func != "count":
        raise ValueError(f"aggregate: {func} cannot take '*'")
    return func, column, f"{func}_{column.replace('*', 'rows')}"


def _expression(func: str, column: str, alias: str) -> Column:
    if column == "*":
        return F.count(F.lit(1)).alias(alias)
    return {**SIMPLE, **COLLECTING}[func](col(column)).alias(alias)


def _parse(df: DataFrame, groups: list[str], metrics: str | Iterable[str]) -> list[tuple[str, str, str]]:
    parsed = [parse_metric(m) for m in names(metrics)]
    if not parsed:
        raise ValueError("aggregate: at least one metric is required")
    require_columns(df, [*groups, *[c for _, c, _ in parsed if c != "*"]], "aggregate")
    return parsed


def aggregate(
    df: DataFrame,
    group_by: str | Iterable[str] | None,
    metrics: str | Iterable[str],
    max_items: int | None = None,
) -> DataFrame:
    """Group and aggregate; null group keys form a group; no keys gives one total row.

    ``metrics`` are ``func:column`` (``count:*`` or bare ``count`` for rows); results are
    named ``func_column`` (``count_rows``).

    ``median`` and ``mode`` are exact and never hold a group in one buffer (see
    :mod:`.ranks`). Collecting functions put a whole group into one
    cell. ``max_items`` is an optional guard: the groups are counted first and a larger one raises
    instead of being cut.
    """
    groups = names(group_by)
    parsed = _parse(df, groups, metrics)
    keys = [col(g) for g in groups]
    if max_items is not None and any(f in COLLECTING for f, _, _ in parsed):
        _check_items(df, groups, [(f, c) for f, c, _ in parsed if f in COLLECTING], max_items)

    simple = [m for m in parsed if m[0] not in RANKED]
    ranked = [m for m in parsed if m[0] in RANKED]
    if not ranked:
        return df.groupBy(*keys).agg(*[_expression(*m) for m in simple])

    # One narrow frame for all medians and one for all modes, stacked under the plain result and
    # folded by group: each metric is non-null in one frame only, so `first` has nothing to choose.
    row_count = fresh("group_rows", df.columns)
    base = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(row_count), *[_expression(*m) for m in simple])
    frames = [base]
    for function, wanted in (("median", medians), ("mode", modes)):
        columns = {a: c for f, c, a in ranked if f == function}
        if columns:
            frames.append(wanted(df, groups, columns))
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.first(col(a), ignorenulls=True).alias(a) for _, _, a in parsed])


def _check_items(df: DataFrame, groups: list[str], wanted: list[tuple[str, str]], limit: int) -> None:
    # Rows bound distinct values from above, so the dearer distinct count is rarely needed.
    for counting in (lambda f: F.count, lambda f: F.count_distinct if f in _COLLECT_DISTINCT else F.count):
        sizes = [counting(f)(col(c)).alias(f"n{i}") for i, (f, c) in enumerate(wanted)]
        per_group = df.groupBy(*[col(g) for g in groups]).agg(*sizes)
        largest = per_group.agg(*[F.coalesce(F.max(f"n{i}"), F.lit(0)) for i in range(len(wanted))]).first()
        over = [(func, column, size) for (func, column), size in zip(wanted, largest) if size > limit]
        if not over:
            return
    func, column, size = over[0]
    raise ValueError(f"aggregate: {func}:{column} has a group of {size} items, over max_items={limit}")


def aggregate_levels(
    df: DataFrame,
    metrics: str | Iterable[str],
    rollup: str | Iterable[str] | None = None,
    cube: str | Iterable[str] | None = None,
    sets: Iterable[Iterable[str]] | None = None,
    level: str | None = None,
) -> DataFrame:
    """Totals over several groupings in one pass: ``rollup``, ``cube`` or explicit ``sets``.

    A column that a row is totalled over is null; ``level`` adds Spark's grouping id, which
    tells such a null from a null key.
    """
    given = [m for m in (rollup, cube, sets) if m is not None]
    if len(given) != 1:
        raise ValueError("aggregate_levels: give exactly one of rollup, cube, sets")
    if sets is not None:
        wanted = [names(s) for s in sets]
        columns = list(dict.fromkeys(c for s in wanted for c in s))
    else:
        columns = names(given[0])
    parsed = _parse(df, columns, metrics)
    if any(f not in SIMPLE for f, _, _ in parsed):
        raise ValueError("aggregate_levels: median, mode and collecting functions need aggregate()")
    keys = [col(c) for c in columns]
    if sets is not None:
        grouped = df.groupingSets([[col(c) for c in s] for s in wanted], *keys)
    else:
        grouped = df.rollup(*keys) if rollup is not None else df.cube(*keys)
    extra = [F.grouping_id().alias(level)] if level else []
    return grouped.agg(*extra, *[_expression(*m) for m in parsed])


def aggregate_window(
    df: DataFrame,
    time: str,
    window: str,
    group_by: str | Iterable[str] | None,
    metrics: str | Iterable[str],
    max_items: int | None = None,
) -> DataFrame:
    """Aggregate per calendar period: ``daily``, ``weekly`` (from Monday), ``monthly`` or any
    interval such as ``6 hours``. The period's start is returned as ``window_start``, null for
    rows without a time.
    """
    require_columns(df, [time], "aggregate_window")
    groups = [*names(group_by), "window_start"]
    units = {"daily": "day", "weekly": "week", "monthly": "month"}
    if window in units:
        return aggregate(df.withColumn("window_start", F.date_trunc(units[window], col(time))), groups, metrics, max_items)
    # `window` leaves out rows without a time: they go in under a stand-in and come out as null, in the same scan.
    stand_in = F.coalesce(col(time), F.lit("1970-01-01").cast(df.schema[time].dataType))
    start = F.when(col(time).isNotNull(), F.window(stand_in, window)["start"])
    return aggregate(df.withColumn("window_start", start), groups, metrics, max_items)


#: How each rolling metric folds daily results: (daily aggregate, fold over the days).
_FOLD = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def aggregate_rolling(
    df: DataFrame,
    time: str,
    days: int,
    group_by: str | Iterable[str] | None,
    metrics: str | Iterable[str],
) -> DataFrame:
    """Per group and day, metrics over that day and the ``days - 1`` days before it.

    Rows are first reduced to one partial result per group and day, so the range frame sees
    at most one row per calendar day and group however many rows a group has.
    """
    groups = names(group_by)
    require_columns(df, [time], "aggregate_rolling")
    parsed = _parse(df, groups, metrics)
    if any(f not in (*_FOLD, "avg", "mean") for f, _, _ in parsed):
        raise ValueError("aggregate_rolling: use count, sum, avg, min or max")
    daily, folded = [], []
    epoch = F.date_diff(F.col("day"), F.lit("1970-01-01").cast("date"))
    frame = Window.partitionBy(*[col(g) for g in groups]).orderBy(epoch).rangeBetween(-(days - 1), 0)
    for i, (func, column, alias) in enumerate(parsed):
        if func in ("avg", "mean"):
            daily += [F.sum(col(column)).alias(f"s{i}"), F.count(col(column)).alias(f"n{i}")]
            folded.append((F.sum(f"s{i}").over(frame) / F.nullif(F.sum(f"n{i}").over(frame), F.lit(0))).alias(alias))
        else:
            daily.append(_expression(func, column, f"s{i}"))
            folded.append(_FOLD[func](f"s{i}").over(frame).alias(alias))
    per_day = df.groupBy(*[col(g) for g in groups], F.to_date(col(time)).alias("day")).agg(*daily)
    return per_day.select(*[col(g) for g in groups], "day", *folded)
