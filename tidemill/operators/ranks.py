"""Exact order statistics of groups of any size."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType

from ..functions import col, fits_broadcast, spread
from ..session import staged

#: Half the share of a group that lies between the two cut points around a wanted quantile.
MARGIN = 0.0005
#: Accuracy of the quantile sketch (its rank error is 1 / accuracy).
ACCURACY = 10_000
#: Values between two cut points that are put in order; more are narrowed again.
BAND = 200_000
#: Cut points of a further narrowing, as shares of what lies between the cut points before.
GRID = 100


@dataclass(frozen=True)
class Rank:
    """A wanted order statistic: the value at place ``at(n)`` (from 1) of ``n`` values, expected near a quantile."""

    name: str
    value: Column
    near: float
    at: Callable[[Column], Column]


def order_statistics(df: DataFrame, groups: Sequence[str], ranks: Sequence[Rank]) -> DataFrame:
    """Per group the values at all given ranks, nulls left out; a group without values has nulls.

    One method for groups of any size and number. No group is ever ordered whole, and what is
    compared, counted and returned are the values themselves in their own type:

    1. A quantile sketch per group and rank gives two cut points around the expected quantile.
    2. One pass counts, for all ranks, the values below, at, between and above them. The counts are exact, so
       they tell where a rank lies however good the sketch was: at a cut point, which is then the answer, or
       between two of them.
    3. Steps 1 and 2 are repeated between the cut points while more than BAND values lie there.
    4. The distinct values between the cut points are counted and ordered from the number before them.

    Steps read only groups and ranked columns; what is kept between them is one row per group. Values are numbers,
    dates or times.
    """
    kinds = []
    values = df.select(
        *[col(g).alias(f"g{i}") for i, g in enumerate(groups)], *[r.value.alias(f"v{i}") for i, r in enumerate(ranks)]
    )
    keys = [f"g{i}" for i in range(len(groups))]
    for i, rank in enumerate(ranks):
        kind = values.schema[f"v{i}"].dataType
        if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
            raise ValueError(f"ranks: {rank.name} is over {kind.simpleString()}; only numbers, dates and times have quantiles here")
        kinds.append(kind)
    places, few, done = _placed(values, keys, ranks, kinds)
    found = places.select(*keys, *[F.col(f"found{i}").alias(f"value{i}") for i in range(len(ranks))])
    if not done:
        found = found.unionAll(_ordered(values, keys, kinds, places, few))
        found = found.groupBy(*keys).agg(*[F.first(f"value{i}", ignorenulls=True).alias(f"value{i}") for i in range(len(ranks))])
    return found.select(
        *[F.col(f"g{i}").alias(g) for i, g in enumerate(groups)], *[F.col(f"value{i}").alias(r.name) for i, r in enumerate(ranks)]
    )


def _attached(values: DataFrame, keys: Sequence[str], table: DataFrame, few: bool) -> DataFrame:
    """``values`` with the columns of its group's row in ``table``; without groups that row is literals."""
    own = [c for c in table.columns if c not in keys]
    if not keys:
        row = table.first()
        return values.select("*", *[F.lit(row[c]).cast(table.schema[c].dataType).alias(c) for c in own])
    side = (table if few else spread(table)).alias("side")
    same = reduce(lambda a, b: a & b, [F.col(f"row.{k}").eqNullSafe(F.col(f"side.{k}")) for k in keys])
    joined = values.alias("row").join(side, same, "inner")
    return joined.select(*[F.col(f"row.{c}") for c in values.columns], *[F.col(f"side.{c}") for c in own])


def _inside(value: Column, low: Column, high: Column) -> Column:
    """Strictly between two bounds, of which a null one is open."""
    return value.isNotNull() & (low.isNull() | (value > low)) & (high.isNull() | (value < high))


def _placed(
    values: DataFrame, keys: Sequence[str], ranks: Sequence[Rank], kinds: Sequence[DataType]
) -> tuple[DataFrame, bool, bool]:
    """``(places, few, done)``. Per group and rank a place has ``found``, or ``low, high`` around it with ``start`` values
    up to ``low`` and ``size`` between. ``few``: the groups' rows are broadcast; ``done``: all are found."""
    n = range(len(ranks))
    points = [[max(r.near - MARGIN, 0.0), min(r.near + MARGIN, 1.0)] for r in ranks]
    alike = _alike(ranks)
    sketch = [F.percentile_approx(f"v{i}", points[i], ACCURACY).alias(f"cuts{i}") for i in n if alike[i] == i]
    ends = [F.get(f"cuts{alike[i]}", F.lit(k)).alias(f"{c}{i}") for i in n for k, c in enumerate("ab")]
    unbounded = [F.lit(None).cast(kinds[i]).alias(f"{c}{i}") for i in n for c in ("low", "high")]
    nothing = [F.lit(0).cast("long").alias(f"start{i}") for i in n]
    cuts = staged(values.groupBy(*keys).agg(*sketch).select(*keys, *ends, *unbounded, *nothing), "rank-cuts")
    few = bool(keys) and fits_broadcast(cuts)  # by the size of the files just written
    places = _counted(values, keys, ranks, cuts, few, first=True)
    before = None
    while True:
        open_sizes = [F.max(F.when(F.col(f"found{i}").isNull(), F.col(f"size{i}"))) for i in n]
        largest = max(size or 0 for size in places.agg(*open_sizes).first())
        if largest <= BAND or (before is not None and largest >= before):
            return places, few, largest == 0
        before = largest
        places = _narrowed(values, keys, ranks, places, few)


def _alike(ranks: Sequence[Rank]) -> list[int]:
    """For each rank the first one of the same value expected at the same quantile: they begin with the same cut points."""
    return [next(k for k, r in enumerate(ranks) if r.value is rank.value and r.near == rank.near) for rank in ranks]


def _narrowed(values: DataFrame, keys: Sequence[str], ranks: Sequence[Rank], places: DataFrame, few: bool) -> DataFrame:
    """One more round between the bounds of ``places``: the sketch's grid around the rank's share of what lies there."""
    rows = _attached(values, keys, places, few)
    shares = [k / GRID for k in range(GRID + 1)]
    carried = [c for c in places.columns if c not in keys]
    sketch = []
    for i in range(len(ranks)):
        own = _inside(F.col(f"v{i}"), F.col(f"low{i}"), F.col(f"high{i}"))
        sketch.append(F.percentile_approx(F.when(own, F.col(f"v{i}")), shares, ACCURACY).alias(f"cuts{i}"))
    grids = rows.groupBy(*keys).agg(*sketch, *[F.first(c).alias(c) for c in carried])
    around = []
    for i in range(len(ranks)):
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        step = F.floor((F.col(f"at{i}") - F.col(f"start{i}")) * GRID / F.greatest(F.col(f"size{i}"), F.lit(1))).cast("int")
        for name, place in (("a", F.greatest(step - 1, F.lit(0))), ("b", F.least(step + 2, F.lit(GRID)))):
            # A sketch of large integers is rounded: its cut points are held between the bounds.
            around.append(F.least(F.greatest(F.get(f"cuts{i}", place), low), high).alias(f"{name}{i}"))
    cuts = staged(grids.select(*keys, *carried, *around), "rank-cuts")
    return _counted(values, keys, ranks, cuts, few, first=False)


def _counted(values: DataFrame, keys: Sequence[str], ranks: Sequence[Rank], cuts: DataFrame, few: bool, first: bool) -> DataFrame:
    """Count the values around the cut points ``a`` and ``b`` of each rank and close in on the rank."""
    counts, like = [], _alike(ranks) if first else list(range(len(ranks)))
    for i in sorted(set(like)):
        v, a, b = F.col(f"v{i}"), F.col(f"a{i}"), F.col(f"b{i}")
        own = _inside(v, F.col(f"low{i}"), F.col(f"high{i}"))
        tests = {"below": v < a, "at_a": v == a, "middle": (v > a) & (v < b), "at_b": (v == b) & (a < b), "above": v > F.greatest(a, b)}
        counts += [F.count_if(own & test).alias(f"{name}{i}") for name, test in tests.items()]
    carried = [F.first(c).alias(c) for c in cuts.columns if c not in keys]
    table = _attached(values, keys, cuts, few).groupBy(*keys).agg(*counts, *carried)
    out = [F.col(k) for k in keys]
    for i, rank in enumerate(ranks):
        a, b, low, high = (F.col(f"{c}{i}") for c in ("a", "b", "low", "high"))
        parts = [F.col(f"{c}{like[i]}") for c in ("below", "at_a", "middle", "at_b", "above")]
        at = rank.at(sum(parts[1:], parts[0])).cast("long") if first else F.col(f"at{i}")
        starts = [F.col(f"start{i}")]
        for part in parts:
            starts.append(starts[-1] + part)

        def chosen(choices: Sequence[Column], at=at, starts=starts) -> Column:
            """The choice for the part that holds the rank."""
            out = F.when(at <= starts[1], choices[0])
            for end, choice in zip(starts[2:5], choices[1:4]):
                out = out.when(at <= end, choice)
            return out.otherwise(choices[4])

        none = F.lit(None)
        here = chosen([none, a, none, b, none])
        out += [
            (here if first else F.coalesce(f"found{i}", here)).alias(f"found{i}"),
            chosen([low, a, a, b, F.greatest(a, b)]).alias(f"low{i}"),
            chosen([a, a, b, b, high]).alias(f"high{i}"),
            chosen(starts[:5]).alias(f"start{i}"),
            chosen(parts).alias(f"size{i}"),
            at.alias(f"at{i}"),
        ]
    return staged(table.select(*out), "rank-places")


def _value_counts(values: DataFrame, keys: Sequence[str], wanted: Sequence[tuple[Column, Column]], carry: Sequence[str] = ()) -> DataFrame:
    """Distinct values of several columns per group in one pass: ``keys, which, value, freq``.

    ``wanted`` pairs each value with the test for rows that count. ``value`` has one field per column, of which
    the others are null, so that every column keeps its type.
    """
    fields = len(wanted)
    kinds = [values.select(v).schema[0].dataType for v, _ in wanted]

    def entry(i: int) -> Column:
        own = [(wanted[k][0] if k == i else F.lit(None).cast(kinds[k])).alias(f"x{k}") for k in range(fields)]
        return F.struct(F.lit(i).alias("which"), F.struct(*own).alias("value"))

    entries = F.array(*[F.when(test & v.isNotNull(), entry(i)) for i, (v, test) in enumerate(wanted)])
    each = values.select(*keys, *carry, F.explode(entries).alias("entry")).filter("entry IS NOT NULL")
    first = [F.first(c).alias(c) for c in carry]
    return each.groupBy(*keys, F.col("entry.which").alias("which"), F.col("entry.value").alias("value")).agg(F.count(F.lit(1)).alias("freq"), *first)


def _ordered(values: DataFrame, keys: Sequence[str], kinds: Sequence[DataType], places: DataFrame, few: bool) -> DataFrame:
    """The values at the ranks that are not found yet, from those between their bounds."""
    n = range(len(kinds))
    rows = _attached(values, keys, places, few)
    wanted = [
        (F.col(f"v{i}"), F.col(f"found{i}").isNull() & _inside(F.col(f"v{i}"), F.col(f"low{i}"), F.col(f"high{i}"))) for i in n
    ]
    carry = [f"{c}{i}" for i in n for c in ("start", "at")]
    counted = _value_counts(rows, keys, wanted, carry)
    running = Window.partitionBy(*keys, "which").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("upto", F.sum("freq").over(running))
    picked = []
    for i in n:
        place = F.col(f"at{i}") - F.col(f"start{i}")
        here = (F.col("which") == i) & (F.col("upto") - F.col("freq") < place) & (place <= F.col("upto"))
        picked.append(F.max(F.when(here, F.col(f"value.x{i}"))).alias(f"value{i}"))
    return placed.groupBy(*keys).agg(*picked)


def medians(df: DataFrame, groups: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Exact medians per group as doubles, named by the keys of ``columns``, all in the same passes.

    The two middle values are found in their own type; text is read as a number.
    """
    ranks = []
    for alias, name in columns.items():
        value = col(name) if isinstance(df.schema[name].dataType, NumericType) else col(name).cast("double")
        ranks.append(Rank(f"{alias} low", value, 0.5, lambda n: F.floor((n + 1) / 2)))
        ranks.append(Rank(f"{alias} high", value, 0.5, lambda n: F.floor((n + 2) / 2)))
    found = order_statistics(df, groups, ranks)
    both = [((col(f"{a} low").cast("double") + col(f"{a} high").cast("double")) / 2).alias(a) for a in columns]
    return found.select(*[col(g) for g in groups], *both)


def percentiles(df: DataFrame, groups: Sequence[str], value: Column, points: Mapping[str, float]) -> DataFrame:
    """Nearest-rank percentiles per group in the value's own type: the smallest value that a share ``p`` does not exceed."""
    ranks = [
        Rank(name, value, p, lambda n, p=p: F.greatest(F.ceil(n * F.lit(p)), F.lit(1))) for name, p in points.items()
    ]
    return order_statistics(df, groups, ranks)


def modes(df: DataFrame, groups: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Most frequent value of each column per group, the smallest one on ties. One pass, two partial aggregations."""
    keys = [f"g{i}" for i in range(len(groups))]
    values = df.select(*[col(g).alias(k) for k, g in zip(keys, groups)], *[col(c).alias(f"v{i}") for i, c in enumerate(columns.values())])
    counted = _value_counts(values, keys, [(F.col(f"v{i}"), F.lit(True)) for i in range(len(columns))])
    picked = []
    for i, alias in enumerate(columns):
        least = F.min(F.when(F.col("which") == i, F.struct((-F.col("freq")).alias("less"), F.col(f"value.x{i}").alias("value"))))
        picked.append(least["value"].alias(alias))
    return counted.groupBy(*keys).agg(*picked).select(*[F.col(k).alias(g) for k, g in zip(keys, groups)], *[col(a) for a in columns])
