"""Joins over named datasets and reference lookups."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    BROADCAST_ROWS,
    broadcast_if_small,
    col,
    fits_broadcast,
    fresh,
    names,
    require_columns,
    spread,
)

#: Accepted words and the Spark join type each one stands for.
JOIN_TYPES = {
    "inner": "inner",
    "left": "left",
    "left_outer": "left",
    "right": "right",
    "right_outer": "right",
    "full": "full",
    "outer": "full",
    "full_outer": "full",
    "semi": "left_semi",
    "left_semi": "left_semi",
    "anti": "left_anti",
    "left_anti": "left_anti",
}

# "a.x = b.y", the documented form of a condition; several may be chained with AND.
_EQUALITY = re.compile(r"^\s*(\w+)\.(\w+)\s*={1,2}\s*(\w+)\.(\w+)\s*$")


def join_type(how: str) -> str:
    try:
        return JOIN_TYPES[how.lower()]
    except KeyError:
        raise ValueError(f"join: type must be one of {sorted(JOIN_TYPES)}, got {how!r}") from None


def _pairs(condition: str, left_id: str, right_id: str) -> list[tuple[str, str]] | None:
    """Column pairs when the text is nothing but equalities between the two datasets."""
    pairs = []
    for part in re.split(r"\s+and\s+", condition.strip(), flags=re.IGNORECASE):
        found = _EQUALITY.match(part)
        if not found:
            return None
        a, x, b, y = found.groups()
        if (a, b) == (left_id, right_id):
            pairs.append((x, y))
        elif (a, b) == (right_id, left_id):
            pairs.append((y, x))
        else:
            return None
    return pairs


def _has_equality(left: DataFrame, right: DataFrame, condition: str) -> bool:
    """Whether Spark finds an equality between the two sides in the analysed condition.

    It is the planner's own extraction of join keys, so literals, NOT, OR and CASE are what
    Spark takes them for; no job runs.
    """
    try:
        plan = left.join(right, F.expr(condition), "inner")._jdf.queryExecution().analyzed()
    except AnalysisException as error:
        raise ValueError(f"join: the condition {condition!r} cannot be used: {error.getCondition()}") from error
    keys = left.sparkSession._jvm.org.apache.spark.sql.catalyst.planning.ExtractEquiJoinKeys
    return bool(keys.unapply(plan).isDefined())


def _equal(pairs: list[tuple[str, str]], left_id: str, right_id: str, null_safe: bool) -> Column:
    tests = []
    for x, y in pairs:
        a, b = col(x, left_id), col(y, right_id)
        tests.append(a.eqNullSafe(b) if null_safe else a == b)
    return reduce(lambda p, q: p & q, tests)


def join(
    left: DataFrame,
    right: DataFrame,
    condition: str | Iterable[str],
    how: str = "inner",
    left_id: str = "left",
    right_id: str = "right",
    select: Iterable[str] | None = None,
    null_safe: bool = False,
    split_outer: bool = True,
    grouped: str | Iterable[str] | None = None,
) -> DataFrame:
    """Join two datasets.

    ``condition`` is either a list of shared column names (``"k"``, ``"k1,k2"``; the key
    appears once in the result) or a SQL expression that names the datasets by their ids,
    such as ``orders.custkey = customer.id AND orders.day >= customer.since``. At least
    one equality is required: a join without one is a nested loop over both tables, and
    cross products are not offered.

    Null keys match nothing unless ``null_safe``. A right column whose name the left side
    also has is returned as ``<right_id>_<name>``; ``select`` (SQL expressions over the
    two ids) replaces the default column list.

    Inner, semi and anti joins are Spark's own, with adaptive skew splitting. Adaptive execution splits
    neither the null-supplying side of an outer join nor any side of a full one, so a hot key there
    would end in one task. Where such a side is too large to broadcast, one pass over its key columns (a sketch of
    frequent items, see ``hot_keys``) tells whether it has any. (A full join of which one side is small is split, as its
    parts can be broadcast.) Without hot keys the join is the native operator. With
    hot keys their rows, and only theirs, are joined as *matched rows* + *unmatched rows* (inner + anti,
    which can be split), and null keys that are hot bypass the exchange; inputs are then read once more per part,
    so stage one that is not deterministic first. ``split_outer=False`` asks for the native operator unmeasured.
    """
    kind = join_type(how)
    if left_id == right_id:
        raise ValueError("join: left_id and right_id must differ")
    if condition is None or (not isinstance(condition, str) and not names(condition)):
        raise ValueError("join: a condition is required")

    unknown = set(names(grouped)) - {left_id, right_id}
    if unknown:
        raise ValueError(f"join: grouped names {sorted(unknown)}, the sides are {left_id!r} and {right_id!r}")

    using: list[str] = []
    pairs: list[tuple[str, str]] | None
    if not isinstance(condition, str) or re.fullmatch(r"[\w\s,]+", condition):
        using = names(condition)
        pairs = [(k, k) for k in using]
    else:
        pairs = _pairs(condition, left_id, right_id)
        if pairs is None and not _has_equality(left.alias(left_id), right.alias(right_id), condition):
            raise ValueError("join: the condition needs at least one equality between the datasets")
    if pairs is not None:
        require_columns(left, [x for x, _ in pairs], "join left")
        require_columns(right, [y for _, y in pairs], "join right")

    def partner_is_hot(side: int) -> bool:
        """Whether the other side has keys worth splitting; where there are no columns to look at, yes."""
        return pairs is None or bool(hot_keys((right, left)[side], _common_keys(left, right, pairs, 1 - side), null_safe))

    ends = enumerate(((left, left_id), (right, right_id)))
    left, right = [spread(df) if own in names(grouped) and partner_is_hot(side) else df for side, (df, own) in ends]

    def on() -> Column:
        return _equal(pairs, left_id, right_id, null_safe) if pairs else F.expr(condition)

    def few_keys(df: DataFrame, side: int) -> DataFrame:
        return _few_copies(df, [pair[side] for pair in pairs]) if pairs else df

    if kind in ("left_semi", "left_anti"):
        tested = left.alias(left_id).join(few_keys(right, 1).alias(right_id), on(), kind)
        return tested if select is None else tested.selectExpr(*select)
    left_cols = [col(c, left_id).alias(c) for c in left.columns]
    renamed = {c: (f"{right_id}_{c}" if c in left.columns else c) for c in right.columns if c not in using}
    right_cols = [col(c, right_id).alias(n) for c, n in renamed.items()]
    out = [*left.columns, *renamed.values()]
    if select is None and len(set(out)) != len(out):
        raise ValueError(f"join: result columns are not unique: {out}; pass select=")

    def native(left: DataFrame, right: DataFrame) -> DataFrame:
        joined = left.alias(left_id).join(right.alias(right_id), on(), kind)
        if select is not None:
            return joined.selectExpr(*select)
        first = left_cols
        if kind != "inner":
            shared = {c: F.coalesce(col(c, left_id), col(c, right_id)).alias(c) for c in using}
            first = [shared.get(c, x) for c, x in zip(left.columns, left_cols)]
        return joined.select(*first, *right_cols)

    def shape(has_left: bool, has_right: bool) -> list[Column]:
        """The result columns of rows that have a left side, a right side or both."""
        if select is not None:  # one struct per side, so that `select` can name them by their ids
            return [_side(left, left_id, has_left), _side(right, right_id, has_right)]
        cols = left_cols if has_left else [
            col(c, right_id).alias(c) if c in using else _null(left, c, c) for c in left.columns
        ]
        return [*cols, *(right_cols if has_right else [_null(right, c, n) for c, n in renamed.items()])]

    def split(left: DataFrame, right: DataFrame) -> DataFrame:
        a, b = left.alias(left_id), right.alias(right_id)
        parts = [a.join(b, on(), "inner").select(*shape(True, True))]
        if kind in ("left", "full"):
            parts.append(a.join(few_keys(right, 1).alias(right_id), on(), "left_anti").select(*shape(True, False)))
        if kind in ("right", "full"):
            parts.append(b.join(few_keys(left, 0).alias(left_id), on(), "left_anti").select(*shape(False, True)))
        joined = reduce(DataFrame.unionAll, parts)
        return joined if select is None else joined.selectExpr(*select)

    def alone(left: DataFrame | None, right: DataFrame | None) -> DataFrame:
        """Rows of one side that cannot match."""
        rows = left.alias(left_id) if right is None else right.alias(right_id)
        shaped = rows.select(*shape(left is not None, right is not None))
        return shaped if select is None else shaped.selectExpr(*select)

    supplied = {"left": [right], "right": [left], "full": [left, right]}.get(kind, [])
    if not split_outer or (kind != "full" and all(map(fits_broadcast, supplied))):
        return native(left, right)
    if kind == "full" and any(map(fits_broadcast, supplied)):  # its parts can be broadcast, a full join cannot
        return split(left, right)
    equal = pairs if pairs is not None else _some_pairs(condition, left_id, right_id)
    if not equal:  # equal expressions rather than columns: there are no keys to look at
        return split(left, right)
    keys = [_common_keys(left, right, equal, side) for side in (0, 1)]
    sides = [(df, key) for df, key in zip((left, right), keys) if any(df is s for s in supplied)]
    hot = {k for df, key in sides for k in hot_keys(df, key, null_safe)}
    if not hot:
        return native(left, right)
    parts = []
    if None in hot:  # cannot match: such rows are taken around the join if they are kept
        absent = [_any_null(key) for key in keys]
        if kind in ("left", "full"):
            parts.append(alone(left.filter(absent[0]), None))
        if kind in ("right", "full"):
            parts.append(alone(None, right.filter(absent[1])))
        left, right = left.filter(~absent[0]), right.filter(~absent[1])
    hot = sorted(hot - {None})
    if hot:
        # Null keys stay with the others; saying so on both sides lets the parts share their exchanges.
        is_hot = [F.xxhash64(*key).isin(hot) & (F.lit(null_safe) | ~_any_null(key)) for key in keys]
        parts.append(split(left.filter(is_hot[0]), right.filter(is_hot[1])))
        left, right = left.filter(~is_hot[0]), right.filter(~is_hot[1])
    return reduce(DataFrame.unionAll, [native(left, right), *parts])


#: A key is hot if it has more rows than an even share of a shuffle partition, and more than this.
HOT_ROWS = 10_000
#: Frequent keys that are looked at, and keys the sketch keeps count of.
HOT_KEYS, TRACKED_KEYS = 1_000, 100_000


def hot_keys(df: DataFrame, keys: Iterable[Column], null_safe: bool = False) -> list[int | None]:
    """Hashes of the keys that hold more rows than an even share of a shuffle partition.

    Keys with a null in them count together as None, or like any other if ``null_safe``. One pass over the key columns
    with a sketch of frequent items per task. Estimates only choose the plan: they do not change any result.
    """
    keys = list(keys)
    key = F.when(F.lit(null_safe) | ~_any_null(keys), F.xxhash64(*keys))
    sketched = df.select(key.alias("key")).agg(
        F.expr(f"approx_top_k(key, {HOT_KEYS}, {TRACKED_KEYS})").alias("top"), F.count(F.lit(1)).alias("n")
    )
    found = sketched.first()
    share = found["n"] / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [r["item"] for r in found["top"] or [] if r["count"] > max(share, HOT_ROWS)]


def _any_null(keys: Iterable[Column]) -> Column:
    return reduce(lambda p, q: p | q, [k.isNull() for k in keys])


def _some_pairs(condition: str, left_id: str, right_id: str) -> list[tuple[str, str]]:
    """Column pairs of the equalities among a condition's parts, if it is a plain conjunction."""
    if re.search(r"\b(or|not|case|between)\b|['\"()]", condition, flags=re.IGNORECASE):
        return []
    parts = re.split(r"\s+and\s+", condition.strip(), flags=re.IGNORECASE)
    return [pair for part in parts for pair in _pairs(part, left_id, right_id) or []]


def _common_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], side: int) -> list[Column]:
    """The key columns of one side in the type both sides are compared in, so that equal keys have equal hashes."""
    keys = []
    for pair in pairs:
        kinds = [df.schema[name].dataType for df, name in zip((left, right), pair)]
        key = col(pair[side])
        if kinds[0] != kinds[1]:
            both = [F.lit(None).cast(kind) for kind in kinds]
            key = key.cast(left.sparkSession.range(1).select((F.coalesce(*both)).alias("key")).schema["key"].dataType)
        keys.append(key)
    return keys


def _null(df: DataFrame, column: str, name: str) -> Column:
    return F.lit(None).cast(df.schema[column].dataType).alias(name)


def _side(df: DataFrame, owner: str, present: bool) -> Column:
    """A whole side as one struct column named like the dataset."""
    if not present:
        return F.lit(None).cast(df.schema).alias(owner)
    return F.struct(*[col(c, owner).alias(c) for c in df.columns]).alias(owner)


#: Copies of one key that may remain on the testing side of a semi or anti join.
KEY_COPIES = 8


def _few_copies(df: DataFrame, keys: list[str]) -> DataFrame:
    """Only the key columns, each key at most ``KEY_COPIES`` times.

    Copies collapse before the exchange, so a hot key ships little. The salt keeps the result
    from being partitioned by the key alone: the join then adds its own exchange, and adaptive
    execution splits a hot partition of the other side only between two plain exchanges.
    """
    keys = list(dict.fromkeys(keys))
    salt = fresh("key_copy", keys)
    salted = df.select(*[col(k) for k in keys], F.pmod(F.spark_partition_id(), F.lit(KEY_COPIES)).alias(salt))
    return salted.distinct().select(*[col(k) for k in keys])


def lookup(
    df: DataFrame,
    ref: DataFrame,
    join_columns: str | Iterable[str] = "id",
    output_fields: str | Iterable[str] | None = None,
    how: str = "left",
    broadcast: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    prefix: str | None = None,
    ignore_missing: bool = False,
    unique: bool = False,
    grouped: bool = False,
) -> DataFrame:
    """Enrich ``df`` with fields of a reference table, matched on equal column names.

    The result has all columns of ``df``, then ``output_fields`` (named ``prefix + field``
    when a prefix is given). No output fields means no new columns; the join still drops
    unmatched rows (``how="inner"``) and repeats rows for repeated reference keys.
    ``unique=True`` refuses a reference with repeated keys.

    The reference is pruned to its key and the wanted fields first. Spark broadcasts it
    when its measured size is under the session threshold and shuffles it otherwise;
    ``broadcast=True`` raises that bound to ``broadcast_rows`` rows, counted before the
    hint is given, and falls back to the shuffle join beyond it. ``grouped`` says that the
    reference was just grouped by these keys (and may be large): if ``df`` has hot keys the reference is spread first,
    so that they can be split.
    """
    keys, fields = names(join_columns), names(output_fields)
    kind = join_type(how)
    if kind not in ("left", "inner"):
        raise ValueError(f"lookup: join type must be left or inner, got {how!r}")
    if not keys:
        raise ValueError("lookup: join_columns is required")
    require_columns(df, keys, "lookup source")
    require_columns(ref, keys, "lookup reference")
    if ignore_missing:
        fields = [f for f in fields if f in ref.columns]
    require_columns(ref, fields, "lookup reference")
    named = {f: f"{prefix or ''}{f}" for f in fields}
    clash = [n for n in named.values() if n in df.columns]
    if clash:
        raise ValueError(f"lookup: {clash} already exist in the source; use prefix=")

    slim = ref.select(*[col(c) for c in dict.fromkeys([*keys, *fields])])
    if unique:
        repeated = slim.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        if repeated.take(1):
            raise ValueError(f"lookup: the reference repeats keys in {keys}")
    if broadcast:
        slim, small = broadcast_if_small(slim, broadcast_rows)
        grouped = grouped and not small
    if grouped and hot_keys(df, _common_keys(df, slim, [(k, k) for k in keys], 0)):
        slim = spread(slim)
    test = _equal([(k, k) for k in keys], "src", "lkp", null_safe=False)
    return (
        df.alias("src")
        .join(slim.alias("lkp"), test, kind)
        .select(
            *[col(c, "src").alias(c) for c in df.columns],
            *[col(f, "lkp").alias(n) for f, n in named.items()],
        )
    )
