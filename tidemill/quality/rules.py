"""Data-quality rules evaluated as aggregates, and the row split they imply."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from ..functions import col, names, require_columns


#: The texts of failed rules.
NULLS_FOUND = "Null values detected: {"
REPEATS_FOUND = "Duplicate rows detected: %d"
OUTSIDE_FOUND = "Range violations detected: %d rows"
FAILED_FOUND = "Condition violations detected: %d rows"

#: Texts longer than this are compared by their SHA-256 when rows are counted per key.
LONG_TEXT = 64


def _is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (FloatType, DoubleType))


def _absent(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the type has one."""
    c = col(column)
    return (c.isNull() | F.isnan(c)) if _is_float(df, column) else c.isNull()


@dataclass(frozen=True)
class NotNull:
    """No null (or NaN) in any of the columns."""

    rule_id: str
    columns: Sequence[str]

    def parts(self, df: DataFrame) -> list[tuple[str, Column]]:
        require_columns(df, names(self.columns), f"rule {self.rule_id}")
        return [(c, _absent(df, c)) for c in names(self.columns)]

    def message(self, counts: list[tuple[str, Column]], total: Column) -> Column:
        found = F.concat_ws(", ", *[F.when(n > 0, F.format_string("'%s': %d", F.lit(c), n)) for c, n in counts])
        return F.concat(F.lit(NULLS_FOUND), found, F.lit("}"))


@dataclass(frozen=True)
class Range:
    """Values inside inclusive bounds; null and NaN pass."""

    rule_id: str
    column: str
    min_value: Any = None
    max_value: Any = None

    def parts(self, df: DataFrame) -> list[tuple[str, Column]]:
        require_columns(df, [self.column], f"rule {self.rule_id}")
        c, tests = col(self.column), []
        if self.min_value is not None:
            tests.append(("below", c < F.lit(self.min_value)))
        if self.max_value is not None:
            above = c > F.lit(self.max_value)
            tests.append(("above", above & ~F.isnan(c) if _is_float(df, self.column) else above))
        return tests

    def message(self, counts: list[tuple[str, Column]], total: Column) -> Column:
        return F.format_string(OUTSIDE_FOUND, total)


@dataclass(frozen=True)
class Check:
    """A custom rule: a SQL condition every row must meet (null counts as met)."""

    rule_id: str
    condition: str | Column

    def parts(self, df: DataFrame) -> list[tuple[str, Column]]:
        met = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return [("failed", ~met)]

    def message(self, counts: list[tuple[str, Column]], total: Column) -> Column:
        return F.format_string(FAILED_FOUND, total)


@dataclass(frozen=True)
class Unique:
    """No second row for a key; null keys are equal. Concerns the table, not single rows."""

    rule_id: str
    columns: Sequence[str] = field(default_factory=list)


Rule = NotNull | Range | Check | Unique


def _compact(df: DataFrame, key: str) -> Column:
    """A key column as it is moved for counting: long texts as their hash.

    Kept texts have at most ``LONG_TEXT`` characters and hashes have more, so the two kinds
    cannot meet.
    """
    if not isinstance(df.schema[key].dataType, StringType):
        return col(key)
    return F.when(F.length(col(key)) > LONG_TEXT, F.concat(F.lit("#"), F.sha2(col(key), 256))).otherwise(col(key)).alias(key)


def _violated(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def evaluate_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """``rule, passed, violations, message``, one row per rule in the order given.

    All row rules share a single pass over the data. A uniqueness rule is one grouped count:
    copies collapse in the partial aggregate, so a much repeated key costs little.
    """
    rules = list(rules)
    if not rules:
        raise ValueError("evaluate_rules: no rules given")
    numbered = list(enumerate(rules))
    results: list[DataFrame] = []

    rowwise = [(i, r, r.parts(df)) for i, r in numbered if not isinstance(r, Unique)]
    if rowwise:
        counted = df.agg(
            F.lit(0).alias("unused"),
            *[F.count_if(_violated(t)).alias(f"r{i}_{k}") for i, _, parts in rowwise for k, (_, t) in enumerate(parts)],
        )
        lines = []
        for i, rule, parts in rowwise:
            counts = [(label, F.col(f"r{i}_{k}")) for k, (label, _) in enumerate(parts)]
            total = reduce(lambda a, b: a + b, [n for _, n in counts], F.lit(0).cast("long"))
            lines.append(_line(i, rule.rule_id, total, rule.message(counts, total)))
        results.append(counted.select(F.inline(F.array(*lines))))

    for i, rule in numbered:
        if isinstance(rule, Unique):
            keys = names(rule.columns)
            require_columns(df, keys, f"rule {rule.rule_id}")
            repeats = df.groupBy(*[_compact(df, k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
            total = repeats.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("long")).alias("total"))
            text = F.format_string(REPEATS_FOUND, F.col("total"))
            results.append(total.select(F.inline(F.array(_line(i, rule.rule_id, F.col("total"), text)))))

    stacked = reduce(DataFrame.unionAll, results)
    return stacked.orderBy("position").drop("position")


def _line(position: int, rule_id: str, total: Column, message: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(rule_id).alias("rule"),
        (total == 0).alias("passed"),
        total.alias("violations"),
        F.when(total == 0, F.lit("")).otherwise(message).alias("message"),
    )


def _row_tests(df: DataFrame, rules: Iterable[Rule]) -> list[tuple[str, Column]]:
    tests = []
    for rule in rules:
        if isinstance(rule, Unique):
            raise ValueError(f"rule {rule.rule_id}: uniqueness concerns the table; deduplicate to separate rows")
        parts = [_violated(t) for _, t in rule.parts(df)]
        tests.append((rule.rule_id, reduce(lambda a, b: a | b, parts, F.lit(False))))
    return tests


def split_by_rules(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: a narrow split, no shuffle.

    Rejected rows carry ``failed_rules``, the ids of the rules they break, comma separated.
    """
    tests = _row_tests(df, rules)
    if not tests:
        raise ValueError("split_by_rules: no rules given")
    bad = reduce(lambda a, b: a | b, [t for _, t in tests])
    failed = F.concat_ws(",", *[F.when(t, F.lit(rule_id)) for rule_id, t in tests])
    return df.filter(~bad), df.filter(bad).withColumn("failed_rules", failed)


def scorecard(df: DataFrame, rules: Iterable[Rule], group_by: str | Iterable[str]) -> DataFrame:
    """Pass rate per group and rule: ``<group columns>, rule, rows, violations, pass_rate``."""
    keys, tests = names(group_by), _row_tests(df, rules)
    require_columns(df, keys, "scorecard")
    counted = df.groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(t).alias(f"v{i}") for i, (_, t) in enumerate(tests)]
    )
    lines = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.col(f"v{i}").alias("violations")) for i, (r, _) in enumerate(tests)]
    )
    out = counted.select(*[col(k) for k in keys], "rows", F.explode(lines).alias("line"))
    rate = 1 - F.col("line.violations") / F.col("rows")
    return out.select(*[col(k) for k in keys], "line.rule", "rows", "line.violations", rate.alias("pass_rate"))
